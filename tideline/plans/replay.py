"""Replays of past days: what a repaired series looked like when a day was forecast, without repairing it anew for each day.

Repairs look ahead. A gap is filled by a spline only if something follows it,
and the spline leans on ``KNOTS`` valid rows behind the gap; what is carried
forward or set to zero depends on a series' last valid row. Cut off at ``as_of``,
only rows near the cut come out differently: missing rows with fewer than
``KNOTS`` valid rows between them and the cut (none, for rules that only ask for
the last valid row). Those are found by counts of valid rows, exploded per
(keys, as_of) with the rows their repair reads, repaired again, and laid over the
one repaired table that all days share. Work on top of one repair is in
proportion to keys x days asked, not to history x days asked.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideline.operators import clean, gaps
from tideline.session import pin
from tideline.specs import c

RULES = ("spline", "zero_after_last", "ffill_inside")


def repair(df: DataFrame, rule: str, keys: list[str], time: str = "ts", value: str = "value", max_gap: int = 5) -> DataFrame:
    """One look-ahead rule over whole series in long form: (keys, time, value)."""
    if rule == "spline":
        return gaps.interpolate_gaps_long(df, keys, max_gap, time, value)
    if rule == "zero_after_last":
        return clean.fill_zero_outside(df, [value], "after", keys, time)
    if rule == "ffill_inside":
        return gaps.ffill(df, [value], keys, time, inside=True)
    raise ValueError(f"unknown rule {rule}; known are {', '.join(RULES)}")


def valid_before(df: DataFrame, dates: list[str], keys: list[str], time: str = "ts", value: str = "value") -> DataFrame:
    """(keys, as_of, valid): how many valid rows each series has before each date; one pass, then a row per day."""
    days = df.groupBy(*keys, F.to_date(time).alias("day_")).agg(F.count(value).alias("n_"))
    asked = days.select(*keys).distinct().select(*keys, F.explode(F.array(*[F.lit(d).cast("date") for d in dates])).alias("day_"), F.lit(0).cast("long").alias("n_"), F.lit(True).alias("asked_"))
    number = F.datediff("day_", F.lit("1970-01-01"))
    before = Window.partitionBy(*keys).orderBy(number).rangeBetween(Window.unboundedPreceding, -1)
    both = days.withColumn("asked_", F.lit(False)).unionByName(asked)
    return both.withColumn("valid", F.coalesce(F.sum("n_").over(before), F.lit(0))).where("asked_").select(*keys, F.col("day_").alias("as_of"), "valid")


def delta(df: DataFrame, dates: list[str], rule: str, keys: list[str], time: str = "ts", value: str = "value", max_gap: int = 5) -> DataFrame:
    """(keys, as_of, time, value): the missing rows whose repair reads beyond the date, as they are when all from the date on is unknown."""
    reach = gaps.KNOTS if rule == "spline" else 1
    rows = pin(gaps.gap_runs(df.select(*keys, time, value), value, keys, time))
    ends = valid_before(rows, dates, keys, time, value)
    # the rows that the repairs near a cut read: as many valid rows again, ahead of those
    nth = F.explode(F.sequence(F.greatest(F.col("valid") - 2 * reach, F.lit(0)), F.col("valid"))).alias("valid_before")
    tails = ends.select(*keys, "as_of", "valid", nth).join(rows, [*keys, "valid_before"]).where(F.to_date(time) < F.col("as_of"))
    tails = pin(tails.select(*keys, "as_of", time, value, (c(value).isNull() & (F.col("valid_before") > F.col("valid") - reach)).alias("again_")))
    again = repair(tails, rule, [*keys, "as_of"], time, value, max_gap)
    return again.where("again_").select(*keys, "as_of", time, value)


def view(repaired: DataFrame, changed: DataFrame, dates: list[str], days: int, keys: list[str], time: str = "ts", value: str = "value") -> DataFrame:
    """(keys, as_of, time, value): the ``days`` days ahead of each date as they were known then; joins are on equal days and times only."""
    asked = F.explode(F.array(*[F.lit(d).cast("date") for d in dates])).alias("as_of")
    wanted = repaired.sparkSession.range(1).select(asked).select("as_of", F.explode(F.sequence(F.date_sub("as_of", days), F.date_sub("as_of", 1))).alias("day_"))
    shared = repaired.withColumn("day_", F.to_date(time)).join(F.broadcast(wanted), "day_").select(*keys, "as_of", time, value)  # a row per date and day asked
    laid = changed.select(*keys, "as_of", time, c(value).alias("new_"), F.lit(True).alias("changed_"))
    return shared.join(laid, [*keys, "as_of", time], "left").select(*keys, "as_of", time, F.when(F.col("changed_"), F.col("new_")).otherwise(c(value)).alias(value))


def lag_features(known: DataFrame, lags: dict[str, int], keys: list[str], time: str = "ts", value: str = "value") -> DataFrame:
    """(keys, as_of, time, one column per lag): the 24 hours of each date, from what was known ahead of it. Lags are in days."""
    moved = known.select(*keys, "as_of", F.explode(F.array(*[F.struct(F.lit(n).alias("lag_"), F.lit(d).alias("d_")) for n, d in lags.items()])).alias("x_"), time, value)
    at = moved.select(*keys, "as_of", (c(time) + F.make_dt_interval(F.col("x_.d_"))).alias(time), F.col("x_.lag_").alias("lag_"), value)
    return at.where(F.to_date(time) == F.col("as_of")).groupBy(*keys, "as_of", time).pivot("lag_", list(lags)).agg(F.first(value))


def to_history(forecasts: DataFrame, generated_at: str, keys: list[str], time: str = "ts", decimals: int = 2) -> DataFrame:
    """(keys, date, generated_at, values, model_values) of (keys, as_of, time, model, pred), where all 24 hours have a blend."""
    arrays = forecasts.groupBy(*keys, F.col("as_of").alias("date"), "model").agg(F.transform(F.sort_array(F.collect_list(F.struct(time, F.round("pred", decimals).alias("p_")))), lambda x: x["p_"]).alias("values"))
    rows = arrays.groupBy(*keys, "date").agg(F.max_by("values", F.when(F.col("model") == "blend", 1)).alias("values"), F.map_from_entries(F.sort_array(F.collect_list(F.when(F.col("model") != "blend", F.struct("model", "values"))))).alias("model_values"))
    full = (F.size("values") == 24) & F.forall("values", lambda v: v.isNotNull())
    return rows.where(full).select(*keys, "date", F.lit(generated_at).cast("timestamp").alias("generated_at"), "values", "model_values")

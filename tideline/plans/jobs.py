"""Composed batch jobs: merge, clean, overlay, forecast, history, backfill, freshness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tideline.functions.features import regime_flags
from tideline.operators import clean, gaps, merge
from tideline.operators.days import normalize_dst
from tideline.plans.blends import apply_weights, needs_reselection
from tideline.session import pin
from tideline.specs import MARKET_TZ, c


def handle_missing(df: DataFrame, rules: list[tuple], keys: list[str] = [], time: str = "ts", max_gap: int = 5, not_interpolated: list[str] = ()) -> DataFrame:
    """An ordered list of repair rules, then splines over what small gaps are left.

    Rules: ("drop", columns), ("zero_after_last", columns), ("zero_before_first",
    columns), ("zero_from", columns, time), ("zero_until", columns, time),
    ("difference", column, total, part), ("copy", column, other), ("total", column,
    parts, actuals), ("net", column, exports, imports).
    """
    at = lambda t: F.lit(t).cast("timestamp")
    here = lambda df, xs: [x for x in xs if x in df.columns]
    for kind, what, *rest in rules:
        if kind in ("zero_after_last", "zero_before_first", "total"):
            df = pin(df)
        if kind == "drop":
            df = df.drop(*what)
        elif kind in ("zero_after_last", "zero_before_first"):
            df = clean.fill_zero_outside(df, here(df, what), "after" if kind == "zero_after_last" else "before", keys, time)
        elif kind in ("zero_from", "zero_until"):
            df = clean.fill_zero(df, here(df, what), c(time) >= at(rest[0]) if kind == "zero_from" else c(time) < at(rest[0]))
        elif kind == "difference":
            df = clean.fill_difference(df, what, *rest)
        elif kind == "copy":
            df = clean.fill_from(df, what, *rest)
        elif kind == "total":
            df = clean.fill_total(df, what, *rest, keys=keys, time=time)
        elif kind == "net":
            df = clean.net_export(df, what, *rest)
        else:
            raise ValueError(f"unknown rule {kind}")
    columns = [x for x, t in df.dtypes if t == "double" and x not in not_interpolated and x not in keys]
    return gaps.interpolate_gaps(pin(df), columns, max_gap, keys, time) if columns and max_gap else df


def merge_job(old: DataFrame, new: DataFrame, fallback: DataFrame, commodities: DataFrame, cutoff: str, quarter: str, ordered_targets: list[str], rules: list[tuple], keys: list[str] = [], tz: str = MARKET_TZ, max_gap: int = 5) -> DataFrame:
    """Regimes merged, target unified and extended, flags, commodities as of the day, cleaned, 24 slots a day."""
    merged = merge.regime_merge(old, new, cutoff)
    unified = merge.unify_target(merged, ordered_targets, fallback, keys)
    extended = merge.extend_with(unified, fallback, "target_price", keys)
    flagged = regime_flags(extended, cutoff, quarter)
    values = [x for x in commodities.columns if x not in (*keys, "date")]
    priced = merge.asof(pin(flagged), commodities, values, keys)
    cleaned = handle_missing(pin(priced), rules, keys, max_gap=max_gap, not_interpolated=["target_price"])
    cleaned = pin(cleaned)
    doubles = [x for x, t in cleaned.dtypes if t == "double" and x not in keys]
    ints = [x for x, t in cleaned.dtypes if t == "int" and x not in keys]
    return normalize_dst(cleaned, doubles, keys, tz, other=ints)


def combine_job(regions: dict[str, DataFrame], columns: list[str]) -> DataFrame:
    """Long observations of several regions as one wide table keyed by region."""
    from functools import reduce

    from tideline.operators.reshape import to_wide

    tagged = [df.withColumn("region", F.lit(k)) for k, df in regions.items()]
    return to_wide(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged), columns, ["region"])


def overlay_job(base: DataFrame, live: DataFrame, snapshots: DataFrame, historical: DataFrame, columns: list[str], keys: list[str] = [], time: str = "ts") -> DataFrame:
    """External forecasts by priority live, snapshot, historical; clipped at 0; laid over the base."""
    flat = merge.bitemporal_latest(snapshots, columns, keys, time)
    combined = merge.prefer([live, flat, historical], [*keys, time], [c(time)])
    return merge.overlay(base, clean.clip_low(combined, columns), columns, keys, time)


def forecast_job(scored: DataFrame, weights: DataFrame, keys: list[str] = [], time: str = "ts", decimals: int = 2) -> DataFrame:
    """Predictions of all models and of their blend, rounded, as (keys, time, model, pred)."""
    blend = apply_weights(scored, weights, keys, [], time).select(*keys, time, F.lit("blend").alias("model"), F.round("pred", decimals).alias("pred"))
    return scored.select(*keys, time, "model", F.round("pred", decimals).alias("pred")).unionByName(blend)


def as_of_rows(features: DataFrame, dates: DataFrame, target: str, date: str = "local_date", least_rows: int = 8760, keys: list[str] = []) -> DataFrame:
    """Backfill: the rows of each ``as_of`` date with that day's target hidden, where enough history lies before.

    Features only look back (that is checked), so they are computed once.
    """
    counts = features.groupBy(*keys, date).agg(F.count("*").alias("n_"))
    earlier = Window.partitionBy(*keys).orderBy(date).rowsBetween(Window.unboundedPreceding, -1)  # a row per day
    before = counts.select(*keys, c(date).alias("as_of"), F.coalesce(F.sum("n_").over(earlier), F.lit(0)).alias("history_rows"))
    ready = before.join(dates.select("as_of").distinct(), "as_of").where(F.col("history_rows") >= least_rows)
    return features.join(ready, [*[features[k] == ready[k] for k in keys], features[date] == ready["as_of"]]).drop(*[ready[k] for k in keys]).withColumn(target, F.lit(None).cast("double"))


def freshness(df: DataFrame, columns: list[str], as_of: str, ok_hours: float = 48, time: str = "ts") -> DataFrame:
    """name, last_valid, hours_old, status (OK, STALE or MISSING), level (0, 1, 2)."""
    found = clean.availability(df, columns, time)
    hours = (F.unix_timestamp(F.lit(as_of).cast("timestamp")) - F.unix_timestamp("last")) / 3600.0
    status: Column = F.when(F.col("last").isNull(), "MISSING").when(hours > ok_hours, "STALE").otherwise("OK")
    return found.select("name", F.col("last").alias("last_valid"), hours.alias("hours_old"), status.alias("status"), F.when(F.col("last").isNull(), 2).when(hours > ok_hours, 1).otherwise(0).alias("level"))


def freshness_report(spark: SparkSession, sources: dict[str, tuple[str, float]], as_of: str, time: str = "ts") -> DataFrame:
    """name, status, hours_old, last_valid, level, message of stored tables (name -> path and hours), and a row ``overall`` with the worst level.

    OK is level 0, STALE 1; MISSING (no table) and ERROR (no valid value, or a table that cannot be read) are 2.
    """
    rows = []
    for name, (path, most) in sources.items():
        try:
            df = spark.read.parquet(path)
            values = [x for x in df.columns if x != time]
            last = F.max(F.when(F.coalesce(*[c(x).cast("string") for x in values]).isNotNull(), c(time)))
            hours, at = df.agg(((F.unix_timestamp(F.lit(as_of).cast("timestamp")) - F.unix_timestamp(last)) / 3600.0).alias("hours"), last.cast("string").alias("last")).first()
        except Exception as e:  # a check reports what is wrong with a source and goes on to the next
            gone = "PATH_NOT_FOUND" in str(e)
            rows.append((name, "MISSING" if gone else "ERROR", None, None, 2, f"no table at {path}" if gone else f"cannot be read: {str(e)[:200]}"))
            continue
        status, level = ("ERROR", 2) if hours is None else ("STALE", 1) if hours > most else ("OK", 0)
        rows.append((name, status, hours, at, level, "no valid value" if hours is None else f"{hours:.1f} hours old, {most:g} allowed"))
    worst = max((r[4] for r in rows), default=0)
    rows.append(("overall", ("OK", "WARNING", "CRITICAL")[worst], None, None, worst, f"{sum(r[4] > 0 for r in rows)} of {len(rows)} not as they should be"))
    return spark.createDataFrame(rows, "name string, status string, hours_old double, last_valid string, level int, message string")


def retrain_history(history: DataFrame, new: DataFrame, keep: int = 52, keys: list[str] = []) -> DataFrame:
    """Appends retrains; the newest ``keep`` of each key stay, with their relative change and the reselection flag."""
    both = history.unionByName(new)
    flagged = both.withColumn("degradation_pct", F.try_divide(F.col("new_blend_mae") - F.col("old_blend_mae"), F.col("old_blend_mae")) * 100).withColumn("needs_reselection", needs_reselection(F.col("old_blend_mae"), F.col("new_blend_mae")))
    if not keys:
        return flagged.orderBy(F.desc("date")).limit(keep)
    return flagged.withColumn("n_", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("date")))).where(F.col("n_") <= keep).drop("n_")

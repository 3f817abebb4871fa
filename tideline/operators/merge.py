"""Joins and unions of keyed series: regimes, priorities, as-of, upserts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.specs import c


def regime_merge(old: DataFrame, new: DataFrame, cutoff, time: str = "ts") -> DataFrame:
    """The old source before the cutoff, the new one from it on; columns of both."""
    at = F.lit(cutoff).cast("timestamp")
    return old.where(c(time) < at).unionByName(new.where(c(time) >= at), allowMissingColumns=True)


def unify_target(df: DataFrame, ordered: list[str], fallback: DataFrame | None = None, keys: list[str] = [], time: str = "ts", target: str = "target_price", fallback_value: str = "value") -> DataFrame:
    """The first present of the ordered columns, else the fallback at the same time."""
    present = [x for x in ordered if x in df.columns]
    if not present:
        raise ValueError(f"none of {ordered} is there")
    if fallback is None:
        return df.withColumn(target, F.coalesce(*map(c, present)))
    right = fallback.select(*keys, time, c(fallback_value).alias("fallback_"))
    return df.join(right, [*keys, time], "left").withColumn(target, F.coalesce(*map(c, present), F.col("fallback_"))).drop("fallback_")


def extend_with(df: DataFrame, finer: DataFrame, column: str, keys: list[str] = [], time: str = "ts", value: str = "value") -> DataFrame:
    """Hourly means of a finer series behind each key's last row; other columns are missing there."""
    last = df.groupBy(*keys).agg(F.max(time).alias("last_"))
    hours = finer.groupBy(*keys, F.date_trunc("hour", time).alias(time)).agg(F.avg(value).alias(column))
    beyond = hours.join(last, keys) if keys else hours.join(F.broadcast(last))  # one row
    return df.unionByName(beyond.where(c(time) > F.col("last_")).drop("last_"), allowMissingColumns=True)


def asof(rows: DataFrame, daily: DataFrame, values: list[str], keys: list[str] = [], time: str = "ts", date: str = "date", allow_exact: bool = True, before=None) -> DataFrame:
    """Each row gets the daily values of the last day not after its own (with ``allow_exact=False``: before it).

    Days, not rows, are filled: the days of both sides meet in one small table per
    key, so raw rows see no window. ``before`` keeps days from it on out.
    """
    day = F.to_date(time)
    known = daily.select(*keys, date, *values)
    if before is not None:
        known = known.where(c(date) < F.lit(before).cast("date"))
    order = Window.partitionBy(*keys).orderBy(date, "asked_")
    both = known.withColumn("asked_", F.lit(1 if allow_exact else 3)).unionByName(rows.select(*keys, day.alias(date)).distinct().withColumn("asked_", F.lit(2)), allowMissingColumns=True)
    seen = F.last(F.when(F.col("asked_") != 2, F.struct(*[c(v) for v in values])), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    filled = both.withColumn("seen_", seen).where("asked_ = 2").select(*keys, F.col(date).alias("day_"), *[F.col("seen_")[v].alias(v) for v in values])
    return rows.withColumn("day_", day).join(filled, [*keys, "day_"], "left").drop("day_")


def overlay(base: DataFrame, external: DataFrame, columns: list[str], keys: list[str] = [], time: str = "ts", flag: str = "forecast_source", extra: str = "is_true_forecast") -> DataFrame:
    """Where an external row exists its columns replace the base's, even by missing values; ``flag`` says where."""
    ext = external.select(*keys, time, *[c(x).alias(f"ext_{x}") for x in columns], (c(extra) if extra in external.columns else F.lit(1)).alias("ext_true_"), F.lit(True).alias("there_"))
    there = F.coalesce(F.col("there_"), F.lit(False))
    picked = {x: F.when(there, c(f"ext_{x}")).otherwise(c(x) if x in base.columns else F.lit(None)) for x in columns}
    out = base.join(ext, [*keys, time], "left").withColumns(picked | {flag: there.cast("int"), extra: F.when(there, F.coalesce("ext_true_", F.lit(1)))})
    return out.drop("there_", "ext_true_", *[f"ext_{x}" for x in columns])


def latest_wins(df: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    """One row per ``by``: the first in ``order`` (which decides ties fully)."""
    return df.withColumn("n_", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where("n_ = 1").drop("n_")


def prefer(sources: list[DataFrame], by: list[str], tie: list[Column]) -> DataFrame:
    """Union of sources in order of priority; of rows for one ``by`` the highest priority stays."""
    tagged = [s.withColumn("priority_", F.lit(i)) for i, s in enumerate(sources)]
    return latest_wins(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged), by, [F.col("priority_"), *tie]).drop("priority_")


def bitemporal_latest(snapshots: DataFrame, values: list[str], keys: list[str] = [], time: str = "ts", snapshot: str = "snapshot_date") -> DataFrame:
    """Per valid time and column, the last non-missing value over all snapshots."""
    return snapshots.groupBy(*keys, time).agg(*[F.max_by(v, F.when(c(v).isNotNull(), c(snapshot))).alias(v) for v in values])


def outer_join_daily(frames: list[DataFrame], on: list[str]) -> DataFrame:
    return reduce(lambda a, b: a.join(b, on, "full_outer"), frames)


def last_valid(df: DataFrame, columns: list[str], keys: list[str] = [], time: str = "ts") -> DataFrame:
    """Per key the last time each column has a value."""
    return df.groupBy(*keys).agg(*[F.max(F.when(c(x).isNotNull(), c(time))).alias(x) for x in columns])


def upsert(existing: DataFrame, new: DataFrame, by: list[str], redundancy_days: int = 14, keys: list[str] = [], time: str = "ts", last: DataFrame | None = None) -> DataFrame:
    """Rows of the last ``redundancy_days`` are dropped and fetched anew; of rows for one ``by`` the new one wins.

    ``last`` (keys, last_) overrides where a key's window ends; a key unknown so far is taken whole.
    """
    ends = last if last is not None else existing.groupBy(*keys).agg(F.max(time).alias("last_"))
    kept = (existing.join(ends, keys, "left") if keys else existing.join(F.broadcast(ends))).where(F.col("last_").isNull() | (c(time) < F.col("last_") - F.make_dt_interval(F.lit(redundancy_days)))).drop("last_")
    return prefer([new, kept], by, [c(time)])


def reference_time(df: DataFrame, realised: list[str], keys: list[str] = [], time: str = "ts") -> DataFrame:
    """(keys, last_): the last time a realised column has a value, else the median of the columns' last valid times."""
    values = [x for x, kind in df.dtypes if kind == "double"]
    ends = last_valid(df, values, keys, time)
    first = [c(x) for x in realised if x in values]
    median = F.timestamp_seconds(F.expr("percentile(s_, 0.5)"))
    each = ends.select(*keys, F.explode(F.array(*[F.unix_timestamp(c(x)) for x in values])).alias("s_"))
    fall = each.groupBy(*keys).agg(median.alias("median_"))
    joined = ends.join(fall, keys) if keys else ends.join(F.broadcast(fall))
    return joined.select(*keys, F.coalesce(F.greatest(*first) if len(first) > 1 else first[0] if first else F.lit(None), F.col("median_")).cast("timestamp").alias("last_"))


def chunks_to_read(valid: DataFrame, chunks: DataFrame, nth: int, series: str = "series", time: str = "ts", start: str = "chunk_start", bootstrap_days: int = 45, as_of=None) -> DataFrame:
    """Which chunks of each series to read again: from the one before the nth-last valid row on.

    A series without any row reads the chunks of the last ``bootstrap_days``.
    """
    newest = Window.partitionBy(series).orderBy(F.desc(time))
    mark = valid.withColumn("n_", F.row_number().over(newest)).where(F.col("n_") <= nth).groupBy(series).agg(F.min(time).alias("mark_"))
    # a range join, but of chunk lists, which are short
    joined = chunks.join(mark, series)
    first = joined.where(c(start) < F.col("mark_")).groupBy(series).agg(F.max(start).alias("first_"))
    known = chunks.join(first, series).where(c(start) >= F.col("first_")).select(series, start)
    fresh = chunks.join(mark, series, "left_anti").where(c(start) >= F.lit(as_of).cast("timestamp") - F.make_dt_interval(F.lit(bootstrap_days))).select(series, start)
    return known.unionByName(fresh)


def extend_horizon(history: DataFrame, forecast: DataFrame, day, columns: list[str], carried: list[str], keys: list[str] = [], time: str = "ts") -> DataFrame:
    """The 24 rows of ``day`` from a forecast: existing ones get the forecast columns, absent ones are added with ``carried`` from the last row.

    Raises unless the forecast covers all 24 slots of every key.
    """
    start = F.lit(day).cast("timestamp")
    slots = forecast.where((c(time) >= start) & (c(time) < start + F.make_dt_interval(F.lit(1)))).select(*keys, time, *columns)
    covered = slots.groupBy(*keys).agg(F.count_distinct(time).alias("n"))
    if covered.isEmpty() or not covered.where("n <> 24").isEmpty():
        raise ValueError(f"the forecast does not cover 24 slots of {day}")
    past = history.where((c(time) < start) | (c(time) >= start + F.make_dt_interval(F.lit(1))))
    same = history.join(slots.select(*keys, time, *[c(x).alias(f"new_{x}") for x in columns]), [*keys, time]).withColumns({x: c(f"new_{x}") for x in columns}).drop(*[f"new_{x}" for x in columns])
    last = history.groupBy(*keys).agg(*[F.max_by(x, time).alias(x) for x in carried])
    fresh = slots.join(history.select(*keys, time), [*keys, time], "left_anti")
    fresh = fresh.join(last, keys) if keys else fresh.join(F.broadcast(last))
    return past.unionByName(same).unionByName(fresh, allowMissingColumns=True)


def actuals_at(times: DataFrame, series: DataFrame, source: str = "source", time: str = "ts", value: str = "value") -> DataFrame:
    """Actual values for the given times: from the longest source that covers all of them, else the mean over sources."""
    hit = times.join(series, time)
    asked = times.agg(F.count_distinct(time).alias("asked_"))
    size = series.groupBy(source).agg(F.count(value).alias("size_"))
    full = hit.groupBy(source).agg(F.count_distinct(time).alias("hits_")).join(F.broadcast(asked)).where("hits_ = asked_").join(size, source)
    best = full.agg(F.max_by(source, F.struct("size_", source)).alias("best_"))
    mean = hit.groupBy(time).agg(F.avg(value).alias("mean_"))
    exact = hit.join(F.broadcast(best), c(source) == F.col("best_")).groupBy(time).agg(F.avg(value).alias("exact_"))
    return times.join(mean, time, "left").join(exact, time, "left").select(time, F.coalesce("exact_", "mean_").alias(value))

"""Derivations of daily price series: resampling, conversion, bias, reconstruction of gaps, unification."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideline.operators.clean import align_columns, range_check
from tideline.operators.gaps import ffill
from tideline.operators.merge import asof, outer_join_daily
from tideline.specs import c


def monthly_to_daily(monthly: DataFrame, keys: list[str] = [], date: str = "date", value: str = "value") -> DataFrame:
    """Each month's value on its days up to the next one's; the last month has its own first day only."""
    following = F.lead(date).over(Window.partitionBy(*keys).orderBy(date))
    end = F.coalesce(F.date_sub(following, 1), c(date))
    return monthly.withColumn("end_", end).select(*keys, F.explode(F.sequence(c(date), F.col("end_"))).alias("day_"), value).withColumnRenamed("day_", date)


def convert(prices: DataFrame, rates: DataFrame, keys: list[str] = [], date: str = "date", value: str = "value", rate: str = "rate", factor: float = 1.0) -> DataFrame:
    """Price / last known rate x factor."""
    return asof(prices, rates, [rate], keys, time=date, date=date).withColumn(value, F.try_divide(c(value), c(rate)) * factor).drop(rate)


def bias(a: DataFrame, b: DataFrame, keys: list[str] = [], date: str = "date", value: str = "value", since: str | None = None) -> DataFrame:
    """(keys, bias, corr, n): mean of a - b over common dates from ``since`` on; bias 0 without any."""
    both = a.select(*keys, date, c(value).alias("a_")).join(b.select(*keys, date, c(value).alias("b_")), [*keys, date])
    if since:
        both = both.where(c(date) >= F.lit(since).cast("date"))
    return both.groupBy(*keys).agg(F.coalesce(F.avg(F.col("a_") - F.col("b_")), F.lit(0.0)).alias("bias"), F.corr("a_", "b_").alias("corr"), F.count("*").alias("n"))


def centre_by_month(df: DataFrame, keys: list[str] = [], date: str = "date", value: str = "value") -> DataFrame:
    return df.withColumn(value, c(value) - F.avg(value).over(Window.partitionBy(*keys, F.trunc(date, "month"))))


def baseline_plus_variation(baseline: DataFrame, variation: DataFrame, keys: list[str] = [], date: str = "date", value: str = "value") -> DataFrame:
    """On the dates of either: the baseline as of then plus the variation, which counts as 0 where missing."""
    dates = baseline.select(*keys, date).union(variation.select(*keys, date)).distinct()
    based = asof(dates, baseline, [value], keys, time=date, date=date)
    var = variation.select(*keys, date, c(value).alias("var_"))
    return based.join(var, [*keys, date], "left").withColumn(value, c(value) + F.coalesce("var_", F.lit(0.0))).drop("var_")


def splice(reconstructed: DataFrame, direct: DataFrame, keys: list[str] = [], date: str = "date", value: str = "value") -> DataFrame:
    """The reconstruction before the first direct observation, then the direct series."""
    first = direct.where(c(value).isNotNull()).groupBy(*keys).agg(F.min(date).alias("first_"))
    joined = reconstructed.join(first, keys, "left") if keys else reconstructed.join(F.broadcast(first))
    early = joined.where(F.col("first_").isNull() | (c(date) < F.col("first_"))).drop("first_")
    return early.select(*keys, date, value).unionByName(direct.select(*keys, date, value))


def reconstruct_gap(monthly: DataFrame, fine: DataFrame, rates: DataFrame, direct: DataFrame, keys: list[str] = [], date: str = "date", value: str = "value", factor: float = 1.0, since: str | None = None) -> DataFrame:
    """A daily series before direct observations: monthly level, converted and corrected for bias, plus the finer series' variation within months."""
    level = convert(monthly_to_daily(monthly, keys, date, value), rates, keys, date, value, factor=factor)
    b = bias(direct, level, keys, date, value, since)
    shifted = level.join(b.select(*keys, "bias"), keys, "left") if keys else level.join(F.broadcast(b.select("bias")))
    corrected = shifted.withColumn(value, c(value) + F.coalesce("bias", F.lit(0.0))).drop("bias")
    varied = centre_by_month(convert(fine, rates, keys, date, value, factor=factor), keys, date, value)
    return splice(baseline_plus_variation(corrected, varied, keys, date, value), direct, keys, date, value)


def unify(df: DataFrame, primary: str, proxy: str, out: str, keys: list[str] = []) -> DataFrame:
    """The primary, else the proxy plus the mean difference where both are there (0 if nowhere)."""
    b = df.groupBy(*keys).agg(F.coalesce(F.avg(c(primary) - c(proxy)), F.lit(0.0)).alias("bias_"))
    joined = df.join(b, keys) if keys else df.join(F.broadcast(b))
    return joined.withColumn(out, F.coalesce(c(primary), c(proxy) + F.col("bias_"))).drop("bias_")


def commodity_table(frames: dict[str, DataFrame], expected: list[str], unified: dict[str, tuple[str, str]] = {}, keys: list[str] = [], date: str = "date") -> DataFrame:
    """Daily sources joined on date, unified, completed with absent columns, and filled forward inside their ranges."""
    table = outer_join_daily(list(frames.values()), [*keys, date])
    for out, (primary, proxy) in unified.items():
        table = unify(table, primary, proxy, out, keys)
    table = align_columns(table, [*keys, date, *expected])
    return ffill(table, expected, keys, time=date, block="year", inside=True)


def checked(table: DataFrame, bounds: dict[str, tuple[float, float]]) -> tuple[DataFrame, DataFrame]:
    """The table, and its range report."""
    return table, range_check(table, bounds)

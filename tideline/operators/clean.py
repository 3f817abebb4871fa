"""Rule-based repair of missing values, checks, and column algebra over many columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.specs import c


def any_sum(columns: list[str]) -> Column:
    """The sum of what is there; missing only if nothing is."""
    if not columns:
        return F.lit(None).cast("double")
    return F.when(F.coalesce(*map(c, columns)).isNotNull(), reduce(lambda a, b: a + b, [F.coalesce(c(x), F.lit(0.0)) for x in columns]))


def fill_zero(df: DataFrame, columns: list[str], when: Column) -> DataFrame:
    return df.withColumns({x: F.when(c(x).isNull() & when, 0.0).otherwise(c(x)) for x in columns})


def fill_zero_outside(df: DataFrame, columns: list[str], side: str, keys: list[str] = [], time: str = "ts") -> DataFrame:
    """Zero behind a column's last value (``after``) or ahead of its first (``before``)."""
    pick = F.max if side == "after" else F.min
    edge = df.groupBy(*keys).agg(*[pick(F.when(c(x).isNotNull(), c(time))).alias(f"edge_{x}") for x in columns])
    joined = df.join(edge, keys) if keys else df.join(F.broadcast(edge))  # a row per key
    outside = {x: (c(time) > c(f"edge_{x}")) if side == "after" else (c(time) < c(f"edge_{x}")) for x in columns}
    return joined.withColumns({x: F.when(c(x).isNull() & outside[x], 0.0).otherwise(c(x)) for x in columns}).drop(*[f"edge_{x}" for x in columns])


def fill_difference(df: DataFrame, column: str, total: str, part: str) -> DataFrame:
    return df.withColumn(column, F.coalesce(c(column), c(total) - c(part)))


def fill_from(df: DataFrame, column: str, other: str) -> DataFrame:
    return df.withColumn(column, F.coalesce(c(column), c(other)))


def fill_total(df: DataFrame, column: str, parts: list[str], actuals: list[str], keys: list[str] = [], time: str = "ts", recent_days: int = 30) -> DataFrame:
    """A missing total: the sum of its parts if all are there; else the sum of the actuals, in the last days or where a part is there."""
    last = df.groupBy(*keys).agg(F.max(time).alias("last_"))
    joined = df.join(last, keys) if keys else df.join(F.broadcast(last))
    summed = reduce(lambda a, b: a + b, map(c, parts))
    lately = c(time) >= F.col("last_") - F.make_dt_interval(F.lit(recent_days))
    some = F.coalesce(*map(c, parts)).isNotNull()
    return joined.withColumn(column, F.coalesce(c(column), summed, F.when(lately | some, any_sum(actuals)))).drop("last_")


def net_export(df: DataFrame, column: str, exports: list[str], imports: list[str]) -> DataFrame:
    there = F.coalesce(*map(c, exports + imports)).isNotNull()
    net = F.coalesce(any_sum(exports), F.lit(0.0)) - F.coalesce(any_sum(imports), F.lit(0.0))
    return df.withColumn(column, F.coalesce(c(column), F.when(there, net)) if column in df.columns else F.when(there, net))


def clip_low(df: DataFrame, columns: list[str], low: float = 0.0) -> DataFrame:
    return df.withColumns({x: F.when(c(x) < low, low).otherwise(c(x)) for x in columns})


def align_columns(df: DataFrame, columns: list[str], kind: str = "double") -> DataFrame:
    """Exactly these columns in this order; absent ones are missing values."""
    return df.select(*[c(x) if x in df.columns else F.lit(None).cast(kind).alias(x) for x in columns])


def range_check(df: DataFrame, bounds: dict[str, tuple[float, float]]) -> DataFrame:
    """name, n_out, low, high, smallest, largest: one pass over all bounded columns."""
    found = df.agg(*[F.struct(F.count_if((c(x) < lo) | (c(x) > hi)).alias("n_out"), F.min(x).alias("smallest"), F.max(x).alias("largest")).alias(x) for x, (lo, hi) in bounds.items()])
    rows = F.array(*[F.struct(F.lit(x).alias("name"), F.lit(float(lo)).alias("low"), F.lit(float(hi)).alias("high"), c(x)["n_out"].alias("n_out"), c(x)["smallest"].alias("smallest"), c(x)["largest"].alias("largest")) for x, (lo, hi) in bounds.items()])
    return found.select(F.inline(rows))


def missing_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """name, n_missing, pct_missing."""
    found = df.agg(F.count("*").alias("n_"), *[F.count_if(c(x).isNull()).alias(x) for x in columns])
    rows = F.array(*[F.struct(F.lit(x).alias("name"), c(x).alias("n_missing"), F.try_divide(c(x) * 100.0, F.col("n_")).alias("pct_missing")) for x in columns])
    return found.select(F.inline(rows))


def availability(df: DataFrame, columns: list[str], time: str = "ts") -> DataFrame:
    """name, first, last, n: where each column has values."""
    found = df.agg(*[F.struct(F.min(F.when(c(x).isNotNull(), c(time))).alias("first"), F.max(F.when(c(x).isNotNull(), c(time))).alias("last"), F.count(x).alias("n")).alias(x) for x in columns])
    rows = F.array(*[F.struct(F.lit(x).alias("name"), c(x)["first"].alias("first"), c(x)["last"].alias("last"), c(x)["n"].alias("n")) for x in columns])
    return found.select(F.inline(rows))


def median_impute(train: DataFrame, valid: DataFrame, columns: list[str]) -> DataFrame:
    """Missing values of ``valid`` become the exact medians of ``train``."""
    m = train.agg(*[F.median(x).alias(f"med_{x}") for x in columns])
    return valid.join(F.broadcast(m)).withColumns({x: F.coalesce(c(x), c(f"med_{x}")) for x in columns}).drop(*[f"med_{x}" for x in columns])

"""Recurrences over whole series, block by block: fill forward, runs of missing values, local splines.

Raw rows are windowed per (keys, block) only; what a block hands on is one small
row, and just those rows see a window over the series.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.operators.reshape import to_long
from tideline.session import pin, ship
from tideline.specs import c

#: Valid points on either side of a gap; farther ones do not change a cubic spline in double precision.
KNOTS = 32


def block_of(time: str, block: str) -> Column:
    return F.date_trunc(block, time)


def ffill(df: DataFrame, columns: list[str], keys: list[str] = [], time: str = "ts", block: str = "month", inside: bool = False) -> DataFrame:
    """The last value so far; with ``inside``, only up to a column's last valid row."""
    inner = Window.partitionBy(*keys, "block_").orderBy(time).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(*keys).orderBy("block_").rowsBetween(Window.unboundedPreceding, -1)
    all_ = Window.partitionBy(*keys)
    rows = df.withColumn("block_", block_of(time, block))
    ends = rows.groupBy(*keys, "block_").agg(*[F.max_by(x, F.when(c(x).isNotNull(), c(time))).alias(f"end_{x}") for x in columns], *[F.max(F.when(c(x).isNotNull(), c(time))).alias(f"at_{x}") for x in columns])
    carry = ends.select(*keys, "block_", *[F.last(f"end_{x}", ignorenulls=True).over(before).alias(f"carry_{x}") for x in columns], *[F.max(f"at_{x}").over(all_).alias(f"last_{x}") for x in columns])
    filled = {x: F.coalesce(F.last(x, ignorenulls=True).over(inner), c(f"carry_{x}")) for x in columns}
    if inside:
        filled = {x: F.when(c(time) <= c(f"last_{x}"), v) for x, v in filled.items()}
    return rows.join(carry, [*keys, "block_"], "left").withColumns(filled).drop("block_", *[f"{p}_{x}" for p in ("carry", "last") for x in columns])


def gap_runs(df: DataFrame, column: str, keys: list[str] = [], time: str = "ts", block: str = "month") -> DataFrame:
    """Adds valid_before (valid rows up to and including this one) and run_length (missing rows in a row; 0 where valid)."""
    inner = Window.partitionBy(*keys, "block_").orderBy(time).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(*keys).orderBy("block_").rowsBetween(Window.unboundedPreceding, -1)
    rows = df.withColumn("block_", block_of(time, block))
    offsets = rows.groupBy(*keys, "block_").agg(F.count(column).alias("n_")).select(*keys, "block_", F.coalesce(F.sum("n_").over(before), F.lit(0)).alias("offset_"))
    counted = rows.withColumn("in_", F.count(column).over(inner)).join(offsets, [*keys, "block_"]).withColumn("valid_before", F.col("in_") + F.col("offset_")).drop("in_", "offset_", "block_")
    sizes = counted.where(c(column).isNull()).groupBy(*keys, "valid_before").agg(F.count("*").alias("size_"))
    return counted.join(sizes, [*keys, "valid_before"], "left").withColumn("run_length", F.when(c(column).isNull(), F.col("size_")).otherwise(0)).drop("size_")


def cubic(x: np.ndarray, y: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Not-a-knot cubic spline through (x, y); fewer than four points give the polynomial through them."""
    n = len(x)
    if n < 4:
        return np.polyval(np.polyfit(x - x[0], y, n - 1), at - x[0])
    h, slope = np.diff(x), np.diff(y) / np.diff(x)
    # unknowns: second derivatives at the knots
    a, b = np.zeros((n, n)), np.zeros(n)
    i = np.arange(1, n - 1)
    a[i, i - 1], a[i, i], a[i, i + 1], b[i] = h[:-1], 2 * (h[:-1] + h[1:]), h[1:], 6 * np.diff(slope)
    a[0, :3], a[-1, -3:] = (h[1], -h[0] - h[1], h[0]), (h[-1], -h[-2] - h[-1], h[-2])
    m = np.linalg.solve(a, b)
    k = np.clip(np.searchsorted(x, at, "right") - 1, 0, n - 2)
    u, v = at - x[k], x[k + 1] - at
    return (m[k] * v**3 + m[k + 1] * u**3) / (6 * h[k]) + (y[k] / h[k] - m[k] * h[k] / 6) * v + (y[k + 1] / h[k] - m[k + 1] * h[k] / 6) * u


def interpolate_gaps_long(df: DataFrame, keys: list[str], max_gap: int = 5, time: str = "ts", value: str = "value", block: str = "month") -> DataFrame:
    """Interior gaps of at most ``max_gap`` rows in a row, each by a spline through the points around it."""
    ship(df.sparkSession)
    df = pin(df)  # it and its runs are read several times
    runs = pin(gap_runs(df.select(*keys, time, value), value, keys, time, block))
    total = runs.groupBy(*keys).agg(F.max("valid_before").alias("all_"))
    small = runs.where((F.col("run_length") > 0) & (F.col("run_length") <= max_gap) & (F.col("valid_before") > 0)).join(total, keys).where("valid_before < all_")
    hour = F.unix_timestamp(time) / 3600.0
    gaps = small.groupBy(*keys, "valid_before").agg(F.sort_array(F.collect_list(hour)).alias("at_"))
    near = gaps.withColumn("nth_", F.explode(F.sequence(F.col("valid_before") - KNOTS + 1, F.col("valid_before") + KNOTS)))
    points = runs.where(c(value).isNotNull()).select(*keys, F.col("valid_before").alias("nth_"), hour.alias("x_"), c(value).alias("y_"))
    knots = near.join(points, [*keys, "nth_"]).groupBy(*keys, "valid_before").agg(F.first("at_").alias("at_"), F.sort_array(F.collect_list(F.struct("x_", "y_"))).alias("p_"))
    tagged = knots.select(F.struct(*keys).alias("key_"), "at_", F.col("p_.x_").alias("x"), F.col("p_.y_").alias("y"))
    key_type = tagged.schema["key_"].dataType.simpleString()

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [cubic(np.array(x), np.array(y), np.array(at)).tolist() for at, x, y in zip(*(b.column(i).to_pylist() for i in (1, 2, 3)))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.list_(pa.float64()))], ["key_", "at_", "v_"])

    solved = tagged.mapInArrow(solve, f"key_ {key_type}, at_ array<double>, v_ array<double>")
    filled = solved.select("key_.*", F.explode(F.arrays_zip("at_", "v_")).alias("f_")).select(*keys, F.timestamp_seconds(F.round(F.col("f_.at_") * 3600).cast("long")).alias(time), F.col("f_.v_").alias("fill_"))
    return df.join(filled, [*keys, time], "left").withColumn(value, F.coalesce(c(value), F.col("fill_"))).drop("fill_")


def interpolate_gaps(df: DataFrame, columns: list[str], max_gap: int = 5, keys: list[str] = [], time: str = "ts", block: str = "month") -> DataFrame:
    """``interpolate_gaps_long`` for columns of a wide table, all in one pass."""
    long = interpolate_gaps_long(to_long(df, [*keys, time], columns), [*keys, "column_name"], max_gap, time, "value", block)
    back = long.groupBy(*keys, time).pivot("column_name", columns).agg(F.max("value"))
    return df.drop(*columns).join(back, [*keys, time], "left")

"""Local days of 24 slots: calendar keys, daylight-saving repair, day-level joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.specs import MARKET_TZ, c


def local(time: str | Column, tz: str = MARKET_TZ) -> Column:
    return F.from_utc_timestamp(c(time) if isinstance(time, str) else time, tz)


def with_local(df: DataFrame, tz: str = MARKET_TZ, time: str = "ts") -> DataFrame:
    """Adds local_date and slot (the local hour)."""
    return df.withColumns({"local_date": F.to_date(local(time, tz)), "slot": F.hour(local(time, tz))})


def normalize_dst(df: DataFrame, columns: list[str], keys: list[str] = [], tz: str = MARKET_TZ, time: str = "ts", other: list[str] = []) -> DataFrame:
    """Exactly one row per (keys, local_date, slot).

    The repeated hour of autumn becomes the mean of its rows (other columns: the
    first); the hour that spring leaves out is the mean of its neighbours.
    """
    grid = with_local(df, tz, time).groupBy(*keys, "local_date", "slot").agg(*[F.avg(x).alias(x) for x in columns], *[F.min_by(x, time).alias(x) for x in other])
    midnight = F.unix_timestamp(F.to_utc_timestamp(F.col("local_date").cast("timestamp"), tz))
    following = F.unix_timestamp(F.to_utc_timestamp(F.date_add("local_date", 1).cast("timestamp"), tz))
    short = grid.select(*keys, "local_date").distinct().where(following - midnight < 86400)
    # the wall-clock hour that no instant of the day has
    hours = F.transform(F.sequence(F.lit(0), F.lit(22)), lambda h: F.hour(F.from_utc_timestamp(F.timestamp_seconds(midnight + h * 3600), tz)))
    lost = short.withColumn("slot", F.explode(F.array_except(F.sequence(F.lit(0), F.lit(23)), hours)))
    sides = lost.withColumn("side_", F.explode(F.array(F.col("slot") - 1, F.col("slot") + 1)))
    around = sides.join(grid.withColumnRenamed("slot", "side_"), [*keys, "local_date", "side_"])
    fill = around.groupBy(*keys, "local_date", "slot").agg(*[F.avg(x).alias(x) for x in columns], *[F.min_by(x, "side_").alias(x) for x in other])
    return grid.unionByName(fill)

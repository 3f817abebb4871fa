"""Structured Streaming: windowed means with a watermark, and latest-wins upserts with a side table of what came too late."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def hourly_means(stream: DataFrame, keys: list[str], time: str = "ts", value: str = "value", late: str = "14 days", width: str = "1 hour") -> DataFrame:
    """Tumbling means; rows behind the watermark are dropped and finished windows leave the state."""
    w = stream.withWatermark(time, late).groupBy(*keys, F.window(time, width).alias("w")).agg(F.avg(value).alias("value"), F.count("*").alias("n"))
    return w.select(*keys, F.col("w.start").alias("ts"), "value", "n")


def _newest(df: DataFrame, by: list[str], version: str) -> DataFrame:
    return df.withColumn("n_", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc(version)))).where("n_ = 1").drop("n_")


def upsert_batch(batch: DataFrame, path: str, rejected: str, by: list[str], time: str = "ts", version: str = "version", late_days: int = 14) -> None:
    """Put one micro-batch into a table partitioned by day.

    Rows older than ``late_days`` before the table's newest go to ``rejected``.
    Only days the batch touches are read and written again. They are staged
    first, as a plan must not overwrite what it reads; the batch's content alone
    decides the result, so a batch that is run again changes nothing.
    """
    spark = batch.sparkSession
    batch = batch.withColumn("day", F.to_date(time))
    try:
        table = spark.read.parquet(path)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER" not in str(e):
            raise
        table = None
    last = table.agg(F.max(time)).first()[0] if table is not None else None
    newest = max([x for x in (last, batch.agg(F.max(time)).first()[0]) if x is not None], default=None)
    if newest is None:
        return
    limit = F.lit(newest) - F.make_dt_interval(F.lit(late_days))
    batch.where(F.col(time) < limit).drop("day").write.mode("append").parquet(rejected)
    fresh = batch.where(F.col(time) >= limit)
    if table is not None:
        days = fresh.select("day").distinct()
        fresh = fresh.unionByName(table.join(F.broadcast(days), "day", "left_semi"))  # at most late_days + 1 days
    staged = f"{path}_staged"
    _newest(fresh, by, version).write.mode("overwrite").parquet(staged)
    spark.read.schema(fresh.schema).parquet(staged).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)


def upsert_stream(stream: DataFrame, path: str, rejected: str, checkpoint: str, by: list[str], **options) -> StreamingQuery:
    return stream.writeStream.foreachBatch(lambda b, _: upsert_batch(b, path, rejected, by, **options)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def append_stream(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append what is finished to Parquet, a folder per micro-batch; a batch that is run again replaces its own folder."""
    put = lambda b, i: b.write.mode("overwrite").parquet(f"{path}/batch={i}")
    return df.writeStream.outputMode("append").foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def run_available(df: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Run a streaming frame over what is there and return the memory sink's table; for tests and small results."""
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    return df.sparkSession.table(name)

"""Long to wide, arrays to rows, and back."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideline.specs import c


def to_wide(long: DataFrame, columns: list[str], keys: list[str] = [], time: str = "ts", name: str = "column_name", value: str = "value") -> DataFrame:
    """One column per listed name; duplicates are averaged, and rows without any value are absent.

    The list makes the schema static and spares the pivot a pass over the data.
    """
    return long.where(c(value).isNotNull()).groupBy(*keys, time).pivot(name, columns).agg(F.avg(value))


def to_long(wide: DataFrame, ids: list[str], columns: list[str], name: str = "column_name", value: str = "value") -> DataFrame:
    return wide.unpivot([c(x).alias(x) for x in ids], [c(x).cast("double").alias(x) for x in columns], name, value)


def daily_arrays_to_hours(df: DataFrame, array: str, date: str = "date", value: str = "value") -> DataFrame:
    """Arrays of a day's values -> one row per slot (slot, ts, value)."""
    kept = [x for x in df.columns if x != array]
    rows = df.select(*map(c, kept), F.posexplode(array).alias("slot", value))
    return rows.withColumn("ts", F.timestamp_seconds(F.unix_timestamp(c(date).cast("timestamp")) + F.col("slot") * 3600))


def complete_days(df: DataFrame, keys: list[str], date: str = "date", slot: str = "slot", value: str = "value", slots: int = 24, last: int | None = None) -> DataFrame:
    """Days with exactly ``slots`` values as arrays in slot order; with ``last``, the newest days per key only."""
    days = df.groupBy(*keys, date).agg(F.sort_array(F.collect_list(F.when(c(value).isNotNull(), F.struct(slot, value)))).alias("a"), F.count("*").alias("rows_"), F.count(value).alias("values_"))
    days = days.where((F.col("rows_") == slots) & (F.col("values_") == slots)).select(*keys, date, F.col(f"a.{value}").alias("values"))
    if last:
        newest = Window.partitionBy(*keys).orderBy(F.desc(date))
        days = days.withColumn("n_", F.row_number().over(newest)).where(F.col("n_") <= last).drop("n_")
    return days


def name_columns(measures: DataFrame, code: str = "code", name: str = "column_name") -> DataFrame:
    """A unique column name per code: names that several codes share get the code behind them."""
    shared = F.count("*").over(Window.partitionBy(name)) > 1
    return measures.withColumn("unique_name", F.when(shared, F.concat_ws("_", name, c(code).cast("string"))).otherwise(c(name)))


def group_by_dataset(models: DataFrame, dataset: str = "dataset_id", model: str = "model") -> DataFrame:
    return models.groupBy(dataset).agg(F.sort_array(F.collect_list(model)).alias("models"))


def align_models(preds: DataFrame, models: list[str], keys: list[str] = [], time: str = "ts", model: str = "model") -> DataFrame:
    """Rows of the times for which every model has a prediction."""
    wanted = preds.where(c(model).isin(models))
    full = wanted.groupBy(*keys, time).agg(F.count_distinct(model).alias("n_")).where(F.col("n_") == len(models)).drop("n_")
    return wanted.join(full, [*keys, time], "left_semi")

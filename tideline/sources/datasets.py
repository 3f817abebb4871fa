"""Versioned datasets, snapshots and published documents as plain Parquet and JSON folders."""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tideline.specs import c

META = "name string, version int, created timestamp, source string, tags map<string,string>, features array<string>, targets array<string>, dropped array<string>, spec string, n_rows bigint, first_ts timestamp, last_ts timestamp"


def write_snapshot(df: DataFrame, path: str, date: str) -> None:
    """Replaces the partition of one publication date, and no other."""
    df.withColumn("snapshot_date", F.lit(date).cast("date")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("snapshot_date").parquet(path)


def append_feature_snapshot(df: DataFrame, path: str, dataset: str, forecast_date: str, generated_at: str) -> None:
    df.withColumns({"dataset": F.lit(dataset), "forecast_date": F.lit(forecast_date).cast("date"), "generated_at": F.lit(generated_at).cast("timestamp")}).write.mode("append").partitionBy("dataset", "forecast_date").parquet(path)


def source_snapshot(df: DataFrame, hours: int = 336, keys: list[str] = [], time: str = "ts") -> DataFrame:
    """The last ``hours`` before each key's newest row."""
    last = df.groupBy(*keys).agg(F.max(time).alias("last_"))
    joined = df.join(last, keys) if keys else df.join(F.broadcast(last))
    return joined.where(c(time) > F.col("last_") - F.make_dt_interval(F.lit(0), F.lit(hours))).drop("last_")


def retained(snapshots: DataFrame, today: str, days: int = 7, date: str = "snapshot_date") -> DataFrame:
    """Snapshots not older than ``days``; the filter prunes partitions."""
    return snapshots.where(c(date) >= F.date_sub(F.lit(today).cast("date"), days))


def forecast_documents(preds: DataFrame, generated_at: str, keys: list[str] = [], date: str = "date", decimals: int = 2) -> DataFrame:
    """One JSON document per day: date, generated_at, prices, model_predictions."""
    blend = preds.where("model = 'blend'").groupBy(*keys, date).agg(F.sort_array(F.collect_list(F.struct("slot", F.round("pred", decimals).alias("p")))).alias("a")).select(*keys, date, F.col("a.p").alias("prices"))
    each = preds.where("model <> 'blend'").groupBy(*keys, date, "model").agg(F.sort_array(F.collect_list(F.struct("slot", F.round("pred", decimals).alias("p")))).alias("a"))
    models = each.groupBy(*keys, date).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("model", F.col("a.p").alias("p"))))).alias("model_predictions"))
    doc = F.to_json(F.struct(c(date).cast("string").alias("date"), F.lit(generated_at).alias("generated_at"), "prices", "model_predictions"))
    return blend.join(models, [*keys, date], "left").select(*keys, date, doc.alias("document"))


def upsert_history(history: DataFrame, new: DataFrame, keep: int = 30, date: str = "date", keys: list[str] = []) -> DataFrame:
    """Latest generation per date wins; the newest ``keep`` dates stay."""
    both = history.unionByName(new)
    last = both.withColumn("n_", F.row_number().over(Window.partitionBy(*keys, date).orderBy(F.desc("generated_at")))).where("n_ = 1").drop("n_")
    return last.withColumn("n_", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(date)))).where(F.col("n_") <= keep).drop("n_")


class Datasets:
    """Named, versioned feature tables below one folder: data/name=../version=.., and one metadata row each."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")

    def _meta(self) -> DataFrame:
        try:
            return self.spark.read.schema(META).option("recursiveFileLookup", "true").json(f"{self.base}/meta")
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return self.spark.createDataFrame([], META)

    def _claim(self, name: str) -> int:
        """The next free version, by a file that only one writer can create; whoever comes second tries the next number."""
        jvm, conf = self.spark._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        folder = jvm.org.apache.hadoop.fs.Path(f"{self.base}/claims/{name}")
        fs = folder.getFileSystem(conf)
        fs.mkdirs(folder)
        taken = [int(f.getPath().getName()) for f in fs.listStatus(folder)]
        version = max([self._meta().where(F.col("name") == name).agg(F.max("version")).first()[0] or 0, *taken]) + 1
        while not fs.createNewFile(jvm.org.apache.hadoop.fs.Path(folder, str(version))):
            version += 1
        return version

    def save(self, df: DataFrame, name: str, created: str, spec: str = "", tags: dict[str, str] = {}, source: str | None = None, dropped: list[str] = (), time: str = "ts") -> int:
        """Targets are the columns called y or y_0 ... y_23; there is one or 24 of them.

        A version is claimed first, then written, and seen once its metadata is
        there: writers at once get versions of their own, a broken save is never
        listed, and its number is not used again.
        """
        targets = [x for x in df.columns if re.fullmatch(r"y(_\d+)?", x)]
        if len(targets) not in (1, 24):
            raise ValueError(f"{len(targets)} targets; 1 or 24 are needed")
        df = df.na.drop(subset=targets)
        version = self._claim(name)
        df.write.parquet(f"{self.base}/data/name={name}/version={version}")
        features = [x for x in df.columns if x not in targets and x != time]
        ends = F.min(time) if time in df.columns else F.lit(None).cast("timestamp"), F.max(time) if time in df.columns else F.lit(None).cast("timestamp")
        row = df.agg(F.count("*").alias("n_rows"), ends[0].alias("first_ts"), ends[1].alias("last_ts"))
        arr = lambda xs: F.array(*map(F.lit, xs)).cast("array<string>")
        row.select(F.lit(name).alias("name"), F.lit(version).alias("version"), F.lit(created).cast("timestamp").alias("created"), F.lit(source).cast("string").alias("source"), F.from_json(F.lit(json.dumps(tags)), "map<string,string>").alias("tags"), arr(features).alias("features"), arr(targets).alias("targets"), arr(dropped).alias("dropped"), F.lit(spec).alias("spec"), "n_rows", "first_ts", "last_ts").coalesce(1).write.json(f"{self.base}/meta/{name}/{version}")
        return version

    def list(self, tags: dict[str, str] = {}) -> DataFrame:
        meta = self._meta()
        for k, v in tags.items():
            meta = meta.where(F.try_element_at("tags", F.lit(k)) == v)
        newest = Window.partitionBy("name").orderBy(F.desc("created"), F.desc("version"))
        return meta.withColumn("newest_first", F.row_number().over(newest))

    def find(self, name: str | None = None, version: int | None = None, id: str | None = None):
        """The metadata row by name (and version; else the latest) or by id ``name/version``: exactly one of the two."""
        if (name is None) == (id is None):
            raise ValueError("give a name or an id")
        if id is not None:
            name, version = id.rsplit("/", 1)[0], int(id.rsplit("/", 1)[1])
        rows = self.list().where(F.col("name") == name)
        row = rows.where(F.col("version") == version if version else F.col("newest_first") == 1).first()
        if row is None:
            raise KeyError(f"no dataset {name} {version or ''}")
        return row

    def load(self, **which) -> DataFrame:
        row = self.find(**which)
        return self.spark.read.parquet(f"{self.base}/data/name={row['name']}/version={row['version']}")

    def load_spec(self, **which) -> str:
        return self.find(**which)["spec"]

    def select(self, source: str, name: str, columns: list[str], created: str) -> int:
        """A new dataset with some of another's columns, and where it came from."""
        row = self.find(id=source)
        if unknown := set(columns) - set(row["features"]):
            raise ValueError(f"unknown columns {sorted(unknown)}")
        df = self.load(id=source)
        kept = [x for x in df.columns if x in columns or x not in row["features"]]
        return self.save(df.select(*map(c, kept)), name, created, row["spec"], source=source, dropped=sorted(set(row["features"]) - set(columns)))

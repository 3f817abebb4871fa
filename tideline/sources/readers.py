"""Readers of landed files. Schemas are explicit; nothing is inferred from data."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.specs import c

LONG_SCHEMA = "timestamp BIGINT, value DOUBLE, time STRING, region STRING, measure INT, measure_desc STRING"


def nulls(df: DataFrame) -> DataFrame:
    """NaN becomes missing."""
    return df.withColumns({x: F.when(~F.isnan(x), c(x)) for x, kind in df.dtypes if kind in ("double", "float")})


def read_long_csv(spark: SparkSession, path: str) -> DataFrame:
    """A folder of long observation files; times with or without an offset become instants (UTC without)."""
    df = nulls(spark.read.schema(LONG_SCHEMA).option("header", True).csv(path))
    if not df.inputFiles():
        raise ValueError(f"no files in {path}")
    return df.withColumn("ts", F.expr("try_cast(time AS TIMESTAMP)"))


def write_wide(df: DataFrame, path: str, time: str = "ts") -> None:
    df.withColumn("year", F.year(time)).write.mode("overwrite").partitionBy("year").parquet(path)


def read_wide(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_daily_csv(spark: SparkSession, path: str, price: str, name: str) -> DataFrame:
    """date and one price column under a new name; text that is no number is missing."""
    raw = spark.read.option("header", True).csv(path)
    return raw.select(F.to_date("Date").alias("date"), F.expr(f"try_cast(`{price}` AS DOUBLE)").alias(name))


def read_daily_folder(spark: SparkSession, folder: str, wanted: dict[str, tuple[str, str]]) -> dict[str, DataFrame]:
    """name -> frame for the files that are there; ``wanted``: file name -> (price column, name)."""
    out = {}
    for file, (price, name) in wanted.items():
        try:
            out[name] = read_daily_csv(spark, f"{folder}/{file}", price, name)
        except Exception as e:  # an absent file is no error here
            if "PATH_NOT_FOUND" not in str(e):
                raise
    return out


def read_report_csv(spark: SparkSession, path: str, columns: dict[str, str], date: str = "Date") -> DataFrame:
    """Exchange reports: a banner line, padded headers, unnamed columns; blanks are missing.

    Files are read by lines and can be of any length. A file's header is its line
    with a ``date`` cell; columns are found by each file's own header. Rows are the
    lines with a date there; cells may be quoted. ``columns``: header -> name.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.regexp_replace("value", "\r", "").alias("line"))
    names = F.transform(F.split("line", ","), lambda x: F.trim(x))
    heads = lines.where(F.array_contains(names, date)).groupBy("file").agg(F.min(names).alias("names"))
    width = heads.agg(F.max(F.size("names"))).first()[0] or 1
    cells = F.from_csv("line", ", ".join(f"c{i} STRING" for i in range(width)), {"mode": "PERMISSIVE"})
    rows = lines.join(heads, "file").withColumn("row", cells).withColumn("cells", F.array(*[F.trim(f"row.c{i}") for i in range(width)]))
    cell = lambda name: F.get("cells", (F.array_position("names", F.lit(name)) - 1).cast("int"))  # noqa: E731  missing where the header lacks it
    day = rows.withColumn("day", cell(date).try_cast("date")).where("day IS NOT NULL")
    return day.select(F.col("day").alias("date"), *[cell(k).try_cast("double").alias(v) for k, v in columns.items()])


def decode_series(json: DataFrame, constants: dict[str, str] = {}) -> DataFrame:
    """{"series": [[ms, value], ...]} -> ts, value and constant columns."""
    pair = json.select(F.explode("series").alias("p"))
    return pair.select(F.timestamp_millis(F.get("p", F.lit(0)).cast("long")).alias("ts"), F.get("p", F.lit(1)).alias("value"), *[F.lit(v).alias(k) for k, v in constants.items()])


SERIES_SCHEMA, INDEX_SCHEMA, PRICE_SCHEMA = "series ARRAY<ARRAY<DOUBLE>>", "timestamps ARRAY<BIGINT>", "unix_seconds ARRAY<BIGINT>, price ARRAY<DOUBLE>"


def decode_index(json: DataFrame) -> DataFrame:
    return json.select(F.explode("timestamps").alias("ms")).select(F.timestamp_millis("ms").alias("chunk_start"))


def decode_prices(json: DataFrame) -> DataFrame:
    """Parallel arrays of seconds and prices; missing prices are left out."""
    zipped = json.select(F.explode(F.arrays_zip("unix_seconds", "price")).alias("z"))
    return zipped.select(F.timestamp_seconds("z.unix_seconds").alias("ts"), F.col("z.price").alias("value")).where("value IS NOT NULL")


def read_forecast_csv(spark: SparkSession, paths: list[str], schema: str) -> DataFrame:
    """The first path that can be read; its first column is a time, in UTC where no offset says else."""
    for p in paths:
        try:
            df = spark.read.schema(schema).option("header", True).csv(p)
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            continue
        first = df.columns[0]
        return nulls(df).withColumn(first, F.expr(f"try_cast(`{first}` AS TIMESTAMP)")).withColumnRenamed(first, "ts")
    raise FileNotFoundError(", ".join(paths))


def file_date(pattern: str = r"(\d{4}-\d{2}-\d{2})") -> Column:
    """The last date in a file's path: in its own name or its folder's."""
    return F.to_date(F.element_at(F.regexp_extract_all(F.col("_metadata.file_path"), F.lit(pattern), F.lit(1)), -1))


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """Snapshot files of any folder depth; the publication date comes from the path."""
    return spark.read.option("recursiveFileLookup", True).parquet(path).withColumn("snapshot_date", file_date())


def read_hindcasts(spark: SparkSession, files: list[str], required: list[str], skip: str = "per_tso_") -> DataFrame:
    """Files with the required columns; source and is_true_forecast follow from the name (backtest: 1, hindcast: 0)."""
    frames = []
    for f in files:
        name = f.rstrip("/").rsplit("/", 1)[-1]
        if name.startswith(skip):
            continue
        df = spark.read.parquet(f)
        if missing := [x for x in required if x not in df.columns]:
            raise ValueError(f"{name} lacks {missing}")
        true = 1 if "backtest" in name else 0
        frames.append(df.withColumns({"source": F.lit(name.split(".")[0]), "is_true_forecast": F.lit(true)}))
    if not frames:
        raise ValueError("no files")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)

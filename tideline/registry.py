"""Registered queries: a Spark function, its columns, and SQL that gives the same rows.

``cols`` lists name:kind pairs; both sides are brought to the same plain types by
it: t timestamp and D date as text, d double rounded to six decimals, i 64-bit
integer, s text, b boolean.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.session import scratch  # noqa: F401  queries import it from here

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

HOURLY = "hourly AS (SELECT event_type, date_trunc('hour', ts) AS ts, avg(value) AS value, count(*) AS n FROM events GROUP BY ALL)"
TYPES = ("view", "click", "purchase", "signup", "error")
WIDE = "wide AS (SELECT date_trunc('hour', ts) AS ts, " + ", ".join(f"avg(value) FILTER (event_type = '{t}') AS {t}" for t in TYPES) + " FROM events GROUP BY 1)"
#: Hours in which a series is out, in words that both engines read: nightly, for days, alone and together.
OUTAGES = {
    "view": "hour(ts) BETWEEN 2 AND 4 OR day(ts) = 12 OR (day(ts) = 21 AND hour(ts) >= 17)",
    "click": "hour(ts) = 9 OR day(ts) IN (7, 8) OR (day(ts) = 21 AND hour(ts) >= 12)",
    "purchase": "hour(ts) BETWEEN 3 AND 8 OR day(ts) >= 29",
    "signup": "hour(ts) >= 22 OR day(ts) IN (15, 21)",
    "error": "hour(ts) BETWEEN 3 AND 4 OR hour(ts) = 18 OR day(ts) = 1",
}
#: The hourly series with outages, for the operators on missing values.
THIN = "thin AS (SELECT date_trunc('hour', ts) AS ts, " + ", ".join(f"avg(value) FILTER (event_type = '{t}' AND NOT ({OUTAGES[t]})) AS {t}" for t in TYPES) + " FROM events GROUP BY 1)"
DAILY = "daily AS (SELECT o_orderpriority AS k, CAST(o_orderdate AS DATE) AS date, avg(o_totalprice) AS price FROM orders GROUP BY ALL)"


def _spark(name: str, kind: str) -> Column:
    x = F.col(f"`{name}`")
    return {"t": lambda: F.date_format(x.cast("timestamp"), "yyyy-MM-dd HH:mm:ss"), "D": lambda: x.cast("date").cast("string"), "d": lambda: F.round(x.cast("double"), 6) + F.lit(0.0), "i": lambda: x.cast("long"), "s": lambda: x.cast("string"), "b": lambda: x.cast("boolean")}[kind]().alias(name)


def _sql(name: str, kind: str) -> str:
    x = f'"{name}"'
    return {"t": f"strftime({x}, '%Y-%m-%d %H:%M:%S')", "D": f"strftime({x}, '%Y-%m-%d')", "d": f"round(CAST({x} AS DOUBLE), 6) + 0.0", "i": f"CAST({x} AS BIGINT)", "s": f"CAST({x} AS VARCHAR)", "b": f"CAST({x} AS BOOLEAN)"}[kind] + f" AS {x}"


def query(cols: str, sql: str | None = None):
    """Register the function under its name; ``sql`` may start with named subqueries."""
    pairs = [tuple(x.strip().rsplit(":", 1)) for x in cols.split(",")]

    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir).select(*[_spark(n, k) for n, k in pairs])

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[fn.__name__] = run
        if sql:
            SQL[fn.__name__] = f"SELECT {', '.join(_sql(n, k) for n, k in pairs)} FROM ({sql.strip()}) AS result"
        return fn

    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; its timestamps have no zone and are taken as UTC instants."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.withColumns({x: F.col(x).cast("timestamp") for x, kind in df.dtypes if kind == "timestamp_ntz"})


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_type, ts, value, n: hourly means of the events."""
    e = table(spark, sf_dir, "events")
    return e.groupBy("event_type", F.date_trunc("hour", "ts").alias("ts")).agg(F.avg("value").alias("value"), F.count("*").alias("n"))


def wide(spark: SparkSession, sf_dir: str, thin: bool = False) -> DataFrame:
    """ts and one column per event type; with ``thin``, without the values of their outages."""
    e = table(spark, sf_dir, "events")
    seen = {t: (F.col("event_type") == t) & (~F.expr(OUTAGES[t]) if thin else F.lit(True)) for t in TYPES}
    return e.groupBy(F.date_trunc("hour", "ts").alias("ts")).agg(*[F.avg(F.when(seen[t], F.col("value"))).alias(t) for t in TYPES])


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """k, date, price: daily mean order prices by priority."""
    o = table(spark, sf_dir, "orders")
    return o.groupBy(F.col("o_orderpriority").alias("k"), F.to_date("o_orderdate").alias("date")).agg(F.avg("o_totalprice").alias("price"))


"""All registered queries of the time-series library, gathered from its parts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline import registry
from tideline.operators import windows
from tideline.plans import scoring
from tideline.queries import backfill, io, modelling, relational, series  # noqa: F401  they register themselves
from tideline.specs import WindowSpec


FLAGSHIP_SQL = f"""WITH {modelling.PREDS}, loc AS (SELECT event_type AS k, ts, value AS y, CAST(ts + INTERVAL 1 HOUR AS DATE) AS d FROM hourly), w AS (SELECT a.k, a.ts, avg(b.y) AS m FROM loc a LEFT JOIN loc b ON a.k = b.k AND b.d BETWEEN a.d - 7 AND a.d - 1 GROUP BY ALL)
 SELECT k, avg(abs(pred - y)) AS mae, sqrt(avg((pred - y) * (pred - y))) AS rmse, count(*) AS n, (SELECT avg(m) FROM w WHERE w.k = preds.k) AS mean_week FROM preds WHERE model = 'lag1' GROUP BY k"""


@registry.query("k:s, mae:d, rmse:d, n:i, mean_week:d", FLAGSHIP_SQL)
def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly series by type; last week's mean and yesterday's hour as features; the naive baseline's error."""
    series_ = registry.hourly(spark, sf_dir).select(F.col("event_type").alias("k"), "ts", F.col("value").alias("y"))
    rows = windows.same_hour_lag(windows.rolling(series_, ["y"], [WindowSpec(-7, -1, ("mean",))], ["k"]), "y", [1], ["k"])
    scored = rows.withColumn("pred", F.col("y_lag_1d"))
    return scoring.metrics(scored, ["k"]).join(rows.groupBy("k").agg(F.avg("y_d7_d1_mean").alias("mean_week")), "k")


def queries() -> dict:
    return dict(registry.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(registry.SQL)

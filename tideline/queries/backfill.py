"""Replays of past days and forecasts of stored models, end to end."""

from __future__ import annotations

from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from tideline.operators.reshape import to_long
from tideline.plans import blends, models, production, replay
from tideline.registry import HOURLY, THIN, TYPES, hourly, query, scratch, wide
from tideline.session import pin
from tideline.sources.datasets import upsert_history

#: Series that end for good are set to zero behind their last value; the others carry their last value inside.
ENDING = ("purchase", "signup")
#: The first five days are the hold-out that weights come from.
DATES = [f"2024-01-{d}" for d in range(15, 30)]
HOLDOUT_END = "2024-01-20"
LAGS = {"day": 1, "week": 7}

_KNOWN = f"""{THIN}, long AS ({' UNION ALL '.join(f"SELECT '{t}' AS k, ts, {t} AS value FROM thin" for t in TYPES)}),
 dates AS (SELECT CAST(range AS DATE) AS as_of FROM range(DATE '2024-01-15', DATE '2024-01-30', INTERVAL 1 DAY)),
 cut AS (SELECT k, as_of, ts, value, max(ts) FILTER (value IS NOT NULL) OVER (PARTITION BY k, as_of) AS last FROM long JOIN dates ON ts < as_of),
 known AS (SELECT k, as_of, ts, last, value AS was, CASE WHEN value IS NOT NULL THEN value WHEN k IN {ENDING} THEN CASE WHEN ts > last THEN 0.0 END
   WHEN ts <= last THEN last_value(value IGNORE NULLS) OVER (PARTITION BY k, as_of ORDER BY ts) END AS value FROM cut)"""


def _thin(spark, sf):
    long = to_long(wide(spark, sf, thin=True), ["ts"], list(TYPES)).withColumnRenamed("column_name", "k")
    return pin(long.select("k", "ts", "value"))


def _known(spark, sf, days: int):
    """The last days ahead of each date, as they were repaired then."""
    long, parts = _thin(spark, sf), []
    for rule, mine in (("zero_after_last", F.col("k").isin(*ENDING)), ("ffill_inside", ~F.col("k").isin(*ENDING))):
        own = long.where(mine)
        parts.append(replay.view(replay.repair(own, rule, ["k"]), replay.delta(own, DATES, rule, ["k"]), DATES, days, ["k"]))
    return parts[0].unionByName(parts[1])


@query("k:s, as_of:D, ts:t, value:d", f"WITH {_KNOWN} SELECT k, as_of, ts, value FROM known WHERE was IS NULL AND (last IS NULL OR ts > last)")
def L05_replayed_rows(spark, sf):
    """Rows whose repair depends on what came after the day."""
    long = _thin(spark, sf)
    ending = F.col("k").isin(*ENDING)
    return replay.delta(long.where(ending), DATES, "zero_after_last", ["k"]).unionByName(replay.delta(long.where(~ending), DATES, "ffill_inside", ["k"]))


_PREDICTED = f"""{_KNOWN}, p AS (SELECT n.k, n.as_of, n.ts + to_days(m.d) AS ts, m.model, n.value AS pred FROM known n, (VALUES ('day', 1), ('week', 7)) m(model, d) WHERE CAST(n.ts + to_days(m.d) AS DATE) = n.as_of),
 e AS (SELECT model, avg(abs(pred - l.value)) AS mae FROM p JOIN long l USING (k, ts) WHERE as_of < DATE '{HOLDOUT_END}' GROUP BY 1), w AS (SELECT model, (1 / (mae + 1e-6)) / sum(1 / (mae + 1e-6)) OVER () AS weight FROM e),
 b AS (SELECT k, as_of, ts, sum(weight * pred) AS pred FROM p JOIN w USING (model) WHERE as_of >= DATE '{HOLDOUT_END}' AND pred IS NOT NULL GROUP BY ALL HAVING count(*) = 2)"""


@query("k:s, date:D, total:d, of_day:d", f"""WITH {_PREDICTED}, h AS (SELECT k, as_of AS date, sum(round(pred, 9)) AS total FROM b GROUP BY ALL HAVING count(*) = 24),
 d AS (SELECT k, as_of AS date, sum(round(pred, 9)) AS of_day FROM p WHERE model = 'day' GROUP BY ALL) SELECT k, date, total, of_day FROM h JOIN d USING (k, date) QUALIFY row_number() OVER (PARTITION BY k ORDER BY date DESC) <= 7""")
def L05_backfill_history(spark, sf):
    """Every date forecast from what was known then, blended by the hold-out's weights, put into the history of seven dates."""
    made = replay.lag_features(_known(spark, sf, max(LAGS.values())), LAGS, ["k"])
    preds = pin(made.select("k", "as_of", "ts", F.inline(F.array(*[F.struct(F.lit(m).alias("model"), F.col(m).alias("pred")) for m in LAGS]))))
    scored = preds.join(_thin(spark, sf).withColumnRenamed("value", "y"), ["k", "ts"], "left")
    weights = blends.inverse_mae_weights(blends.errors_by_model(scored.where(F.col("as_of") < HOLDOUT_END)))
    asked = scored.where(F.col("as_of") >= HOLDOUT_END)
    blend = blends.apply_weights(asked, weights, ["k", "as_of"]).select("k", "as_of", "ts", F.lit("blend").alias("model"), "pred")
    rows = replay.to_history(blend.unionByName(asked.select("k", "as_of", "ts", "model", "pred")), "2024-02-01", ["k"], decimals=9)
    total = lambda v: F.aggregate(v, F.lit(0.0), lambda a, x: a + F.coalesce(x, F.lit(0.0)))
    kept = upsert_history(rows.limit(0), rows, 7, keys=["k"])
    return kept.withColumns({"total": total(F.col("values")), "of_day": total(F.try_element_at("model_values", F.lit("day")))})


_LAGGED = f"""{HOURLY}, x AS (SELECT h.event_type AS k, h.ts, h.value AS y, a.value AS day, b.value AS week FROM hourly h JOIN hourly a ON a.event_type = h.event_type AND a.ts = h.ts - INTERVAL 1 DAY JOIN hourly b ON b.event_type = h.event_type AND b.ts = h.ts - INTERVAL 7 DAY),
 f AS (SELECT 'day' AS model, regr_slope(y, day) AS s, regr_intercept(y, day) AS i FROM x WHERE ts < TIMESTAMP '2024-01-22' UNION ALL SELECT 'week', regr_slope(y, week), regr_intercept(y, week) FROM x WHERE ts < TIMESTAMP '2024-01-22'),
 p AS (SELECT k, ts, y, model, i + s * CASE model WHEN 'day' THEN day ELSE week END AS pred FROM x, f),
 e AS (SELECT model, avg(abs(pred - y)) AS mae, sqrt(avg((pred - y) * (pred - y))) AS rmse FROM p WHERE ts >= TIMESTAMP '2024-01-22' AND ts < TIMESTAMP '2024-01-29' GROUP BY 1), w AS (SELECT *, (1 / (mae + 1e-6)) / sum(1 / (mae + 1e-6)) OVER () AS weight FROM e)"""


def _lagged(spark, sf):
    h = hourly(spark, sf).select(F.col("event_type").alias("k"), "ts", "value")
    rows = h.withColumnRenamed("value", "y")
    for name, days in LAGS.items():
        rows = rows.join(h.select("k", (F.col("ts") + F.make_dt_interval(F.lit(days))).alias("ts"), F.col("value").alias(name)), ["k", "ts"])
    return pin(rows)


def _stored(spark, rows):
    """Two fitted models in a store, weighed anew on the newest hold-out ahead of the day that is forecast."""
    fitted = {m: models.train(rows.where("ts < TIMESTAMP '2024-01-22'"), [m], LinearRegression(featuresCol="features_", labelCol="y", solver="normal")) for m in LAGS}
    config = spark.createDataFrame([(m, "linear", [m], 0.5, None) for m in LAGS], "model string, category string, features array<string>, weight double, mae double")
    store = production.Production(spark, f"{scratch(spark)}/production")
    store.save(fitted, config)
    store.refresh(rows.where("ts >= TIMESTAMP '2024-01-22' AND ts < TIMESTAMP '2024-01-29'"), ["k"])
    return store


@query("model:s, weight:d, mae:d", f"WITH {_LAGGED} SELECT model, weight, mae FROM w")
def K06_stored_weights(spark, sf):
    return _stored(spark, _lagged(spark, sf)).summary()


@query("k:s, ts:t, model:s, pred:d", f"WITH {_LAGGED}, d AS (SELECT * FROM p WHERE ts >= TIMESTAMP '2024-01-29') SELECT k, ts, model, round(pred, 4) AS pred FROM d UNION ALL SELECT k, ts, 'blend', round(sum(weight * pred), 4) FROM d JOIN w USING (model) GROUP BY k, ts")
def L04_stored_forecast(spark, sf):
    """What the stored models and their blend forecast for the newest days."""
    rows = _lagged(spark, sf)
    return _stored(spark, rows).forecast(rows.where("ts >= TIMESTAMP '2024-01-29'"), ["k"], decimals=4)

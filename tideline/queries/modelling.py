"""Splits, metrics, baselines, model fits, ensembles, jobs."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tideline.functions.features import day_interactions, decay_weights
from tideline.functions.scalers import LogShift
from tideline.operators import days, merge, reshape, windows
from tideline.plans import blends, jobs, leakage, models, pipelines, production, scoring
from tideline.plans import runs as recorded
from tideline.registry import DAILY, HOURLY, THIN, TYPES, WIDE, daily, hourly, query, scratch, table, wide
from tideline.session import pin
from tideline.specs import AvailabilityRule, Step, WindowSpec

#: Naive lags as models: the value one, two and seven days ago.
LAGS = {"lag1": 24, "lag2": 48, "lag7": 168}
PREDS = f"""{HOURLY}, preds AS (SELECT h.event_type AS k, h.ts, m.model, h.value AS y, p.value AS pred FROM hourly h, (VALUES ('lag1', 24), ('lag2', 48), ('lag7', 168)) m(model, hrs) JOIN hourly p ON p.event_type = h.event_type AND p.ts = h.ts - to_hours(m.hrs))"""


def preds(spark, sf):
    h = hourly(spark, sf).select(F.col("event_type").alias("k"), "ts", "value")
    return scoring.naive_baselines(h, "value", LAGS, ["k"]).withColumnRenamed("baseline", "model")


METRICS = "avg(abs(pred - y)) AS mae, sqrt(avg((pred - y) * (pred - y))) AS rmse, avg(pred - y) AS me, 1 - sum((pred - y) * (pred - y)) / nullif(var_pop(y) * count(y), 0) AS r2"


@query("k:s, split:s, n:i, first:D, last:D", f"""WITH {HOURLY}, d AS (SELECT event_type AS k, CAST(ts AS DATE) AS d FROM hourly GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY d) AS i, count(*) OVER (PARTITION BY k) AS n FROM d),
 s AS (SELECT k, d, CASE WHEN i <= floor(n * 0.7 / 2) * 2 THEN 'train' WHEN i <= floor(n * 0.9 / 2) * 2 THEN 'val' ELSE 'test' END AS split FROM r)
 SELECT s.k, split, count(*) AS n, min(d) AS first, max(d) AS last FROM s JOIN hourly h ON h.event_type = s.k AND CAST(h.ts AS DATE) = s.d GROUP BY ALL""")
def I01_chrono_split(spark, sf):
    h = hourly(spark, sf).select(F.col("event_type").alias("k"), "ts", F.to_date("ts").alias("local_date"))
    s = scoring.chrono_split(h, {"train": 0.7, "val": 0.2, "test": 0.1}, ["k"], group=2)
    return s.groupBy("k", "split").agg(F.count("*").alias("n"), F.min("local_date").alias("first"), F.max("local_date").alias("last"))


@query("fold:i, part:s, n:i", f"""WITH {WIDE}, d AS (SELECT CAST(ts AS DATE) AS d, row_number() OVER (ORDER BY CAST(ts AS DATE)) - 1 AS i FROM wide GROUP BY 1), f AS (SELECT * FROM (VALUES (0, 5, 24, 26, 30), (1, 1, 20, 22, 26), (2, 0, 16, 18, 22)) f(fold, a, b, p, q))
 SELECT fold, CASE WHEN i >= a AND i < b THEN 'train' ELSE 'test' END AS part, count(*) AS n FROM f JOIN d ON (i >= a AND i < b) OR (i >= p AND i < q) JOIN wide ON CAST(ts AS DATE) = d GROUP BY ALL""")
def I02_folds(spark, sf):
    w = wide(spark, sf).withColumn("local_date", F.to_date("ts"))
    spec = scoring.folds(30, 3, 4, "sliding", gap=2, train=19)
    return scoring.with_folds(w, spec).groupBy("fold", "part").agg(F.count("*").alias("n"))


@query("k:s, model:s, mae:d, rmse:d, me:d, r2:d, n:i", f"WITH {PREDS} SELECT k, model, {METRICS}, count(*) AS n FROM preds GROUP BY ALL")
def I03_metrics(spark, sf):
    return scoring.metrics(preds(spark, sf), ["k", "model"])


@query("model:s, rmse:d, daily_max_rmse:d, rmse_std:d", f"WITH {PREDS}, h AS (SELECT model, date_part('hour', ts) AS slot, sqrt(avg((pred - y) * (pred - y))) AS h FROM preds GROUP BY ALL) SELECT model, sqrt(avg((pred - y) * (pred - y))) AS rmse, (SELECT max(h) FROM h WHERE h.model = preds.model) AS daily_max_rmse, (SELECT stddev_pop(h) FROM h WHERE h.model = preds.model) AS rmse_std FROM preds GROUP BY model")
def I04_daily_metrics(spark, sf):
    return scoring.daily_metrics(preds(spark, sf).withColumn("slot", F.hour("ts")), ["model"])


@query("k:s, rmse_skill:d, mae_skill:d", f"WITH {PREDS}, b AS (SELECT a.k, a.ts, a.y, a.pred, b.pred AS base FROM preds a JOIN preds b ON a.k = b.k AND a.ts = b.ts WHERE a.model = 'lag7' AND b.model = 'lag1') SELECT k, 1 - sqrt(avg((pred - y) * (pred - y))) / nullif(sqrt(avg((base - y) * (base - y))), 0) AS rmse_skill, 1 - avg(abs(pred - y)) / nullif(avg(abs(base - y)), 0) AS mae_skill FROM b GROUP BY k")
def I05_skill(spark, sf):
    p = preds(spark, sf)
    base = p.where("model = 'lag1'").select("k", "ts", F.col("pred").alias("base"))
    return scoring.skill(p.where("model = 'lag7'"), base, ["k"], by=["k"])


@query("model:s, metric:s, value:d", f"WITH {PREDS}, h AS (SELECT model, date_part('hour', ts) AS slot, sqrt(avg((pred - y) * (pred - y))) AS h FROM preds GROUP BY ALL), s AS (SELECT model, max(h) AS mx, stddev_pop(h) AS sd FROM h GROUP BY 1), m AS (SELECT model, {METRICS} FROM preds GROUP BY 1) SELECT model, unnest(['hourly_mae', 'hourly_rmse', 'hourly_me', 'hourly_r2', 'daily_mae', 'daily_rmse', 'daily_max_rmse', 'daily_rmse_std']) AS metric, unnest([mae, rmse, me, r2, mae, rmse, mx, sd]) AS value FROM m JOIN s USING (model)")
def I06_hourly_and_daily(spark, sf):
    return scoring.hourly_and_daily(preds(spark, sf).withColumn("slot", F.hour("ts")), ["model"])


FULL = f"{HOURLY}, s AS (SELECT event_type AS k, CAST(ts AS DATE) AS date, date_part('hour', ts) AS slot, value FROM hourly), full_ AS (SELECT k, date FROM s GROUP BY ALL HAVING count(*) = 24)"


def _daily_arrays(spark, sf):
    s = hourly(spark, sf).select(F.col("event_type").alias("k"), F.to_date("ts").alias("date"), F.hour("ts").alias("slot"), "value")
    return reshape.complete_days(s, ["k"])


@query("model:s, date:D, mae:d, rmse:d", f"WITH {FULL}, a AS (SELECT s.* FROM s JOIN full_ USING (k, date)) SELECT p.k AS model, p.date, avg(abs(p.value - y.value)) AS mae, sqrt(avg((p.value - y.value) ** 2)) AS rmse FROM a p JOIN a y ON y.date = p.date AND y.slot = p.slot AND y.k = 'view' WHERE p.k <> 'view' GROUP BY ALL")
def I07_model_day_errors(spark, sf):
    d = _daily_arrays(spark, sf)
    return scoring.model_day_errors(d.where("k <> 'view'").withColumnRenamed("k", "model"), d.where("k = 'view'").select("date", "values"))


@query("model:s, mae_mean:d, mae_std:d, rmse_mean:d, rmse_std:d", f"WITH {PREDS}, f AS (SELECT model, date_part('day', ts) % 3 AS fold, avg(abs(pred - y)) AS mae, sqrt(avg((pred - y) * (pred - y))) AS rmse FROM preds GROUP BY ALL) SELECT model, avg(mae) AS mae_mean, stddev_pop(mae) AS mae_std, avg(rmse) AS rmse_mean, stddev_pop(rmse) AS rmse_std FROM f GROUP BY model")
def I08_fold_summary(spark, sf):
    errors = scoring.metrics(preds(spark, sf).withColumn("fold", F.dayofmonth("ts") % 3), ["model", "fold"])
    return scoring.fold_summary(errors)


@query("baseline:s, transform:s, mae:d, rmse:d", f"WITH {PREDS}, t AS (SELECT model AS baseline, 'none' AS transform, y, pred FROM preds UNION ALL SELECT model, 'log_shift', y, exp(ln(pred + 2.0)) - 2.0 FROM preds) SELECT baseline, transform, avg(abs(pred - y)) AS mae, sqrt(avg((pred - y) * (pred - y))) AS rmse FROM t GROUP BY ALL")
def I10_transformed_baselines(spark, sf):
    return scoring.metrics(scoring.transformed_baselines(preds(spark, sf).withColumnRenamed("model", "baseline"), 2.0), ["baseline", "transform"])


@query("k:s, ts:t, pred:d", f"WITH {PREDS} SELECT k, ts, pred FROM preds WHERE model = 'lag1'")
def I11_stored_baseline(spark, sf):
    from tideline.registry import scratch

    path = f"{scratch(spark)}/baseline"
    preds(spark, sf).where("model = 'lag1'").write.partitionBy("model").parquet(path)
    return spark.read.parquet(path).where("model = 'lag1'")


#: A row a step: the fold's state, and the state of midnight that the day's forecasts are made from.
HOLT_WINTERS = f"""WITH RECURSIVE {HOURLY}, o AS (SELECT event_type AS k, value AS x, row_number() OVER (PARTITION BY event_type ORDER BY ts) - 1 AS i FROM hourly),
 head AS (SELECT k, avg(x) AS l, list(x ORDER BY i) AS xs FROM o WHERE i < 24 GROUP BY k HAVING count(*) = 24),
 r AS (SELECT k, 23 AS i, l, CAST(0 AS DOUBLE) AS b, list_transform(xs, lambda v: v - l) AS s, l AS fl, CAST(0 AS DOUBLE) AS fb, list_transform(xs, lambda v: v - l) AS fs, CAST(NULL AS DOUBLE) AS x, CAST(NULL AS DOUBLE) AS pred FROM head
 UNION ALL SELECT k, i, level AS l, (level - l) * 0.01 + b * 0.99 AS b, list_transform(s, lambda v, n: CASE WHEN n = place THEN (x - level) * 0.2 + season * 0.8 ELSE v END) AS s, fl, fb, fs, x, fl + fb * place + fs[place] AS pred
 FROM (SELECT k, i, l, b, s, x, place, season, (x - season) * 0.2 + (l + b) * 0.8 AS level, CASE WHEN place = 1 THEN l ELSE fl END AS fl, CASE WHEN place = 1 THEN b ELSE fb END AS fb, CASE WHEN place = 1 THEN s ELSE fs END AS fs
 FROM (SELECT r.k, CAST(r.i + 1 AS INT) AS i, r.l, r.b, r.s, r.fl, r.fb, r.fs, o.x, (r.i + 1) % 24 + 1 AS place, r.s[(r.i + 1) % 24 + 1] AS season FROM r JOIN o ON o.k = r.k AND o.i = r.i + 1)))
 SELECT k, avg(abs(pred - x)) AS mae, sqrt(avg((pred - x) * (pred - x))) AS rmse, count(*) AS n FROM r WHERE pred IS NOT NULL GROUP BY k"""


@query("k:s, mae:d, rmse:d, n:i", HOLT_WINTERS)
def I12_holt_winters(spark, sf):
    h = hourly(spark, sf).select(F.col("event_type").alias("k"), "ts", "value")
    return scoring.metrics(scoring.holt_winters_rolling(h, "value", ["k"]), ["k"])


@query("k:s, ts:t, pred:d", f"WITH {PREDS} SELECT k, ts, pred FROM preds WHERE model = 'lag2'")
def G11_naive(spark, sf):
    return preds(spark, sf).where("model = 'lag2'")


RUNS = "runs AS (SELECT CAST(p_partkey AS VARCHAR) AS run_id, p_type AS category, CASE WHEN p_partkey % 17 <> 0 THEN p_retailprice / p_size END AS mae, p_size * 1.5 AS rmse FROM part)"


def runs(spark, sf):
    return table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("run_id"), F.col("p_type").alias("category"), F.when(F.col("p_partkey") % 17 != 0, F.col("p_retailprice") / F.col("p_size")).alias("mae"), (F.col("p_size") * 1.5).alias("rmse"))


@query("category:s, run_id:s, avg_rank:d", f"WITH {RUNS}, r AS (SELECT *, (rank() OVER (PARTITION BY category ORDER BY mae NULLS FIRST) + rank() OVER (PARTITION BY category ORDER BY rmse)) / 2.0 AS avg_rank FROM runs) SELECT category, run_id, avg_rank FROM r QUALIFY row_number() OVER (PARTITION BY category ORDER BY avg_rank, mae NULLS FIRST, run_id) <= 2")
def G12_rank_runs(spark, sf):
    return blends.rank_runs(runs(spark, sf), ["mae", "rmse"], ["category"])


# ---- fits: rows only, as their numbers are the solver's ----


def matrix(spark, sf):
    """Hourly rows with simple features, a target and a split by day."""
    rows = days.with_local(hourly(spark, sf).select(F.col("event_type").alias("k"), "ts", F.col("value").alias("y")))
    lags = windows.same_hour_lag(rows.drop("local_date", "slot"), "y", [1, 7], ["k"])
    feats = windows.rolling(lags, ["y"], [WindowSpec(-7, -1, ("mean", "std"))], ["k"])
    feats = days.with_local(feats).na.fill(0.0, ["y_lag_1d", "y_lag_7d", "y_d7_d1_mean", "y_d7_d1_std"]).withColumn("slot_", F.col("slot").cast("double"))
    return pin(scoring.chrono_split(feats, {"train": 0.8, "test": 0.2}, ["k"])), ["y_lag_1d", "y_lag_7d", "y_d7_d1_mean", "y_d7_d1_std", "slot_"]


@query("name:s, value:d", f"WITH {WIDE} SELECT 'n_rows' AS name, count(*) FILTER (view IS NOT NULL) AS value FROM wide")
def J01_feature_set(spark, sf):
    from tideline.registry import scratch
    from tideline.sources.datasets import Datasets

    ds = Datasets(spark, f"{scratch(spark)}/datasets")
    ds.save(wide(spark, sf).select("ts", "click", "error", F.col("view").alias("y")), "base", "2024-02-01")
    return ds.load(name="base").agg(F.count("*").cast("double").alias("value")).select(F.lit("n_rows").alias("name"), "value")


@query("split:s, mae:d, rmse:d, me:d, r2:d")
def J02_train_and_score(spark, sf):
    df, xs = matrix(spark, sf)
    df = decay_weights(day_interactions(df, []), half_life=365)
    n, sd = models.moments(df)
    return models.train_and_score(df, xs, models.linear("ridge", 1.0, n, sd, weight="weight"))


@query("params:s, n_train:i, n_val:i, n_test:i, mae:d, rmse:d, val_mae:d, val_rmse:d")
def J02_recorded_run(spark, sf):
    """A log-shifted target, decayed weights, a validation part; the run as its table gives it back."""
    df, xs = matrix(spark, sf)
    df = decay_weights(scoring.chrono_split(df.drop("split"), {"train": 0.7, "val": 0.1, "test": 0.2}, ["k"]).transform(day_interactions, []), half_life=730)
    n, sd = models.moments(df.where("split = 'train'"))
    found = recorded.Runs(spark, scratch(spark))
    recorded.train_and_record(df, xs, models.linear("ridge", 1.0, n, sd, weight="weight"), found, "ridge", "hourly", {"alpha": 1.0}, "log_shift")
    return found.read("ridge").select("params", "n_train", "n_val", "n_test", "mae", "rmse", "val_mae", "val_rmse")


@query("params:s, mae:d, rmse:d")
def J03_linear_family(spark, sf):
    df, xs = matrix(spark, sf)
    n, sd = models.moments(df.where("split = 'train'"))
    return models.grid_search(df, xs, {"kind": ["ridge", "lasso", "elasticnet", "huber"]}, lambda kind: models.linear(kind, 0.1, n, sd))


@query("params:s, mae:d, rmse:d")
def J04_boosted(spark, sf):
    df, xs = matrix(spark, sf)
    return models.grid_search(df, xs, {"loss": ["squared", "absolute"], "level": list(models.LEVELS)}, lambda loss, level: models.boosted(loss, iterations=5, **models.LEVELS[level]))


@query("split:s, mae:d, rmse:d")
def J05_per_slot(spark, sf):
    df, xs = matrix(spark, sf)
    n, sd = models.moments(df)
    return scoring.metrics(models.per_slot(df, xs[:-1], lambda: models.linear("ridge", 1.0, n, sd)), ["split"])


def _drawn(rnd) -> dict:
    return {"kind": rnd.choice(["ridge", "lasso", "elasticnet"]), "alpha": round(10 ** rnd.uniform(-3, 2), 6)}


@query("trial:i, params:s, mae:d, rmse:d")
def J06_random_search(spark, sf):
    df, xs = matrix(spark, sf)
    n, sd = models.moments(df)
    return models.random_search(df, xs, _drawn, lambda kind, alpha: models.linear(kind, alpha, n, sd))


@query("params:s, mae:d, rmse:d")
def J06_grid_search(spark, sf):
    df, xs = matrix(spark, sf)
    n, sd = models.moments(df)
    return models.grid_search(df, xs, {"kind": ["ridge", "lasso"], "alpha": [0.1, 10.0]}, lambda kind, alpha: models.linear(kind, alpha, n, sd))


@query("dataset:s, params:s, mae:d, rmse:d")
def J06_resumed_search(spark, sf):
    """Datasets x parameters; the second call fits what the first has left and reads the rest from the run table."""
    df, xs = matrix(spark, sf)
    n, sd = models.moments(df)
    make = lambda kind, alpha: models.linear(kind, alpha, n, sd)
    data, found = {"lags": (df, xs[:2]), "all": (df, xs)}, recorded.Runs(spark, scratch(spark))
    trials = recorded.combinations({"kind": ["ridge"], "alpha": [0.1, 10.0]})
    recorded.search(data, trials[:1], make, found, "ridge")
    return recorded.search(data, trials, make, found, "ridge").select("dataset", "params", "mae", "rmse")


@query("params:s, cv_mae:d, chosen:b, mae:d, rmse:d")
def J07_cv_search(spark, sf):
    df, xs = matrix(spark, sf)
    n, sd = models.moments(df)
    return models.cv_search(df, xs, {"kind": ["ridge", "lasso"], "alpha": [0.1, 10.0]}, lambda kind, alpha: models.linear(kind, alpha, n, sd), 3, 4, ["k"])


@query("params:s, mae:d, rmse:d")
def J08_retrain(spark, sf):
    df, xs = matrix(spark, sf)
    n, sd = models.moments(df)
    make = lambda kind, alpha: models.linear(kind, alpha, n, sd)
    runs = pin(models.random_search(df, xs, _drawn, make, trials=4, seed=8))
    return models.retrain_best(df, xs, runs, make)


FOUR = ("y_lag_1d", "y_lag_7d", "y_d7_d1_mean", "y_d7_d1_std")
#: ``matrix`` in SQL.
MATRIX = f"""{HOURLY}, loc AS (SELECT event_type AS k, ts, value AS y, CAST(ts + INTERVAL 1 HOUR AS DATE) AS d, hour(ts + INTERVAL 1 HOUR) AS slot FROM hourly),
 st AS (SELECT a.k, a.d, avg(x.y) AS m, stddev_samp(x.y) AS s FROM (SELECT DISTINCT k, d FROM loc) a JOIN loc x ON x.k = a.k AND x.d BETWEEN a.d - 7 AND a.d - 1 GROUP BY ALL),
 mx AS (SELECT a.k, a.ts, a.d, a.slot, a.y, coalesce(b.y, 0) AS y_lag_1d, coalesce(c.y, 0) AS y_lag_7d, coalesce(st.m, 0) AS y_d7_d1_mean, coalesce(st.s, 0) AS y_d7_d1_std FROM loc a
 LEFT JOIN loc b ON b.k = a.k AND b.d = a.d - 1 AND b.slot = a.slot LEFT JOIN loc c ON c.k = a.k AND c.d = a.d - 7 AND c.slot = a.slot LEFT JOIN st ON st.k = a.k AND st.d = a.d)"""


def _correlated() -> str:
    """Rank correlations by means of ranks; of two features that are all but the same the one further from the target goes."""
    ranks = ", ".join(f"rank() OVER (ORDER BY round({x}, 9)) + (count(*) OVER (PARTITION BY round({x}, 9)) - 1) / 2.0 AS r_{x}" for x in (*FOUR, "y"))
    rho = " UNION ALL ".join(f"SELECT {i} AS i, '{x}' AS feature, abs(corr(r_{x}, r_y)) AS rho FROM rk" for i, x in enumerate(FOUR))
    pairs = " UNION ALL ".join(f"SELECT {i} AS i, {j} AS j, abs(corr({a}, {b})) AS p FROM rk" for i, a in enumerate(FOUR) for j, b in enumerate(FOUR) if i != j)
    return f"WITH {MATRIX}, rk AS (SELECT *, {ranks} FROM mx), rho AS ({rho}), pairs AS ({pairs}) SELECT feature FROM rho a WHERE rho >= 0.02 AND NOT EXISTS (SELECT 1 FROM pairs p JOIN rho b ON b.i = p.j WHERE p.i = a.i AND p.p > 0.9999 AND (b.rho > a.rho OR (b.rho = a.rho AND b.i < a.i)))"


@query("feature:s", _correlated())
def J09_correlation_filter(spark, sf):
    df, _ = matrix(spark, sf)
    return spark.createDataFrame([(x,) for x in models.correlation_filter(df, list(FOUR))], "feature string")


@query("n:i, mae:d, rmse:d")
def J10_importance_sweep(spark, sf):
    df, xs = matrix(spark, sf)
    gbt = models.boosted(iterations=3)
    ranked = [f for f, _ in models.importances(df.where("split = 'train'"), xs, gbt)]
    return models.top_n_sweep(df, ranked, gbt, [2, 4])


@query("n:i, stage:s, mae:d, rmse:d, chosen:b")
def J10_coarse_to_fine(spark, sf):
    df, xs = matrix(spark, sf)
    n, sd = models.moments(df)
    ranked = [f for f, _ in models.importances(df.where("split = 'train'"), xs, models.boosted(iterations=2))]
    return models.top_n_search(df, ranked, models.linear("ridge", 1.0, n, sd), coarse=(2, 4, 6), reach=1, step=1)


@query("n_features:i, rmse:d")
def J11_elimination(spark, sf):
    df, xs = matrix(spark, sf)
    path, _ = models.eliminate(df, xs, models.boosted(iterations=2), step=2, least=3, n_splits=2)
    return spark.createDataFrame(path, "n_features int, rmse double")


@query("params:s, mae:d, rmse:d")
def J12_compare_sets(spark, sf):
    df, xs = matrix(spark, sf)
    n, sd = models.moments(df)
    out = None
    for name, part in (("lags", xs[:2]), ("all", xs)):
        r = models.train_and_score(df, part, models.linear("ridge", 1.0, n, sd)).where("split = 'test'").select(F.lit(name).alias("params"), "mae", "rmse")
        out = r if out is None else out.unionByName(r)
    return out


@query("model:s, fold:i, mae:d, rmse:d")
def I09_fold_table(spark, sf):
    df, xs = matrix(spark, sf)
    n, sd = models.moments(df)
    return models.cv_score(df, xs, models.linear("lasso", 0.1, n, sd), 2, 5, ["k"], "lasso")


# ---- ensembles ----


@query("run_id:s, category:s, chosen_by:s", f"""WITH {RUNS}, r AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY mae, run_id) AS i FROM runs WHERE mae IS NOT NULL), top_ AS (SELECT run_id, category, 'top' AS chosen_by FROM r WHERE i <= 3),
 drawn AS (SELECT run_id, category, 'drawn' AS chosen_by FROM (SELECT * FROM r WHERE i BETWEEN 4 AND 13) QUALIFY row_number() OVER (PARTITION BY category ORDER BY md5(run_id || '42')) <= 2),
 c AS (SELECT * FROM top_ UNION ALL SELECT * FROM drawn) SELECT * FROM c UNION ALL SELECT run_id, category, 'forced' FROM r WHERE run_id IN ('5', '7') AND run_id NOT IN (SELECT run_id FROM c)""")
def K01_candidates(spark, sf):
    return blends.candidates(runs(spark, sf), forced=["5", "7"])


@query("category:s, model:s, role:s", """WITH cv AS (SELECT p_brand AS category, CAST(p_partkey AS VARCHAR) AS model, p_retailprice AS mae_mean, p_size * 1.0 AS rmse_mean FROM part), r AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY mae_mean, model) AS a, row_number() OVER (PARTITION BY category ORDER BY rmse_mean, model) AS b FROM cv),
 s AS (SELECT *, max(CASE WHEN a = 1 AND b = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY category) AS same FROM r) SELECT category, model, CASE WHEN a = 1 THEN 'mae' ELSE 'rmse' END AS role FROM s WHERE a = 1 OR b = CASE WHEN same = 1 THEN 2 ELSE 1 END""")
def K02_final_models(spark, sf):
    cv = table(spark, sf, "part").select(F.col("p_brand").alias("category"), F.col("p_partkey").cast("string").alias("model"), F.col("p_retailprice").alias("mae_mean"), (F.col("p_size") * 1.0).alias("rmse_mean"))
    return blends.final_models(cv)


WEIGHTS = f"{PREDS}, e AS (SELECT k, model, avg(abs(pred - y)) AS mae FROM preds GROUP BY ALL), w AS (SELECT k, model, (1 / (mae + 1e-6)) / sum(1 / (mae + 1e-6)) OVER (PARTITION BY k) AS weight FROM e)"


def weights(spark, sf):
    return blends.inverse_mae_weights(blends.errors_by_model(preds(spark, sf), ["k"]), ["k"])


@query("k:s, model:s, weight:d", f"WITH {WEIGHTS} SELECT * FROM w")
def K03_inverse_mae(spark, sf):
    return weights(spark, sf)


BLEND = f"{WEIGHTS}, b AS (SELECT k, ts, max(y) AS y, sum(weight * pred) AS pred FROM preds JOIN w USING (k, model) GROUP BY ALL HAVING count(*) = 3)"


@query("k:s, mae:d, rmse:d", f"WITH {PREDS}, tr AS (SELECT * FROM preds WHERE ts < TIMESTAMP '2024-01-25'), e AS (SELECT k, model, avg(abs(pred - y)) AS mae FROM tr GROUP BY ALL), w AS (SELECT k, model, (1 / (mae + 1e-6)) / sum(1 / (mae + 1e-6)) OVER (PARTITION BY k) AS weight FROM e), b AS (SELECT k, ts, max(y) AS y, sum(weight * pred) AS pred FROM preds JOIN w USING (k, model) WHERE ts >= TIMESTAMP '2024-01-25' GROUP BY ALL HAVING count(*) = 3) SELECT k, avg(abs(pred - y)) AS mae, sqrt(avg((pred - y) * (pred - y))) AS rmse FROM b GROUP BY k")
def K04_blend_holdout(spark, sf):
    p, cut = preds(spark, sf), F.lit("2024-01-25").cast("timestamp")
    w = blends.inverse_mae_weights(blends.errors_by_model(p.where(F.col("ts") < cut), ["k"]), ["k"])
    return scoring.metrics(blends.apply_weights(p.where(F.col("ts") >= cut), w, ["k"], ["k"]), ["k"])


@query("k:s, ts:t, pred:d", f"WITH {BLEND} SELECT k, ts, pred FROM b")
def K05_apply_weights(spark, sf):
    return blends.apply_weights(preds(spark, sf), weights(spark, sf), ["k"], ["k"])


TRAIL = f"{PREDS}, r AS (SELECT * FROM preds WHERE ts > (SELECT max(ts) FROM preds) - INTERVAL 10 DAY), e AS (SELECT k, model, avg(abs(pred - y)) AS mae FROM r GROUP BY ALL) SELECT k, model, (1 / (mae + 1e-6)) / sum(1 / (mae + 1e-6)) OVER (PARTITION BY k) AS weight FROM e"


@query("k:s, model:s, weight:d", f"WITH {TRAIL}")
def K06_refresh_weights(spark, sf):
    return blends.trailing_weights(preds(spark, sf), 10, ["k"])


@query("k:s, date:D, degradation_pct:d, needs_reselection:b", f"WITH {DAILY}, h AS (SELECT k, date, price AS new_, lag(price) OVER (PARTITION BY k ORDER BY date) AS old_ FROM daily) SELECT k, date, (new_ - old_) / nullif(old_, 0) * 100 AS degradation_pct, coalesce((new_ - old_) / nullif(old_, 0) > 0.2 + 1e-12, FALSE) AS needs_reselection FROM h QUALIFY row_number() OVER (PARTITION BY k ORDER BY date DESC) <= 52")
def K07_retrain_history(spark, sf):
    h = daily(spark, sf).select("k", "date", F.lag("price").over(Window.partitionBy("k").orderBy("date")).alias("old_blend_mae"), F.col("price").alias("new_blend_mae"))
    return jobs.retrain_history(h.where("year(date) < 2001"), h.where("year(date) >= 2001"), keys=["k"])


@query("k:s, ts:t, mean_pred:d, median_pred:d", f"WITH {PREDS} SELECT k, ts, avg(pred) AS mean_pred, median(pred) AS median_pred FROM preds GROUP BY ALL")
def K08_simple_blend(spark, sf):
    return blends.simple_blend(preds(spark, sf), ["k"])


SPREAD = f"{PREDS}, sp AS (SELECT k, ts, max(y) AS y, max(pred) FILTER (model = 'lag1') AS lag1, max(pred) FILTER (model = 'lag2') AS lag2, max(pred) FILTER (model = 'lag7') AS lag7 FROM preds GROUP BY ALL HAVING count(*) = 3)"


def _spread(spark, sf):
    return pin(blends.spread(preds(spark, sf), list(LAGS), ["k"]))


def _greedy() -> str:
    """All blends of three models, and the way from the best single one through the better pair."""
    names = list(LAGS)
    blend = lambda ms: f"avg(abs(({' + '.join(f'{m} * w_{m}' for m in ms)}) / ({' + '.join(f'w_{m}' for m in ms)}) - y))"
    pairs = [(a, b) for a in names for b in names if a != b]
    return f"""WITH {SPREAD}, e AS (SELECT {', '.join(f'avg(abs({m} - y)) AS e_{m}, 1 / (avg(abs({m} - y)) + 1e-6) AS w_{m}' for m in names)} FROM sp),
 one AS (SELECT model, mae FROM ({' UNION ALL '.join(f"SELECT '{m}' AS model, e_{m} AS mae FROM e" for m in names)}) ORDER BY mae, model LIMIT 1),
 two AS (SELECT p.model, p.mae FROM ({' UNION ALL '.join(f"SELECT '{a}' AS a, '{b}' AS model, {blend((a, b))} AS mae FROM sp, e" for a, b in pairs)}) p JOIN one ON one.model = p.a ORDER BY p.mae, p.model LIMIT 1)
 SELECT 1 AS step, model, mae FROM one UNION ALL SELECT 2, model, mae FROM two UNION ALL SELECT 3, m, (SELECT {blend(names)} FROM sp, e) FROM (VALUES {', '.join(f"('{m}')" for m in names)}) t(m) WHERE m NOT IN (SELECT model FROM one UNION SELECT model FROM two)"""


@query("step:i, model:s, mae:d", _greedy())
def K09_greedy(spark, sf):
    return spark.createDataFrame(blends.greedy_selection(_spread(spark, sf), list(LAGS)), "step int, model string, mae double")


def _subset(alpha: float) -> str:
    cells = []
    names = list(LAGS)
    for mask in range(1, 8):
        ms = [m for i, m in enumerate(names) if mask >> i & 1]
        pairs = [f"corr({a}, {b})" for i, a in enumerate(ms) for b in ms[:i]]
        pen = f"({' + '.join(pairs)}) / {len(pairs)}" if pairs else "0.0"
        cells.append(f"SELECT {mask} AS mask, {len(ms)} AS n_models, avg(abs(({' + '.join(ms)}) / {len(ms)} - y)) AS mae, {pen} AS penalty, avg(abs(({' + '.join(ms)}) / {len(ms)} - y)) + {alpha} * ({pen}) AS score FROM sp")
    return f"WITH {SPREAD} " + " UNION ALL ".join(cells)


@query("mask:i, n_models:i, mae:d", _subset(0.0))
def K10_subsets(spark, sf):
    return blends.subset_scores(_spread(spark, sf), list(LAGS))


def _climb() -> str:
    """From the best single model to the best neighbour, for as long as that betters the mean."""
    names, cells = list(LAGS), []
    for mask in range(1, 8):
        ms = [m for i, m in enumerate(names) if mask >> i & 1]
        cells.append(f"SELECT {mask} AS mask, {len(ms)} AS n, '{'+'.join(ms)}' AS models, avg(abs(({' + '.join(ms)}) / {len(ms)} - y)) AS mae FROM sp")
    return f"""WITH RECURSIVE {SPREAD}, sets AS ({' UNION ALL '.join(cells)}), walk AS (SELECT 0 AS step, mask, models, mae FROM (SELECT * FROM sets WHERE n = 1 ORDER BY mae, models LIMIT 1)
 UNION ALL SELECT * FROM (SELECT w.step + 1 AS step, s.mask, s.models, s.mae FROM walk w JOIN sets s ON bit_count(xor(w.mask, s.mask)) = 1 AND s.mae < w.mae ORDER BY s.mae, s.models LIMIT 1)) SELECT step, models, mae FROM walk"""


@query("step:i, models:s, mae:d", _climb())
def K10_hill_climb(spark, sf):
    return spark.createDataFrame(blends.hill_climb(_spread(spark, sf), list(LAGS)), "step int, models string, mae double")


def _best_mean() -> str:
    cells = []
    names = list(LAGS)
    for mask in range(1, 8):
        ms = [m for i, m in enumerate(names) if mask >> i & 1]
        cells.append(f"SELECT '{'+'.join(ms)}' AS models, avg(abs(({' + '.join(ms)}) / {len(ms)} - y)) AS mae FROM sp")
    return f"WITH {SPREAD} SELECT * FROM ({' UNION ALL '.join(cells)}) ORDER BY mae LIMIT 1"


@query("models:s, mae:d", _best_mean())
def K10_annealing(spark, sf):
    found, mae = blends.annealing(_spread(spark, sf), list(LAGS), chains=6, rounds=20)
    return spark.createDataFrame([("+".join(found), mae)], "models string, mae double")


@query("mask:i, n_models:i, mae:d, penalty:d, score:d", _subset(0.5))
def K11_diversity(spark, sf):
    return blends.subset_scores(_spread(spark, sf), list(LAGS), alpha=0.5)


@query("loss:s, model:s, weight:d")
def K12_simplex(spark, sf):
    t = _spread(spark, sf)
    rows = [(loss, m, w) for loss in ("rmse", "mae") for m, w in blends.simplex_weights(t, list(LAGS), loss).items()]
    return spark.createDataFrame(rows, "loss string, model string, weight double")


@query("model:s, weight:d", f"WITH {PREDS}, r AS (SELECT * FROM preds WHERE ts > (SELECT max(ts) FROM preds) - INTERVAL 15 DAY), e AS (SELECT model, avg(abs(pred - y)) AS mae FROM r GROUP BY ALL) SELECT model, (1 / (mae + 1e-6)) / sum(1 / (mae + 1e-6)) OVER () AS weight FROM e")
def K13_trailing(spark, sf):
    return blends.trailing_weights(preds(spark, sf), 15)


@query("n:i, mae:d, rmse:d", f"""WITH {PREDS}, e AS (SELECT model, avg(abs(pred - y)) AS mae, row_number() OVER (ORDER BY avg(abs(pred - y)), model) AS r FROM preds GROUP BY model), x AS (SELECT n, model, (1 / (mae + 1e-6)) / sum(1 / (mae + 1e-6)) OVER (PARTITION BY n) AS weight FROM e, range(1, 4) t(n) WHERE r <= n),
 b AS (SELECT n, k, ts, max(y) AS y, sum(weight * pred) AS pred FROM preds JOIN x USING (model) GROUP BY ALL HAVING count(*) = n) SELECT n, avg(abs(pred - y)) AS mae, sqrt(avg((pred - y) * (pred - y))) AS rmse FROM b GROUP BY n""")
def K14_incremental(spark, sf):
    return blends.incremental_blends(preds(spark, sf), ["k"])


def _nonnegative() -> str:
    """Of the solutions on every support, by Cramer's rule, the best one without a negative weight."""
    names = list(LAGS)
    g = lambda i, j: f"avg({names[i]} * {names[j]})"
    sums = ", ".join([f"{g(i, j)} AS g{i}{j}" for i in range(3) for j in range(3)] + [f"avg({m} * y) AS x{i}" for i, m in enumerate(names)])

    def det(rows):
        if len(rows) == 1:
            return rows[0][0]
        return "(" + " + ".join(f"{'' if j % 2 == 0 else '-1 * '}{rows[0][j]} * {det([r[:j] + r[j + 1 :] for r in rows[1:]])}" for j in range(len(rows))) + ")"

    cells = []
    for mask in range(1, 8):
        at = [i for i in range(3) if mask >> i & 1]
        base = [[f"g{i}{j}" for j in at] for i in at]
        w = {i: f"{det([[f'x{r}' if col == k else base[n][col] for col in range(len(at))] for n, r in enumerate(at)])} / {det(base)}" for k, i in enumerate(at)}
        cells.append("SELECT " + ", ".join(f"{w.get(i, '0.0')} AS w{i}" for i in range(3)) + ", * FROM g")
    loss = " + ".join(f"w{i} * w{j} * g{i}{j}" for i in range(3) for j in range(3)) + "".join(f" - 2 * w{i} * x{i}" for i in range(3))
    best = f"WITH {SPREAD}, g AS (SELECT {sums} FROM sp), s AS ({' UNION ALL '.join(cells)}), b AS (SELECT * FROM s WHERE least(w0, w1, w2) >= 0 ORDER BY {loss} LIMIT 1) "
    return best + " UNION ALL ".join(f"SELECT '{m}' AS model, w{i} AS weight FROM b" for i, m in enumerate(names))


@query("model:s, weight:d", _nonnegative())
def K15_nonnegative(spark, sf):
    return spark.createDataFrame(list(blends.nonnegative_weights(_spread(spark, sf), list(LAGS)).items()), "model string, weight double")


@query("params:s, mae:d, rmse:d")
def K15_stacking(spark, sf):
    t = _spread(spark, sf).withColumn("local_date", F.to_date("ts"))
    df = scoring.chrono_split(t, {"train": 0.8, "test": 0.2})
    n, sd = models.moments(df.where("split = 'train'"))
    linear = models.grid_search(df, list(LAGS), {"meta": ["ridge", "lasso", "elasticnet", "huber"]}, lambda meta: models.linear(meta, 0.1, n, sd))
    return linear.unionByName(models.grid_search(df, list(LAGS), {"meta": ["gbt"]}, lambda meta: models.boosted(iterations=5, depth=3)))


@query("split:s, n:i", f"WITH {PREDS}, d AS (SELECT CAST(ts AS DATE) AS d FROM preds GROUP BY 1), r AS (SELECT d, row_number() OVER (ORDER BY d) AS i, count(*) OVER () AS n FROM d) SELECT CASE WHEN i <= floor(n * 0.8) THEN 'oof' WHEN i <= floor(n * 0.95) THEN 'test' ELSE 'rest' END AS split, count(*) AS n FROM r JOIN preds ON CAST(ts AS DATE) = d GROUP BY 1")
def K16_three_way(spark, sf):
    p = preds(spark, sf).withColumn("local_date", F.to_date("ts"))
    return scoring.chrono_split(p, {"oof": 0.8, "test": 0.15, "rest": 0.05}).groupBy("split").agg(F.count("*").alias("n"))


@query("method:s, mae:d, rmse:d, uses_test_data:b", f"WITH {BLEND}, m AS (SELECT k, ts, max(y) AS y, avg(pred) AS pred FROM preds GROUP BY ALL) SELECT 'inverse_mae' AS method, avg(abs(pred - y)) AS mae, sqrt(avg((pred - y) * (pred - y))) AS rmse, TRUE AS uses_test_data FROM b UNION ALL SELECT 'mean', avg(abs(pred - y)), sqrt(avg((pred - y) * (pred - y))), FALSE FROM m")
def K17_comparison(spark, sf):
    p = preds(spark, sf)
    simple = blends.simple_blend(p, ["k"]).withColumnRenamed("mean_pred", "pred")
    return blends.comparison({"inverse_mae": blends.apply_weights(p, weights(spark, sf), ["k"], ["k"]), "mean": simple}, {"inverse_mae"})


# ---- jobs ----


def _merged(spark, sf, max_gap):
    w = wide(spark, sf, thin=True)
    commodities = hourly(spark, sf).where("event_type = 'error'").groupBy(F.to_date("ts").alias("date")).agg(F.avg("value").alias("price"))
    fall = wide(spark, sf).select("ts", F.col("view").alias("value"))
    rules = [("copy", "click", "signup"), ("difference", "purchase", "view", "error")]
    return jobs.merge_job(w, w, fall, commodities, "2024-01-15", "2024-01-20", ["view"], rules, max_gap=max_gap)


@query("local_date:D, slot:i, target_price:d, click:d, price:d, regime_before_split:i")
def L01_merge_job(spark, sf):
    return _merged(spark, sf, 5)


@query("local_date:D, slot:i, target_price:d, click:d, purchase:d, price:d, regime_before_split:i", f"""WITH {THIN}, {WIDE}, {HOURLY}, c AS (SELECT CAST(ts AS DATE) AS date, avg(value) AS price FROM hourly WHERE event_type = 'error' GROUP BY 1)
 SELECT CAST(t.ts + INTERVAL 1 HOUR AS DATE) AS local_date, hour(t.ts + INTERVAL 1 HOUR) AS slot, coalesce(t.view, w.view) AS target_price, coalesce(t.click, t.signup) AS click, coalesce(t.purchase, t.view - t.error) AS purchase, c.price, CAST(t.ts < TIMESTAMP '2024-01-15' AS INT) AS regime_before_split
 FROM thin t JOIN wide w ON w.ts = t.ts ASOF LEFT JOIN c ON CAST(t.ts AS DATE) >= c.date""")
def L01_merge_job_rules(spark, sf):
    """The job without its splines."""
    return _merged(spark, sf, 0)


@query("region:s, ts:t, view:d, click:d, purchase:d, signup:d, error:d", f"WITH {WIDE} SELECT 'north' AS region, * FROM wide UNION ALL SELECT 'south', * FROM wide WHERE date_part('hour', ts) < 12")
def L02_combine_job(spark, sf):
    long = hourly(spark, sf).select("ts", F.col("event_type").alias("column_name"), "value")
    return jobs.combine_job({"north": long, "south": long.where("hour(ts) < 12")}, list(TYPES))


@query("ts:t, view:d, forecast_source:i", f"""WITH {WIDE}, x AS (SELECT ts, view, 0 AS p FROM wide WHERE date_part('hour', ts) = 3 UNION ALL SELECT ts, click, 1 FROM wide WHERE date_part('hour', ts) < 6 UNION ALL SELECT ts, error, 2 FROM wide WHERE date_part('hour', ts) < 12), c AS (SELECT ts, view FROM x QUALIFY row_number() OVER (PARTITION BY ts ORDER BY p) = 1)
 SELECT w.ts, CASE WHEN c.ts IS NOT NULL THEN CASE WHEN c.view < 0 THEN 0 ELSE c.view END ELSE w.view END AS view, CAST(c.ts IS NOT NULL AS INT) AS forecast_source FROM wide w LEFT JOIN c USING (ts)""")
def L03_overlay_job(spark, sf):
    w = wide(spark, sf)
    of = lambda x, h: w.where(h).select("ts", F.col(x).alias("view"))
    snaps = of("click", "hour(ts) < 6").withColumn("snapshot_date", F.to_date("ts"))
    return jobs.overlay_job(w.select("ts", "view"), of("view", "hour(ts) = 3"), snaps, of("error", "hour(ts) < 12"), ["view"])


@query("k:s, ts:t, model:s, pred:d", f"WITH {PREDS}, e AS (SELECT model, avg(abs(pred - y)) AS mae FROM preds GROUP BY ALL), w AS (SELECT model, (1 / (mae + 1e-6)) / sum(1 / (mae + 1e-6)) OVER () AS weight FROM e), d AS (SELECT * FROM preds WHERE ts >= TIMESTAMP '2024-01-30') SELECT k, ts, model, round(pred, 5) AS pred FROM d UNION ALL SELECT k, ts, 'blend', round(sum(weight * pred), 5) FROM d JOIN w USING (model) GROUP BY k, ts HAVING count(*) = 3")
def L04_forecast_job(spark, sf):
    p = preds(spark, sf)
    w = blends.inverse_mae_weights(blends.errors_by_model(p))
    return jobs.forecast_job(p.where("ts >= TIMESTAMP '2024-01-30'"), w, ["k"], decimals=5)


@query("k:s, as_of:D, history_rows:i, n:i, hidden:i", f"WITH {HOURLY}, d AS (SELECT event_type AS k, CAST(ts AS DATE) AS d, count(*) AS c FROM hourly GROUP BY ALL), h AS (SELECT a.k, a.d AS as_of, a.c AS n, sum(b.c) AS history_rows FROM d a JOIN d b ON a.k = b.k AND b.d < a.d WHERE a.d >= DATE '2024-01-20' GROUP BY ALL) SELECT k, as_of, history_rows, n, n AS hidden FROM h WHERE history_rows >= 480")
def L05_backfill(spark, sf):
    h = hourly(spark, sf).select(F.col("event_type").alias("k"), "ts", F.col("value").alias("y"), F.to_date("ts").alias("local_date"))
    dates = h.where("local_date >= DATE '2024-01-20'").select(F.col("local_date").alias("as_of"))
    rows = jobs.as_of_rows(h, dates, "y", least_rows=480, keys=["k"])
    return rows.groupBy("k", "as_of", "history_rows").agg(F.count("*").alias("n"), F.count_if(F.col("y").isNull()).alias("hidden"))


@query("k:s, date:D, total:d", f"WITH {FULL}, a AS (SELECT s.k, s.date, sum(value) AS total FROM s JOIN full_ USING (k, date) GROUP BY ALL), b AS (SELECT k, date, total * CASE WHEN date >= DATE '2024-01-15' THEN 2 ELSE 1 END AS total FROM a) SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY k ORDER BY date DESC) <= 5")
def L06_history(spark, sf):
    from tideline.sources.datasets import upsert_history

    d = _daily_arrays(spark, sf).withColumn("generated_at", F.lit("2024-02-01").cast("timestamp"))
    newer = d.where("date >= DATE '2024-01-15'").withColumns({"values": F.transform("values", lambda x: x * 2), "generated_at": F.lit("2024-02-02").cast("timestamp")})
    return upsert_history(d, newer, 5, keys=["k"]).withColumn("total", F.aggregate("values", F.lit(0.0), lambda a, x: a + x))


@query("name:s, last_valid:t, hours_old:d, status:s, level:i", f"WITH {WIDE} " + " UNION ALL ".join(f"SELECT '{t}' AS name, max(ts) FILTER ({t} IS NOT NULL) AS last_valid, epoch(TIMESTAMP '2024-01-31' - max(ts) FILTER ({t} IS NOT NULL)) / 3600.0 AS hours_old, CASE WHEN count({t}) = 0 THEN 'MISSING' WHEN epoch(TIMESTAMP '2024-01-31' - max(ts) FILTER ({t} IS NOT NULL)) / 3600.0 > 1.5 THEN 'STALE' ELSE 'OK' END AS status, CASE WHEN count({t}) = 0 THEN 2 WHEN epoch(TIMESTAMP '2024-01-31' - max(ts) FILTER ({t} IS NOT NULL)) / 3600.0 > 1.5 THEN 1 ELSE 0 END AS level FROM wide" for t in TYPES))
def L07_freshness(spark, sf):
    return jobs.freshness(wide(spark, sf), list(TYPES), "2024-01-31", 1.5)


@query("name:s, status:s, hours_old:d, level:i", f"""WITH {WIDE}, a AS (SELECT 'fresh' AS name, max(ts) AS last, 24 AS most FROM wide UNION ALL SELECT 'old', max(ts) FILTER (ts < TIMESTAMP '2024-01-20'), 24 FROM wide WHERE click IS NOT NULL UNION ALL SELECT 'silent', NULL, 24 UNION ALL SELECT 'damaged', NULL, 24),
 r AS (SELECT name, epoch(TIMESTAMP '2024-01-31' - last) / 3600.0 AS hours_old, CASE WHEN last IS NULL THEN 'ERROR' WHEN epoch(TIMESTAMP '2024-01-31' - last) / 3600.0 > most THEN 'STALE' ELSE 'OK' END AS status FROM a UNION ALL SELECT 'absent', NULL, 'MISSING')
 SELECT name, status, hours_old, CASE status WHEN 'OK' THEN 0 WHEN 'STALE' THEN 1 ELSE 2 END AS level FROM r UNION ALL SELECT 'overall', 'CRITICAL', NULL, 2""")
def L07_freshness_report(spark, sf):
    base, w = scratch(spark), wide(spark, sf)
    w.write.parquet(f"{base}/fresh")
    w.where("ts < TIMESTAMP '2024-01-20' AND click IS NOT NULL").select("ts", "click").write.parquet(f"{base}/old")
    w.select("ts", F.lit(None).cast("double").alias("view")).write.parquet(f"{base}/silent")
    w.select(F.col("ts").cast("string").alias("value")).write.text(f"{base}/damaged")
    return jobs.freshness_report(spark, {n: (f"{base}/{n}", 24) for n in ("fresh", "old", "silent", "damaged", "absent")}, "2024-01-31")


ROLES = pipelines.Roles(target="view", neighbours=("click",), actuals=("purchase",), morning=("purchase",), generation=("purchase", "signup"), renewable=("signup",), load="error", forecast_total="error", forecast_parts=("signup",), forecasts=("signup", "error"), commodities=("error",), flows=(("click", "purchase", "x"),))


@query("ts:t, y:d, view_d7_d7_mean:d, view_d30_d1_max:d", f"""WITH {WIDE}, loc AS (SELECT ts, CAST(ts + INTERVAL 1 HOUR AS DATE) AS d, view FROM wide), ds AS (SELECT DISTINCT d FROM loc),
 st AS (SELECT ds.d, avg(x.view) FILTER (x.d = ds.d - 7) AS view_d7_d7_mean, max(x.view) AS view_d30_d1_max FROM ds LEFT JOIN loc x ON x.d BETWEEN ds.d - 30 AND ds.d - 1 GROUP BY 1)
 SELECT ts, view AS y, view_d7_d7_mean, view_d30_d1_max FROM loc JOIN st USING (d)""")
def L08_pipeline_v5_slim(spark, sf):
    out = pipelines.compile_steps(pipelines.pipeline("v5_slim", ROLES, 10))(wide(spark, sf))
    return out.withColumnRenamed("view_d7_mean", "view_d7_d7_mean")


LAGGED = lambda hours, name: f"(SELECT view FROM wide p WHERE p.ts = w.ts - to_hours({hours})) AS {name}"
#: Local hours: the whole month is an hour ahead of UTC.
SLOTS = f"{WIDE}, loc AS (SELECT CAST(ts + INTERVAL 1 HOUR AS DATE) AS local_date, date_part('hour', ts + INTERVAL 1 HOUR) AS slot, view, signup FROM wide), d AS (SELECT local_date, max(view) FILTER (slot = 0) AS y_0, max(view) FILTER (slot = 5) AS v5, max(signup) FILTER (slot = 3) AS signup_3 FROM loc GROUP BY 1)"
PRICES = f"WITH {SLOTS} SELECT d.local_date, d.y_0, p.v5 AS price_lag_5 FROM d LEFT JOIN d p ON p.local_date = d.local_date - INTERVAL 1 DAY"


def _version(spark, sf, name):
    return pipelines.compile_steps(pipelines.pipeline(name, ROLES, 10))(wide(spark, sf))


@query("ts:t, spread_click:d, ratio_click:d", f"WITH {WIDE} SELECT ts, view - click AS spread_click, view / nullif(click, 0) AS ratio_click FROM wide")
def L08_pipeline_v1_hourly(spark, sf):
    return _version(spark, sf, "v1_hourly")


@query("local_date:D, signup_3:d", f"WITH {SLOTS} SELECT local_date, signup_3 FROM d")
def L08_pipeline_v1_daily(spark, sf):
    return _version(spark, sf, "v1_daily")


@query("local_date:D, y_0:d, price_lag_5:d", PRICES)
def L08_pipeline_v1_preprocessor(spark, sf):
    return _version(spark, sf, "v1_preprocessor")


@query("ts:t, view:d", f"WITH {WIDE} SELECT ts, view FROM wide")
def L08_pipeline_v1_ml(spark, sf):
    return _version(spark, sf, "v1_ml")


@query("local_date:D, y_0:d, price_lag_5:d", PRICES)
def L08_pipeline_v2(spark, sf):
    return _version(spark, sf, "v2")


@query("local_date:D, y_0:d, price_lag_5:d", PRICES)
def L08_pipeline_v3(spark, sf):
    return _version(spark, sf, "v3")


@query("ts:t, y:d, view_lag_1d:d, view_lag_7d:d", f"WITH {WIDE} SELECT ts, view AS y, {LAGGED(24, 'view_lag_1d')}, {LAGGED(168, 'view_lag_7d')} FROM wide w")
def L08_pipeline_v4(spark, sf):
    return _version(spark, sf, "v4")


@query("ts:t, y:d, view_lag_2d:d, view_lag_14d:d, view_lag_25h:d", f"WITH {WIDE} SELECT ts, view AS y, {LAGGED(48, 'view_lag_2d')}, {LAGGED(336, 'view_lag_14d')}, {LAGGED(25, 'view_lag_25h')} FROM wide w")
def L08_pipeline_v5_full(spark, sf):
    return _version(spark, sf, "v5_full")


NAIVE = {"day": "y_lag_1d", "week": "y_lag_7d", "mean": "y_d7_d1_mean"}
_LONG = " UNION ALL ".join(f"SELECT k, ts, y, '{m}' AS model, {x} AS pred FROM mx" for m, x in NAIVE.items())


@query("model:s, category:s, n_features:i, weight:d, mae:d, rmse:d", f"""WITH {MATRIX}, p AS ({_LONG}), e AS (SELECT model, avg(abs(pred - y)) AS mae, sqrt(avg((pred - y) * (pred - y))) AS rmse FROM p GROUP BY 1), w AS (SELECT *, (1 / (mae + 1e-6)) / sum(1 / (mae + 1e-6)) OVER () AS weight FROM e),
 b AS (SELECT k, ts, max(y) AS y, sum(pred * weight) AS pred FROM p JOIN w USING (model) GROUP BY k, ts)
 SELECT model, 'naive' AS category, 1 AS n_features, weight, mae, rmse FROM w UNION ALL SELECT 'blend', 'blend', 3, 1.0, avg(abs(pred - y)), sqrt(avg((pred - y) * (pred - y))) FROM b""")
def L10_production(spark, sf):
    """Models that are stored, loaded and scored, and their blend."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import SQLTransformer

    df, _ = matrix(spark, sf)
    fitted = {m: PipelineModel([SQLTransformer(statement=f"SELECT *, {x} AS prediction FROM __THIS__")]) for m, x in NAIVE.items()}
    errors = blends.errors_by_model(df.select("k", "ts", "y", F.inline(F.array(*[F.struct(F.lit(m).alias("model"), F.col(x).alias("pred")) for m, x in NAIVE.items()]))))
    inputs = F.create_map(*[e for m, x in NAIVE.items() for e in (F.lit(m), F.array(F.lit(x)))])
    config = blends.inverse_mae_weights(errors).withColumns({"category": F.lit("naive"), "features": F.try_element_at(inputs, F.col("model"))})
    store = production.Production(spark, f"{scratch(spark)}/production")
    store.save(fitted, config)
    scored = pin(store.score(df, ["k"]))
    each = store.summary().join(scoring.metrics(scored, ["model"]).select("model", "rmse"), "model")
    m = scoring.metric_columns()
    blend = store.blend(scored, ["k"]).agg(m["mae"].alias("mae"), m["rmse"].alias("rmse")).select(F.lit("blend").alias("model"), F.lit("blend").alias("category"), F.lit(len(NAIVE)).alias("n_features"), F.lit(1.0).alias("weight"), "mae", "rmse")
    return each.unionByName(blend)


@query("ts:t, view:d, click:d, spread:d", f"WITH {WIDE}, s AS (SELECT abs(least(min(view), min(click))) + 1 AS shift FROM wide) SELECT ts, ln(view + shift) AS view, ln(click + shift) AS click, view - click AS spread FROM wide, s")
def S04_user_steps(spark, sf):
    """A user's function and a user's estimator as steps of a pipeline."""
    steps = [Step("custom", {"fn": lambda df: df.withColumn("spread", F.col("view") - F.col("click")), "label": "spread"}), Step("fitted", {"estimator": LogShift(["view", "click"])})]
    return pipelines.compile_steps(steps)(wide(spark, sf))


@query(", ".join(["l_returnflag:s", *[f"{x}_{a}:d" for x in ("l_quantity", "l_extendedprice") for a in windows.AGGREGATES]]), "SELECT l_returnflag, " + ", ".join(f"{f}({x}) AS {x}_{a}" for x in ("l_quantity", "l_extendedprice") for a, f in (("mean", "avg"), ("std", "stddev_pop"), ("min", "min"), ("max", "max"), ("sum", "sum"))) + " FROM lineitem GROUP BY 1")
def S05_named_aggregates(spark, sf):
    return windows.aggregate(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice"], list(windows.AGGREGATES), ["l_returnflag"])


@query("feature:s, n:i, n_violations:i", f"WITH {PREDS} SELECT model AS feature, count(*) AS n, count(*) FILTER (ts - to_hours(CASE model WHEN 'lag1' THEN 24 WHEN 'lag2' THEN 48 ELSE 168 END) > date_trunc('day', ts) - INTERVAL 14 HOUR) AS n_violations FROM preds GROUP BY 1")
def L09_leakage_audit(spark, sf):
    steps = [Step("windows", {"columns": ("view",), "windows": (WindowSpec(-7, -1),)}), Step("rename", {"old": "view", "new": "y"})]
    leakage.validate(steps, [AvailabilityRule("view", -1)], ["view"])
    hours = F.try_element_at(F.create_map(*[F.lit(x) for kv in LAGS.items() for x in kv]), F.col("model"))
    used = preds(spark, sf).select(F.col("model").alias("feature"), (F.col("ts") - F.make_dt_interval(F.lit(0), hours)).alias("available_at"), (F.date_trunc("day", "ts") - F.expr("INTERVAL 14 HOURS")).alias("predicted_at"))
    return leakage.audit(used)

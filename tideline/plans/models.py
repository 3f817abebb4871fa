"""Fitting on Spark ML: linear family, boosted trees, searches, feature selection. Splits are always by time."""

from __future__ import annotations

import json
import random
from concurrent.futures import ThreadPoolExecutor
from itertools import product
from math import sqrt

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.plans.scoring import folds, metric_columns, with_folds
from tideline.session import pin, scratch
from tideline.specs import c


def linear(kind: str, alpha: float, n: int, sd: float, ratio: float = 0.5, label: str = "y", weight: str | None = None) -> LinearRegression:
    """ridge, lasso, elasticnet or huber with the usual objective; ``n`` rows and ``sd`` of the target convert ``alpha`` to Spark's."""
    # squared losses are solved from one pass's sums of products; only huber passes over the rows again and again
    lr = LinearRegression(featuresCol="features_", labelCol=label, standardization=False, solver="auto", maxIter=200, tol=1e-9)
    if kind != "huber":
        sd *= sqrt(max(n - 1, 1) / n)  # that way divides by the deviation of the rows, not of a sample
    if weight:
        lr = lr.setWeightCol(weight)
    if kind == "ridge":
        return lr.setRegParam(alpha * sd / n).setElasticNetParam(0.0)
    if kind == "lasso":
        return lr.setRegParam(alpha).setElasticNetParam(1.0)
    if kind == "elasticnet":
        mixed = ratio + (1 - ratio) * sd
        return lr.setRegParam(alpha * mixed).setElasticNetParam(ratio / mixed)
    if kind == "huber":
        lr.set(lr.loss, "huber")
        return lr.setRegParam(alpha)
    raise ValueError(kind)


def boosted(loss: str = "squared", iterations: int = 20, step: float = 0.1, depth: int = 4, sample: float = 0.8, min_rows: int = 5, seed: int = 42, label: str = "y") -> GBTRegressor:
    return GBTRegressor(featuresCol="features_", labelCol=label, lossType=loss, maxIter=iterations, stepSize=step, maxDepth=depth, subsamplingRate=sample, minInstancesPerNode=min_rows, seed=seed)


#: Levels of regularisation for ``boosted``: smaller trees of more rows, on fewer rows each, in smaller steps.
LEVELS = {
    "moderate": {"step": 0.1, "depth": 5, "sample": 0.7, "min_rows": 50},
    "strong": {"step": 0.05, "depth": 4, "sample": 0.5, "min_rows": 100},
    "very strong": {"step": 0.025, "depth": 3, "sample": 0.5, "min_rows": 200},
}


def moments(df: DataFrame, label: str = "y") -> tuple[int, float]:
    r = df.agg(F.count(label).alias("n"), F.stddev_samp(label).alias("s")).first()
    return max(r["n"], 1), r["s"] or 1.0


def train(df: DataFrame, features: list[str], estimator, label: str = "y"):
    """A fitted pipeline; rows with a missing input or target are left out."""
    assembler = VectorAssembler(inputCols=features, outputCol="features_", handleInvalid="skip")
    return Pipeline(stages=[assembler, estimator]).fit(df.where(c(label).isNotNull()))


def predict(model, df: DataFrame) -> DataFrame:
    return model.transform(df).withColumnRenamed("prediction", "pred").drop("features_")


def train_and_score(df: DataFrame, features: list[str], estimator, label: str = "y", split: str = "split") -> DataFrame:
    """split, mae, rmse, me, r2 of a model fitted on the train part."""
    model = train(df.where(c(split) == "train"), features, estimator, label)
    m = metric_columns(label, "pred")
    return predict(model, df).groupBy(split).agg(*[v.alias(k) for k, v in m.items()])


def per_slot(df: DataFrame, features: list[str], make, slots: int = 24, slot: str = "slot", threads: int = 4) -> DataFrame:
    """One model per hour of the day, fitted concurrently; returns predictions of all, saved hour by hour."""
    spark, path = df.sparkSession, scratch(df.sparkSession)

    def one(h: int) -> None:
        part = df.where(c(slot) == h)
        predict(train(part.where("split = 'train'"), features, make()), part).write.parquet(f"{path}/{h}")

    with ThreadPoolExecutor(threads) as pool:
        list(pool.map(one, range(slots)))
    schema = spark.read.parquet(f"{path}/0").schema
    return spark.read.schema(schema).parquet(*[f"{path}/{h}" for h in range(slots)])


def random_search(df: DataFrame, features: list[str], draw, make, trials: int = 30, seed: int = 0, threads: int = 4) -> DataFrame:
    """A row of test metrics per trial; ``draw`` makes a trial's parameters from a seeded generator, so trials can be told again."""
    drawn = [draw(random.Random(f"{seed}/{i}")) for i in range(trials)]

    def one(p: dict) -> tuple:
        r = train_and_score(df, features, make(**p)).where("split = 'test'").first()
        return (json.dumps(p), r["mae"], r["rmse"])

    with ThreadPoolExecutor(threads) as pool:
        rows = list(pool.map(one, drawn))
    return df.sparkSession.createDataFrame([(i, *r) for i, r in enumerate(rows)], "trial int, params string, mae double, rmse double")


def retrain_best(df: DataFrame, features: list[str], runs: DataFrame, make) -> DataFrame:
    """Fits again with the parameters (JSON) of the stored run of least MAE."""
    best = runs.where("mae IS NOT NULL").orderBy("mae", "params").select("params").first()["params"]
    r = train_and_score(df, features, make(**json.loads(best))).where("split = 'test'")
    return r.select(F.lit(best).alias("params"), "mae", "rmse")


def grid_search(df: DataFrame, features: list[str], grid: dict[str, list], make, threads: int = 4) -> DataFrame:
    """A row of parameters and test metrics per combination; fits run side by side."""
    combos = [dict(zip(grid, v)) for v in product(*grid.values())]

    def one(p: dict) -> tuple:
        r = train_and_score(df, features, make(**p)).where("split = 'test'").first()
        return ("|".join(f"{k}={v}" for k, v in p.items()), r["mae"], r["rmse"])

    with ThreadPoolExecutor(threads) as pool:
        rows = list(pool.map(one, combos))
    return df.sparkSession.createDataFrame(rows, "params string, mae double, rmse double")


def cv_score(df: DataFrame, features: list[str], estimator, n_splits: int = 3, test: int | float = 0.1, keys: list[str] = [], name: str = "model") -> DataFrame:
    """model, fold, mae, rmse over time-ordered folds."""
    n = df.select("local_date").distinct().count()
    tagged = with_folds(df, folds(n, n_splits, test), keys)
    m, out = metric_columns(), None
    for k in range(n_splits):
        part = tagged.where(F.col("fold") == k)
        model = train(part.where("part = 'train'"), features, estimator)
        row = predict(model, part.where("part = 'test'")).agg(m["mae"].alias("mae"), m["rmse"].alias("rmse")).select(F.lit(name).alias("model"), F.lit(k).alias("fold"), "mae", "rmse")
        out = row if out is None else out.unionByName(row)
    return out


def cv_search(df: DataFrame, features: list[str], grid: dict[str, list], make, n_splits: int = 3, test: int | float = 0.1, keys: list[str] = [], threads: int = 4) -> DataFrame:
    """params, cv_mae, chosen, mae, rmse: time-ordered folds within the training days choose; only the choice meets the test days."""
    combos = [dict(zip(grid, v)) for v in product(*grid.values())]
    inner = pin(df.where("split = 'train'").drop("split"))

    def one(p: dict) -> float:
        return cv_score(inner, features, make(**p), n_splits, test, keys).agg(F.avg("mae")).first()[0]

    with ThreadPoolExecutor(threads) as pool:
        scores = list(pool.map(one, combos))
    best = min((i for i, x in enumerate(scores) if x is not None), key=scores.__getitem__, default=None)
    held = train_and_score(df, features, make(**combos[best])).where("split = 'test'").first() if best is not None else None
    rows = [("|".join(f"{k}={v}" for k, v in p.items()), scores[i], i == best, *((held["mae"], held["rmse"]) if held and i == best else (None, None))) for i, p in enumerate(combos)]
    return df.sparkSession.createDataFrame(rows, "params string, cv_mae double, chosen boolean, mae double, rmse double")


def correlation_filter(df: DataFrame, features: list[str], label: str = "y", low: float = 0.02, high: float = 0.9999) -> list[str]:
    """Features with |Spearman| of at least ``low`` with the target; of pairs with |Pearson| above ``high`` the weaker goes."""
    rows = VectorAssembler(inputCols=[*features, label], outputCol="v_", handleInvalid="skip").transform(df).select("v_")
    rank = Correlation.corr(rows, "v_", "spearman").first()[0].toArray()[-1, :-1]
    pair = Correlation.corr(rows, "v_", "pearson").first()[0].toArray()
    kept: list[int] = []
    for i in sorted((i for i in range(len(features)) if abs(rank[i]) >= low), key=lambda i: -abs(rank[i])):
        if all(abs(pair[i, j]) <= high for j in kept):
            kept.append(i)
    return [features[i] for i in sorted(kept)]


def importances(df: DataFrame, features: list[str], estimator: GBTRegressor) -> list[tuple[str, float]]:
    model = train(df, features, estimator).stages[-1]
    return sorted(zip(features, model.featureImportances.toArray().tolist()), key=lambda x: (-x[1], x[0]))


def top_n_sweep(df: DataFrame, ranked: list[str], estimator, sizes: list[int]) -> DataFrame:
    rows = []
    for n in sizes:
        r = train_and_score(df, ranked[:n], estimator).where("split = 'test'").first()
        rows.append((n, r["mae"], r["rmse"]))
    return df.sparkSession.createDataFrame(rows, "n int, mae double, rmse double")


def top_n_search(df: DataFrame, ranked: list[str], estimator, coarse: tuple[int, ...] = (10, 20, 30, 50, 75, 100), reach: int = 10, step: int = 2) -> DataFrame:
    """n, mae, rmse, stage, chosen: a coarse grid of sizes, then those within ``reach`` of its best one, ``step`` apart; the least MAE is chosen."""
    seen: dict[int, tuple] = {}

    def score(sizes, stage: str) -> int:
        for n in sorted({min(n, len(ranked)) for n in sizes if n > 0} - set(seen)):
            r = train_and_score(df, ranked[:n], estimator).where("split = 'test'").first()
            seen[n] = (n, r["mae"], r["rmse"], stage)
        return min(seen, key=lambda n: (seen[n][1], n))

    best = score(coarse, "coarse")
    best = score(range(best - reach, best + reach + 1, step), "fine")
    return df.sparkSession.createDataFrame([(*r, n == best) for n, r in sorted(seen.items())], "n int, mae double, rmse double, stage string, chosen boolean")


def eliminate(df: DataFrame, features: list[str], estimator: GBTRegressor, step: int = 3, least: int = 10, n_splits: int = 3, test: int | float = 0.1, keys: list[str] = [], threads: int = 3) -> tuple[list[tuple[int, float]], list[str]]:
    """The path (number of features, mean test RMSE of the folds), and the features of its best number.

    Each fold goes its own way: the model fitted on its training part ranks the
    features, the least important go, ``step`` at a time; its test part only
    scores. The features of the best number are those that most folds have kept
    there, then those of the largest mean importance: no test row has a say.
    """
    n = df.select("local_date").distinct().count()
    tagged = pin(with_folds(df, folds(n, n_splits, test), keys))
    m = metric_columns()

    def one(k: int) -> list[tuple[list[tuple[str, float]], float]]:
        part, left, path = tagged.where(F.col("fold") == k), list(features), []
        while True:
            model = train(part.where("part = 'train'"), left, estimator)
            ranked = sorted(zip(left, model.stages[-1].featureImportances.toArray().tolist()), key=lambda x: (-x[1], x[0]))
            path.append((ranked, predict(model, part.where("part = 'test'")).agg(m["rmse"].alias("rmse")).first()["rmse"]))
            if len(left) - step < least:
                return path
            left = [f for f, _ in ranked[: len(left) - step]]

    with ThreadPoolExecutor(threads) as pool:
        ways = list(pool.map(one, range(n_splits)))
    path = [(len(at[0][0]), sum(r for _, r in at) / n_splits) for at in zip(*ways)]
    best = min(range(len(path)), key=lambda i: (path[i][1], path[i][0]))
    votes = {f: [0, 0.0] for f in features}
    for way in ways:
        for f, x in way[best][0]:
            votes[f][0] += 1
            votes[f][1] += x
    chosen = sorted(features, key=lambda f: (-votes[f][0], -votes[f][1], f))[: path[best][0]]
    return path, sorted(chosen)

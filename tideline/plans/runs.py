"""Recorded fits: a run table that is appended to, training with a transformed target, searches that go on where they stopped."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from itertools import product

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions.scalers import LogShift, QuantileNormal, YeoJohnson
from tideline.plans.models import predict, train
from tideline.plans.scoring import metric_columns
from tideline.specs import c

PARTS = ("train", "val", "test")
RUN = "search string, dataset string, params string, " + ", ".join(f"n_{p} long" for p in PARTS) + ", " + ", ".join(f"{m} double" for m in ("mae", "rmse", "me", "r2", "val_mae", "val_rmse", "val_me", "val_r2"))
TRANSFORMS = {"log_shift": LogShift, "yeo_johnson": YeoJohnson, "quantile": QuantileNormal}


class Runs:
    """A row per fit below one folder.

    Each row is a folder of its own, so fits that end at once do not meet, and a
    broken write is not seen. A fit is known by its search, dataset and parameters
    (JSON with sorted keys); where two searchers record the same one, the row of
    least MAE (then RMSE) counts.
    """

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")

    def add(self, search: str, dataset: str, params: dict, numbers: dict) -> None:
        row = {"search": search, "dataset": dataset, "params": json.dumps(params, sort_keys=True)} | numbers
        names = [f.split()[0] for f in RUN.split(", ")]
        at = hashlib.sha256(f"{search}/{dataset}/{row['params']}".encode()).hexdigest()[:32]
        self.spark.createDataFrame([tuple(row.get(x) for x in names)], RUN).coalesce(1).write.json(f"{self.base}/{at}-{uuid.uuid4().hex}")

    def read(self, search: str | None = None) -> DataFrame:
        try:
            rows = self.spark.read.schema(RUN).option("recursiveFileLookup", "true").json(self.base)
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            rows = self.spark.createDataFrame([], RUN)
        rows = rows if search is None else rows.where(F.col("search") == search)
        key = ["search", "dataset", "params"]
        rest = [x for x in rows.columns if x not in key]
        order = F.struct(F.col("mae").isNull(), "mae", "rmse")
        return rows.groupBy(*key).agg(F.min_by(F.struct(*rest), order).alias("r_")).select(*key, *[F.col(f"r_.{x}").alias(x) for x in rest])

    def best(self, search: str | None = None, metric: str = "mae") -> dict:
        """dataset and params of the recorded run of least ``metric``."""
        row = self.read(search).where(c(metric).isNotNull()).orderBy(metric, "dataset", "params").first()
        if row is None:
            raise LookupError(f"no run of {search!r} has {metric}")
        return {"dataset": row["dataset"], "params": json.loads(row["params"])}


def fit(df: DataFrame, features: list[str], estimator, transform: str = "none", label: str = "y", split: str = "split") -> tuple[object, DataFrame]:
    """The model fitted on the train part, and all rows with ``pred`` in the target's own scale.

    With ``transform``, the target's scaler is fitted on the train part alone; the
    model sees scaled values of a copy, and its predictions are scaled back.
    """
    if transform == "none":
        model = train(df.where(c(split) == "train"), features, estimator, label)
        return model, predict(model, df)
    known = df.where(c(label).isNotNull())
    scaler = TRANSFORMS[transform]([label]).fit(known.where(c(split) == "train"))
    scaled = scaler.transform(known.where(c(split) == "train"))
    model: Pipeline = train(scaled, features, estimator, label)
    out = predict(model, df).withColumnRenamed(label, "target_").withColumnRenamed("pred", label)
    return model, scaler.inverse(out).withColumnRenamed(label, "pred").withColumnRenamed("target_", label)


def measured(scored: DataFrame, label: str = "y", split: str = "split") -> dict:
    """Numbers of a run row: rows of each part, metrics of the test part, those of a validation part with ``val_``."""
    m = metric_columns(label, "pred")
    rows = {r[split]: r for r in scored.groupBy(split).agg(F.count(label).alias("n"), *[v.alias(k) for k, v in m.items()]).collect()}  # a row a part
    out = {f"n_{p}": rows[p]["n"] if p in rows else 0 for p in PARTS}
    for part, prefix in (("test", ""), ("val", "val_")):
        out |= {prefix + k: rows[part][k] if part in rows else None for k in m}
    return out


def train_and_record(df: DataFrame, features: list[str], estimator, runs: Runs, search: str, dataset: str, params: dict, transform: str = "none", label: str = "y") -> dict:
    """Fit on train, measure on val (if there is one) and test, append the run."""
    _, scored = fit(df, features, estimator, transform, label)
    numbers = measured(scored, label)
    runs.add(search, dataset, params, numbers)
    return numbers


def combinations(grid: dict[str, list]) -> list[dict]:
    return [dict(zip(grid, v)) for v in product(*grid.values())]


def search(data: dict[str, tuple[DataFrame, list[str]]], trials: list[dict], make: Callable, runs: Runs, name: str, transform: str = "none", label: str = "y", threads: int = 4) -> DataFrame:
    """The recorded runs of every trial on every dataset (name: rows, features).

    Trials that the table holds already are not fitted again, so a search that was
    interrupted goes on where it stopped, and more trials may be asked for later.
    The search's jobs run in a pool of its name, so that under
    ``spark.scheduler.mode=FAIR`` searches side by side share the cluster. A trial
    that fails is not recorded; the others end, then its error is raised.
    """
    sc = runs.spark.sparkContext
    wanted = {(d, json.dumps(p, sort_keys=True)): p for d in data for p in trials}
    done = {(r["dataset"], r["params"]) for r in runs.read(name).select("dataset", "params").collect()}  # trials, not data

    def one(dataset: str, params: dict) -> None:
        sc.setLocalProperty("spark.scheduler.pool", name)
        df, features = data[dataset]
        train_and_record(df, features, make(**params), runs, name, dataset, params, transform, label)

    with ThreadPoolExecutor(threads) as pool:
        left = [pool.submit(one, key[0], p) for key, p in wanted.items() if key not in done]
    for f in left:
        f.result()
    asked = runs.spark.createDataFrame([*wanted], "dataset string, params string")
    return runs.read(name).join(F.broadcast(asked), ["dataset", "params"], "left_semi")


def retrain(data: dict[str, tuple[DataFrame, list[str]]], make: Callable, runs: Runs, name: str, transform: str = "none", metric: str = "mae"):
    """The model fitted anew as the search's best run was, and the dataset and parameters it has."""
    best = runs.best(name, metric)
    df, features = data[best["dataset"]]
    return fit(df, features, make(**best["params"]), transform)[0], best

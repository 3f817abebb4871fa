"""The production registry: fitted models with their inputs and weights in one folder, loaded, scored and summed up."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.plans.blends import apply_weights, errors_by_model, inverse_mae_weights
from tideline.plans.models import predict
from tideline.session import pin
from tideline.specs import c


class Production:
    """``models/<name>`` holds a fitted pipeline each, ``config`` a row a model: model, category, features, weight, mae."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base

    def save(self, models: dict[str, PipelineModel], config: DataFrame) -> None:
        """Models that the config names; a model without a row, or a row without its model, is refused."""
        named = {r.model for r in config.select("model").collect()}
        if named != set(models):
            raise ValueError(f"models and config differ: {sorted(named ^ set(models))}")
        for name, model in models.items():
            model.write().overwrite().save(f"{self.base}/models/{name}")
        config.select("model", "category", "features", "weight", "mae").write.mode("overwrite").json(f"{self.base}/config")

    def config(self) -> DataFrame:
        return self.spark.read.schema("model STRING, category STRING, features ARRAY<STRING>, weight DOUBLE, mae DOUBLE").json(f"{self.base}/config")

    def load(self) -> dict[str, PipelineModel]:
        return {r.model: PipelineModel.load(f"{self.base}/models/{r.model}") for r in self.config().select("model").orderBy("model").collect()}

    def score(self, df: DataFrame, keys: list[str] = [], time: str = "ts", label: str = "y") -> DataFrame:
        """(keys, time, model, y, pred) of every model; inputs that the table lacks are an error that names them."""
        inputs = {r.model: r.features for r in self.config().collect()}
        if lost := sorted({x for xs in inputs.values() for x in xs} - set(df.columns)):
            raise ValueError(f"inputs not in the table: {lost}")
        parts = [predict(m, df).select(*keys, time, F.lit(name).alias("model"), c(label).alias("y"), "pred") for name, m in self.load().items()]
        return reduce(DataFrame.unionByName, parts)

    def blend(self, scored: DataFrame, keys: list[str] = [], time: str = "ts") -> DataFrame:
        """(keys, time, y, pred): the weighted mean where every model has a prediction."""
        return apply_weights(scored, self.config().select("model", "weight"), keys, [], time)

    def refresh(self, holdout: DataFrame, keys: list[str] = [], time: str = "ts", label: str = "y") -> None:
        """New MAEs and weights from the stored models' predictions of a hold-out; the models stay as they are."""
        errors = errors_by_model(self.score(holdout, keys, time, label))
        fresh = pin(self.config().drop("weight", "mae").join(inverse_mae_weights(errors).select("model", "weight", "mae"), "model"))
        if fresh.count() != self.config().count() or not fresh.where("mae IS NULL").isEmpty():
            raise ValueError("a model has no prediction in the hold-out")
        fresh.select("model", "category", "features", "weight", "mae").write.mode("overwrite").json(f"{self.base}/config")

    def forecast(self, df: DataFrame, keys: list[str] = [], time: str = "ts", label: str = "y", decimals: int = 2) -> DataFrame:
        """(keys, time, model, pred): rounded predictions of every stored model and of their blend."""
        scored = pin(self.score(df if label in df.columns else df.withColumn(label, F.lit(None).cast("double")), keys, time, label))
        both = scored.select(*keys, time, "model", "pred").unionByName(self.blend(scored, keys, time).select(*keys, time, F.lit("blend").alias("model"), "pred"))
        return both.withColumn("pred", F.round("pred", decimals))

    def summary(self) -> DataFrame:
        """model, category, n_features, weight, mae."""
        return self.config().select("model", "category", F.size("features").alias("n_features"), "weight", "mae")

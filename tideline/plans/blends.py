"""Model selection, blending and ensemble search over long prediction tables (keys, ts, model, y, pred)."""

from __future__ import annotations

import hashlib
import math
from functools import reduce
from itertools import count

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.plans.scoring import metric_columns
from tideline.specs import c


def candidates(runs: DataFrame, top: int = 3, pool: int = 10, drawn: int = 2, forced: list[str] = (), seed: int = 42) -> DataFrame:
    """Per category the best by MAE, some of the next ones by hash, and the forced ids; chosen_by tells which."""
    ranked = runs.where(F.col("mae").isNotNull()).withColumn("rank_", F.row_number().over(Window.partitionBy("category").orderBy("mae", "run_id")))
    best = ranked.where(F.col("rank_") <= top).withColumn("chosen_by", F.lit("top"))
    draw = Window.partitionBy("category").orderBy(F.md5(F.concat("run_id", F.lit(str(seed)))))
    lucky = ranked.where((F.col("rank_") > top) & (F.col("rank_") <= top + pool)).withColumn("n_", F.row_number().over(draw)).where(F.col("n_") <= drawn).drop("n_").withColumn("chosen_by", F.lit("drawn"))
    chosen = best.unionByName(lucky)
    extra = ranked.where(c("run_id").isin(list(forced))).join(chosen, "run_id", "left_anti").withColumn("chosen_by", F.lit("forced"))
    return chosen.unionByName(extra).drop("rank_")


def final_models(cv: DataFrame) -> DataFrame:
    """Per category the best by mean CV MAE and the best by mean CV RMSE; where that is the same model, the runner-up by RMSE."""
    by = lambda x: F.row_number().over(Window.partitionBy("category").orderBy(x, "model"))
    ranked = cv.withColumns({"mae_rank_": by("mae_mean"), "rmse_rank_": by("rmse_mean")})
    same = F.max(F.when((F.col("mae_rank_") == 1) & (F.col("rmse_rank_") == 1), 1).otherwise(0)).over(Window.partitionBy("category"))
    role = F.when(F.col("mae_rank_") == 1, "mae").when(F.col("rmse_rank_") == F.when(same == 1, 2).otherwise(1), "rmse")
    return ranked.withColumn("role", role).where(F.col("role").isNotNull()).drop("mae_rank_", "rmse_rank_")


def inverse_mae_weights(errors: DataFrame, keys: list[str] = [], mae: str = "mae") -> DataFrame:
    inv = 1 / (c(mae) + 1e-6)
    return errors.withColumn("weight", inv / F.sum(inv).over(Window.partitionBy(*keys)))


def errors_by_model(preds: DataFrame, by: list[str] = []) -> DataFrame:
    m = metric_columns()
    return preds.groupBy(*by, "model").agg(*[v.alias(k) for k, v in m.items()])


def apply_weights(preds: DataFrame, weights: DataFrame, keys: list[str] = [], weight_keys: list[str] = [], time: str = "ts") -> DataFrame:
    """(keys, time, y, pred): the weighted sum where all weighted models are present."""
    size = weights.groupBy(*weight_keys).agg(F.count("*").alias("size_"))
    w = weights.select(*weight_keys, "model", "weight")
    w = w.join(size, weight_keys) if weight_keys else w.join(F.broadcast(size))
    sums = preds.where(F.col("pred").isNotNull()).join(w, [*weight_keys, "model"]).groupBy(*dict.fromkeys([*keys, *weight_keys]), time).agg(F.max("y").alias("y"), F.sum(F.col("weight") * F.col("pred")).alias("pred"), F.count("*").alias("n_"), F.max("size_").alias("size_"))
    return sums.where("n_ = size_").drop("n_", "size_")


def simple_blend(preds: DataFrame, keys: list[str] = [], time: str = "ts") -> DataFrame:
    """Mean and median of the models' predictions."""
    return preds.groupBy(*keys, time).agg(F.max("y").alias("y"), F.avg("pred").alias("mean_pred"), F.median("pred").alias("median_pred"))


def needs_reselection(old_mae: Column, new_mae: Column, limit: float = 0.2) -> Column:
    return F.coalesce(F.try_divide(new_mae - old_mae, old_mae) > limit + 1e-12, F.lit(False))


def spread(preds: DataFrame, models: list[str], keys: list[str] = [], time: str = "ts") -> DataFrame:
    """One column per model, complete rows only."""
    return preds.groupBy(*keys, time).agg(F.max("y").alias("y"), *[F.max(F.when(F.col("model") == m, F.col("pred"))).alias(m) for m in models]).na.drop(subset=["y", *models])


def _blend_mae(models: list[str], mae: dict[str, float]) -> Column:
    w = [1 / (mae[m] + 1e-6) for m in models]
    return F.avg(F.abs(reduce(lambda a, b: a + b, [c(m) * (x / sum(w)) for m, x in zip(models, w)]) - F.col("y")))


def greedy_selection(table: DataFrame, models: list[str]) -> list[tuple[int, str, float]]:
    """(step, model, MAE of the inverse-MAE blend so far): each step is one pass with an expression per remaining model."""
    row = table.agg(*[F.avg(F.abs(c(m) - F.col("y"))).alias(m) for m in models]).first()
    mae, chosen, path = {m: row[m] for m in models}, [], []
    while len(chosen) < len(models):
        left = [m for m in models if m not in chosen]
        row = table.agg(*[_blend_mae([*chosen, m], mae).alias(m) for m in left]).first()
        best = min(left, key=lambda m: (row[m], m))
        chosen.append(best)
        path.append((len(chosen), best, row[best]))
    return path


def subset_scores(table: DataFrame, models: list[str], keys: list[str] = [], alpha: float = 0.0) -> DataFrame:
    """mask, n_models, mae, penalty, score of the plain mean of every subset (at most 12 models; for more, see ``hill_climb``): the exact optimum.

    Subsets are expressions over each row, summed in one pass. The penalty is
    ``alpha`` times the mean pairwise correlation of the subset.
    """
    if len(models) > 12:
        raise ValueError("more than 12 models")
    masks = range(1, 1 << len(models))
    member = lambda mask: [m for i, m in enumerate(models) if mask >> i & 1]
    mean = lambda ms: reduce(lambda a, b: a + b, map(c, ms)) / len(ms)
    sums = [F.avg(F.abs(mean(member(k)) - F.col("y"))).alias(f"m{k}") for k in masks]
    pairs = [(i, j) for i in range(len(models)) for j in range(i)]
    sums += [F.corr(c(models[i]), c(models[j])).alias(f"c{i}_{j}") for i, j in pairs]
    row = table.groupBy(*keys).agg(*sums)

    def cell(k: int) -> Column:
        inside = [c(f"c{i}_{j}") for i, j in pairs if k >> i & 1 and k >> j & 1]
        penalty = reduce(lambda a, b: a + b, inside) / len(inside) if inside else F.lit(0.0)
        return F.struct(F.lit(k).alias("mask"), F.lit(k.bit_count()).alias("n_models"), c(f"m{k}").alias("mae"), penalty.alias("penalty"), (c(f"m{k}") + penalty * alpha).alias("score"))

    return row.select(*keys, F.inline(F.array(*map(cell, masks))))


def simplex_project(w: np.ndarray) -> np.ndarray:
    s = np.sort(w)[::-1]
    t = (np.cumsum(s) - 1) / np.arange(1, len(w) + 1)
    return np.maximum(w - t[np.nonzero(s > t)[0][-1]], 0)


def _simplex_solve(gram: np.ndarray, xy: np.ndarray, steps: int = 3000) -> np.ndarray:
    w, rate = np.full(len(xy), 1 / len(xy)), 1 / max(np.linalg.eigvalsh(gram)[-1], 1e-12)
    for _ in range(steps):
        w = simplex_project(w - rate * (gram @ w - xy))
    return w


def gram(table: DataFrame, models: list[str], weight: Column) -> tuple[np.ndarray, np.ndarray]:
    """Mean products of the models with each other and with y."""
    n = len(models)
    row = table.agg(*[F.sum(weight * c(models[i]) * c(models[j])).alias(f"g{i}_{j}") for i in range(n) for j in range(i + 1)], *[F.sum(weight * c(m) * F.col("y")).alias(f"x{i}") for i, m in enumerate(models)], F.sum(weight).alias("n")).first()
    g = np.array([[row[f"g{max(i, j)}_{min(i, j)}"] or 0.0 for j in range(n)] for i in range(n)])
    return g / (row["n"] or 1.0), np.array([row[f"x{i}"] or 0.0 for i in range(n)]) / (row["n"] or 1.0)


def nonnegative_solve(g: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The w >= 0 with the least w'gw - 2w'x, by active sets: weights come in one at a time, and leave where a solution would turn negative."""
    w, there = np.zeros(len(x)), np.zeros(len(x), bool)
    limit = 1e-12 * max(1.0, np.abs(x).max(initial=0.0))
    while True:
        slope = np.where(there, -np.inf, x - g @ w)
        if slope.max(initial=-np.inf) <= limit:
            return w
        there[np.argmax(slope)] = True
        while True:
            at = np.zeros(len(x))
            at[there] = np.linalg.lstsq(g[np.ix_(there, there)], x[there], rcond=None)[0]
            below = there & (at <= 0)
            if not below.any():
                break
            step = (w[below] / np.maximum(w[below] - at[below], 1e-300)).min()
            w = np.where(there, w + step * (at - w), 0.0)
            there &= w > 1e-15
            w[~there] = 0.0
        if np.allclose(at, w, rtol=0, atol=1e-15):
            return at
        w = at


def nonnegative_weights(table: DataFrame, models: list[str], alpha: float = 0.0) -> dict[str, float]:
    """A meta-learner whose coefficients are not negative (least squares, or ridge with ``alpha`` per row); the table is seen through sums of products."""
    g, x = gram(table, models, F.lit(1.0))
    return dict(zip(models, map(float, nonnegative_solve(g + alpha * np.eye(len(models)), x))))


def simplex_weights(table: DataFrame, models: list[str], loss: str = "rmse", rounds: int = 8) -> dict[str, float]:
    """Weights that are not negative and sum to 1 with the least RMSE or MAE.

    The table is seen through sums of products only (models x models); for MAE
    these are weighted anew by the last round's errors.
    """

    moments = lambda weight: gram(table, models, weight)
    w = _simplex_solve(*moments(F.lit(1.0)))
    if loss == "mae":
        for _ in range(rounds):
            error = F.abs(reduce(lambda a, b: a + b, [c(m) * float(x) for m, x in zip(models, w)]) - F.col("y"))
            w = _simplex_solve(*moments(1 / F.greatest(error, F.lit(1e-3))))
    return dict(zip(models, map(float, w)))


def trailing_weights(preds: DataFrame, days: int = 150, keys: list[str] = [], time: str = "ts") -> DataFrame:
    """Inverse-MAE weights of the last ``days`` before the newest prediction."""
    last = preds.agg(F.max(time).alias("last_"))
    recent = preds.join(F.broadcast(last)).where(c(time) > F.col("last_") - F.make_dt_interval(F.lit(days)))
    return inverse_mae_weights(errors_by_model(recent, keys), keys)


def incremental_blends(preds: DataFrame, keys: list[str] = [], time: str = "ts") -> DataFrame:
    """n, mae, rmse of the inverse-MAE blend of the n best models, for every n.

    Models are ranked once; along the ranks of a time's rows, running sums of
    weights and weighted predictions give each prefix's blend.
    """
    errors = errors_by_model(preds)
    ranked = errors.select("model", (1 / (F.col("mae") + 1e-6)).alias("w_"), F.row_number().over(Window.orderBy("mae", "model")).alias("n"))  # a row per model
    upto = Window.partitionBy(*keys, time).orderBy("n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = preds.where(F.col("pred").isNotNull()).join(ranked, "model")
    blended = rows.select("n", "y", (F.sum(F.col("w_") * F.col("pred")).over(upto) / F.sum("w_").over(upto)).alias("pred"), F.count("*").over(upto).alias("there_")).where("there_ = n")
    m = metric_columns()
    return blended.groupBy("n").agg(m["mae"].alias("mae"), m["rmse"].alias("rmse"))


def hill_climb(table: DataFrame, models: list[str], start: list[str] | None = None) -> list[tuple[int, str, float]]:
    """(step, models, MAE) while adding or removing one model betters the plain mean; for any number of models.

    A step is one pass with an expression for each model that could come or go. It starts from the best single model.
    """
    mean = lambda ms: F.avg(F.abs(reduce(lambda a, b: a + b, map(c, ms)) / len(ms) - F.col("y")))

    def best_of(sets: list[list[str]]) -> tuple[float, list[str]]:
        row = table.agg(*[mean(s).alias(f"s{i}") for i, s in enumerate(sets)]).first()
        return min((row[f"s{i}"], s) for i, s in enumerate(sets))

    mae, now = best_of([start] if start else [[m] for m in models])
    path = [(0, "+".join(now), mae)]
    for step in count(1):  # each step betters the mean, so no set comes twice
        around = [sorted({*now} ^ {m}) for m in models if {*now} != {m}]
        better, other = best_of(around)
        if not better < mae:
            break
        mae, now = better, other
        path.append((step, "+".join(now), mae))
    return path


def annealing(table: DataFrame, models: list[str], chains: int = 64, rounds: int = 60, start: float = 0.02, cooling: float = 0.92, seed: int = 42) -> tuple[list[str], float]:
    """(models, MAE) of the best plain mean that simulated annealing meets.

    All chains go on at once: a round is one pass with an expression for each set
    that a chain proposes and that has not been scored yet. A proposal is one
    model more or fewer; it is taken if better, or with the chance that its loss
    leaves at the round's temperature, a share of the mean MAE. Draws are hashes
    of seed, chain and round, so reruns agree. Then single moves go on from the
    best set until none betters it.
    """
    mae: dict[int, float] = {}

    def score(masks: set[int]) -> None:
        new = sorted(m for m in masks if m not in mae)
        if new:
            sets = [[x for i, x in enumerate(models) if m >> i & 1] for m in new]
            row = table.agg(*[F.avg(F.abs(reduce(lambda a, b: a + b, map(c, s)) / len(s) - F.col("y"))).alias(f"s{i}") for i, s in enumerate(sets)]).first()
            mae.update((m, float("inf") if row[i] is None else row[i]) for i, m in enumerate(new))

    def draw(*what: int) -> float:
        return int.from_bytes(hashlib.blake2b(repr((seed, *what)).encode(), digest_size=8).digest()) / 2**64

    now = [1 << ch % len(models) for ch in range(chains)]
    score(set(now))
    scale = sum(mae[m] for m in now) / chains
    for r in range(rounds):
        asked = [m ^ 1 << int(draw(ch, r, 0) * len(models)) for ch, m in enumerate(now)]
        asked = [a or m for a, m in zip(asked, now)]
        score(set(asked))
        heat = start * scale * cooling**r
        now = [a if mae[a] <= mae[m] or draw(ch, r, 1) < math.exp(-(mae[a] - mae[m]) / max(heat, 1e-300)) else m for ch, (a, m) in enumerate(zip(asked, now))]
    best = min(mae, key=lambda m: (mae[m], m))
    chosen = [x for i, x in enumerate(models) if best >> i & 1]
    _, found, value = hill_climb(table, models, chosen)[-1]
    return found.split("+"), value


def comparison(tables: dict[str, DataFrame], leaky: set[str] = frozenset()) -> DataFrame:
    """method, mae, rmse, uses_test_data: metric rows of several methods."""
    m = metric_columns()
    return reduce(DataFrame.unionByName, [t.agg(m["mae"].alias("mae"), m["rmse"].alias("rmse")).select(F.lit(k).alias("method"), "mae", "rmse", F.lit(k in leaky).alias("uses_test_data")) for k, t in tables.items()])


def rank_runs(runs: DataFrame, metrics: list[str], by: list[str], n: int = 2) -> DataFrame:
    """Min-ranks by each metric, their mean, and the n best per group."""
    ranks = {f"rank_{m}": F.rank().over(Window.partitionBy(*by).orderBy(m)) for m in metrics}
    ranked = runs.withColumns(ranks).withColumn("avg_rank", reduce(lambda a, b: a + b, [F.col(f"rank_{m}") for m in metrics]) / len(metrics))
    return ranked.withColumn("place_", F.row_number().over(Window.partitionBy(*by).orderBy("avg_rank", metrics[0], "run_id"))).where(F.col("place_") <= n).drop("place_")

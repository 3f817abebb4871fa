from concurrent.futures import ThreadPoolExecutor
from datetime import date, timedelta

import random
import numpy as np
import pytest
from pyspark.sql import functions as F

from tideline.plans import models
from tideline.session import pin, scratch
from tideline.sources.datasets import Datasets


@pytest.fixture(scope="module")
def planted(spark):
    """y follows ``real``; ``leak`` is y itself on the newest fold's test days and noise before; two columns are noise."""
    rng, rows = np.random.default_rng(1), []
    for d in range(40):
        for _ in range(10):
            real = rng.normal()
            y = 3 * real + rng.normal() * 0.3
            rows.append((date(2024, 1, 1) + timedelta(days=d), y, real, y if d >= 36 else rng.normal(), rng.normal(), rng.normal()))
    rows = [(r[0], *map(float, r[1:])) for r in rows]
    return pin(spark.createDataFrame(rows, "local_date date, y double, real double, leak double, n1 double, n2 double"))


def test_elimination_does_not_look_at_test_rows(planted):
    path, chosen = models.eliminate(planted, ["real", "leak", "n1", "n2"], models.boosted(iterations=4, depth=3), step=1, least=1, n_splits=2, test=4)
    assert [n for n, _ in path] == [4, 3, 2, 1] and "real" in chosen
    _, one = models.eliminate(planted, ["real", "leak", "n1"], models.boosted(iterations=4, depth=3), step=2, least=1, n_splits=2, test=4)
    assert "real" in one and (len(one) > 1 or one == ["real"])
    assert min(path, key=lambda p: p[1])[0] == len(chosen)


def test_coarse_then_fine_sizes(planted):
    """The best of the sizes tried; fine ones lie around the coarse grid's best and are tried once."""
    df = planted.withColumn("split", F.when(F.dayofyear("local_date") > 30, "test").otherwise("train"))
    n, sd = models.moments(df)
    rows = models.top_n_search(df, ["real", "n1", "n2", "leak"], models.linear("ridge", 1.0, n, sd), coarse=(1, 4, 9), reach=1, step=1).collect()
    assert [(r.n, r.stage) for r in rows][0] == (1, "coarse") and {r.n for r in rows} in ({1, 2, 4}, {1, 3, 4})
    assert [r.n for r in rows if r.chosen] == [min(rows, key=lambda r: (r.mae, r.n)).n]


def test_linear_fits_against_closed_forms(spark, planted):
    """Ridge by its normal equations with an intercept; lasso and elastic net by coordinate descent."""
    pdf = planted.toPandas()
    xs, x, y = ["real", "leak", "n1"], pdf[["real", "leak", "n1"]].to_numpy(), pdf["y"].to_numpy()
    n, sd = models.moments(planted)
    xc, yc = x - x.mean(0), y - y.mean()
    ridge = np.linalg.solve(xc.T @ xc + 5.0 * np.eye(3), xc.T @ yc)
    got = models.train(planted, xs, models.linear("ridge", 5.0, n, sd)).stages[-1]
    assert np.allclose(got.coefficients.toArray(), ridge, atol=2e-4 * np.abs(ridge).max()) and abs(got.intercept - (y.mean() - x.mean(0) @ ridge)) < 1e-3

    def descent(l1, l2):
        w = np.zeros(3)
        for _ in range(3000):
            for j in range(3):
                r = yc - xc @ w + xc[:, j] * w[j]
                z = xc[:, j] @ r / n
                w[j] = np.sign(z) * max(abs(z) - l1, 0) / (xc[:, j] @ xc[:, j] / n + l2)
        return w

    for kind, (l1, l2) in {"lasso": (0.2, 0.0), "elasticnet": (0.1, 0.1)}.items():
        fit = models.train(planted, xs, models.linear(kind, 0.2, n, sd)).stages[-1]
        assert np.allclose(fit.coefficients.toArray(), descent(l1, l2), atol=5e-3), kind


def test_savers_at_once_get_versions_of_their_own(spark):
    store = Datasets(spark, f"{scratch(spark)}/sets")
    df = spark.createDataFrame([(1.0, 2.0)], "x double, y double")
    with ThreadPoolExecutor(4) as pool:
        got = list(pool.map(lambda i: (store.save(df.withColumn("x", F.lit(float(i))), "d", f"2024-01-0{i + 1}"), i), range(4)))
    assert sorted(v for v, _ in got) == [1, 2, 3, 4]
    assert all(store.load(name="d", version=v).first()["x"] == i for v, i in got) and store.list().count() == 4


def test_a_broken_save_is_not_seen(spark):
    store = Datasets(spark, f"{scratch(spark)}/sets")
    df = spark.createDataFrame([(1.0, 2.0)], "x double, y double")
    assert store.save(df, "d", "2024-01-01") == 1
    with pytest.raises(Exception, match="boom"):
        store.save(df.withColumn("x", F.raise_error(F.lit("boom")).cast("double")), "d", "2024-01-02")
    assert store.save(df, "d", "2024-01-03") == 3
    assert sorted(r["version"] for r in store.list().collect()) == [1, 3]


def test_linear_fits_pass_over_the_rows_once(spark):
    """Each iteration was a job over all rows before; coefficients are those of coordinate descent."""
    from tideline.plans import models

    rnd = random.Random(4)
    xs = [[rnd.gauss(0, 1) for _ in range(3)] for _ in range(400)]
    target = np.array([2 * x[0] - x[1] + 5 + rnd.gauss(0, 0.3) for x in xs])
    rows = spark.createDataFrame([(*x, y) for x, y in zip(xs, target.tolist())], "a double, b double, c double, y double")
    tracker, sc = spark.sparkContext.statusTracker(), spark.sparkContext
    for kind in ("ridge", "lasso", "elasticnet"):
        lr = models.linear(kind, 0.1, *models.moments(rows))
        try:
            sc.setJobGroup(f"fit {kind}", kind)
            got = models.train(rows, ["a", "b", "c"], lr).stages[-1]
            jobs = tracker.getJobIdsForGroup(f"fit {kind}")
        finally:
            sc.setLocalProperty("spark.jobGroup.id", None)
        assert len(jobs) <= 3
        want, x, y = np.zeros(3), np.array(xs) - np.mean(xs, 0), target - target.mean()
        l1, l2 = {"ridge": (0, 0.1 / 400), "lasso": (0.1, 0), "elasticnet": (0.05, 0.05)}[kind]
        for k in [0, 1, 2] * 500:  # coordinate descent on |y - xb|^2 / 2n + l1 |b| + l2 |b|^2 / 2
            r = x[:, k] @ (y - x @ want + x[:, k] * want[k]) / 400
            want[k] = np.sign(r) * max(abs(r) - l1, 0) / (x[:, k] @ x[:, k] / 400 + l2)
        assert abs(got.coefficients.toArray() - want).max() < 1e-6, kind

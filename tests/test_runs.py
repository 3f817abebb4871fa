import json
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tideline.plans import models
from tideline.plans.runs import Runs, combinations, fit, measured, retrain, search, train_and_record
from tideline.session import pin, scratch


@pytest.fixture(scope="module")
def priced(spark):
    """log(y + shift) is linear in x, where shift is |least training y| + 1; three parts by day."""
    rng, rows = np.random.default_rng(3), []
    for d in range(30):
        for _ in range(8):
            x = float(rng.normal())
            part = "train" if d < 20 else "val" if d < 25 else "test"
            rows.append((date(2024, 1, 1) + timedelta(days=d), float(np.exp(1.5 + 0.8 * x) - 1), x, float(rng.normal()), part))
    rows.append((date(2024, 1, 3), None, 0.1, 0.2, "train"))
    return pin(spark.createDataFrame(rows, "local_date date, y double, x double, noise double, split string").coalesce(1))


def ridge(df):
    n, sd = models.moments(df.where("split = 'train'"))
    return lambda alpha, kind="ridge": models.linear(kind, alpha, n, sd)


def test_transformed_target_is_scaled_back(priced):
    """Against numpy: least squares on log(y + shift) of the train part, metrics in the target's own scale."""
    pdf = priced.toPandas().dropna()
    tr = pdf[pdf.split == "train"]
    shift = abs(tr.y.min()) + 1
    b = np.polyfit(tr.x, np.log(tr.y + shift), 1)
    _, scored = fit(priced, ["x"], ridge(priced)(1e-9), "log_shift")
    got = measured(scored)
    for part, prefix in (("test", ""), ("val", "val_")):
        p = pdf[pdf.split == part]
        e = np.exp(np.polyval(b, p.x)) - shift - p.y
        assert got[prefix + "mae"] == pytest.approx(np.abs(e).mean(), rel=1e-4)
        assert got[prefix + "rmse"] == pytest.approx(np.sqrt((e**2).mean()), rel=1e-4)
    assert (got["n_train"], got["n_val"], got["n_test"]) == (160, 40, 40)
    assert sorted(scored.columns) == sorted([*priced.columns, "pred"])
    plain = measured(fit(priced, ["x"], ridge(priced)(1e-9))[1])
    assert got["mae"] < plain["mae"] / 2


def test_scalers_of_the_target(priced):
    got = measured(fit(priced, ["x"], ridge(priced)(1e-9), "quantile")[1])
    assert got["r2"] > 0.5


def test_a_run_is_recorded_with_its_parts(spark, priced):
    runs = Runs(spark, scratch(spark))
    assert runs.read().count() == 0
    with pytest.raises(LookupError):
        runs.best("s")
    numbers = train_and_record(priced.where("split <> 'val'"), ["x"], ridge(priced)(0.1), runs, "s", "one", {"alpha": 0.1})
    row = runs.read("s").first()
    assert row["params"] == '{"alpha": 0.1}' and row["mae"] == numbers["mae"] and row["n_val"] == 0 and row["val_mae"] is None


def test_an_interrupted_search_goes_on(spark, priced):
    """A trial that breaks is not recorded; the next search fits what is missing only, and its table equals one of a search in one go."""
    runs, made, broken = Runs(spark, scratch(spark)), [], {2.0}
    make = ridge(priced)

    def counted(alpha, kind):
        if alpha in broken:
            raise RuntimeError("lost")
        made.append((alpha, kind))
        return make(alpha, kind)

    data = {"x": (priced, ["x"]), "both": (priced, ["x", "noise"])}
    trials = combinations({"alpha": [0.5, 2.0], "kind": ["ridge"]})
    with pytest.raises(RuntimeError, match="lost"):
        search(data, trials, counted, runs, "grid")
    assert runs.read("grid").count() == 2 and {a for a, _ in made} == {0.5}
    made.clear()
    broken.clear()
    rows = search(data, trials, counted, runs, "grid").orderBy("dataset", "params").collect()
    assert len(rows) == 4 and {a for a, _ in made} == {2.0} and len(made) == 2
    made.clear()
    assert search(data, trials[:1], counted, runs, "grid").count() == 2 and not made
    other = search(data, trials, counted, Runs(spark, scratch(spark)), "grid").orderBy("dataset", "params").collect()
    assert [(r.dataset, r.params) for r in rows] == [(r.dataset, r.params) for r in other]
    assert np.allclose([r.mae for r in rows], [r.mae for r in other])
    model, best = retrain(data, counted, runs, "grid")
    least = min(rows, key=lambda r: (r.mae, r.dataset, r.params))
    assert best == {"dataset": least.dataset, "params": json.loads(least.params)}
    again = models.predict(model, data[best["dataset"]][0].where("split = 'test'"))
    assert again.agg(F.avg(F.abs(F.col("pred") - F.col("y")))).first()[0] == pytest.approx(least.mae)


def test_rows_recorded_twice_count_once(spark):
    runs = Runs(spark, scratch(spark))
    for mae in (2.0, None, 1.0):
        runs.add("s", "d", {"b": 1, "a": 2}, {"mae": mae, "rmse": 3.0})
    assert [(r.params, r.mae) for r in runs.read().collect()] == [('{"a": 2, "b": 1}', 1.0)]

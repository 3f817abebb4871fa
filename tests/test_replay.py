import random
import subprocess
import sys
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tideline.functions.features import with_holidays
from tideline.plans import blends, jobs, replay

START = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def gappy(spark):
    """Three series of 30 days with gaps of many lengths; one ends early, one begins late and has few values."""
    rnd, rows = random.Random(5), []
    for k, (first, last, rate) in {"a": (0, 720, 0.15), "b": (0, 400, 0.3), "c": (300, 720, 0.85)}.items():
        h = 0
        while h < 720:
            n = rnd.choice([1, 2, 3, 5, 6, 9, 40]) if rnd.random() < rate else 0
            rows += [(k, START + timedelta(hours=x), None) for x in range(h, min(h + n, 720))]
            h += n
            if h < 720:
                rows.append((k, START + timedelta(hours=h), rnd.gauss(50, 20) if first <= h < last else None))
            h += 1
    from tideline.session import pin

    return pin(spark.createDataFrame(rows, "k string, ts timestamp, value double"))


DATES = ["2023-12-31", "2024-01-02", "2024-01-12", "2024-01-19", "2024-01-20", "2024-01-31"]


@pytest.mark.parametrize("rule", replay.RULES)
def test_replay_equals_truncating(spark, gappy, rule):
    """Row for row what comes of cutting the table off at each date and repairing it anew."""
    seen = replay.view(replay.repair(gappy, rule, ["k"]), replay.delta(gappy, DATES, rule, ["k"]), DATES, 40, ["k"])
    got = {(r.k, str(r.as_of), r.ts): r.value for r in seen.collect()}
    changed, want = 0, {}
    full = {(r.k, r.ts): r.value for r in replay.repair(gappy, rule, ["k"]).collect()}
    for d in DATES:
        for r in replay.repair(gappy.where(F.col("ts") < F.lit(d).cast("timestamp")), rule, ["k"]).collect():
            want[r.k, d, r.ts] = r.value
            changed += r.value != full[r.k, r.ts]
    assert set(got) == set(want) and changed > 20
    for key, v in want.items():
        assert (v is None) == (got[key] is None), key
        assert v is None or abs(v - got[key]) < 1e-7 * max(1, abs(v)), key


def test_delta_is_near_the_cut(spark, gappy):
    rows = replay.delta(gappy, DATES, "spline", ["k"])
    assert rows.where("ts >= as_of").count() == 0 and rows.count() == rows.dropDuplicates(["k", "as_of", "ts"]).count()
    with pytest.raises(ValueError):
        replay.repair(gappy, "other", ["k"])


def test_history_needs_whole_days(spark):
    rows = [("k", "2024-01-05", START + timedelta(days=4, hours=h), m, float(h)) for h in range(24) for m in ("blend", "m")]
    rows += [("k", "2024-01-06", START + timedelta(days=5, hours=h), "blend", 1.0 if h else None) for h in range(24)] + [("k", "2024-01-07", START + timedelta(days=6, hours=h), "blend", 1.0) for h in range(23)]
    df = spark.createDataFrame(rows, "k string, as_of string, ts timestamp, model string, pred double").withColumn("as_of", F.col("as_of").cast("date"))
    got = replay.to_history(df, "2024-02-01", ["k"]).collect()
    assert [str(r.date) for r in got] == ["2024-01-05"] and got[0]["values"] == [float(h) for h in range(24)] and list(got[0].model_values) == ["m"]


def test_as_of_rows_by_running_counts(spark):
    rows = [(k, START + timedelta(days=d), 1.0) for k, n in (("a", 6), ("b", 3)) for d in range(n) for _ in range(2)]
    f = spark.createDataFrame(rows, "k string, local_date timestamp, y double").withColumn("local_date", F.to_date("local_date"))
    dates = spark.createDataFrame([("2024-01-03",), ("2024-01-06",), ("2024-03-01",)], "as_of string").select(F.col("as_of").cast("date"))
    got = sorted({(r.k, str(r.as_of), r.history_rows, r.y) for r in jobs.as_of_rows(f, dates, "y", least_rows=4, keys=["k"]).collect()})
    assert got == [("a", "2024-01-03", 4, None), ("a", "2024-01-06", 10, None), ("b", "2024-01-03", 4, None)]


def test_holidays_of_any_year(spark):
    days = ["1980-12-25", "1980-04-07", "2075-01-01", "2075-04-08", "2075-04-09", "2031-10-31"]
    df = spark.createDataFrame([(datetime.fromisoformat(f"{d} 12:00:00"),) for d in days], "ts timestamp")
    got = {str(r.ts)[:10]: r.holiday_score for r in with_holidays(df).collect()}
    assert [got[d] for d in days[:5]] == [1.0, 1.0, 1.0, 1.0, 0.0] and 0 < got[days[5]] < 1


def plain_nonnegative(g, x):
    best = (0.0, np.zeros(len(x)))
    for mask in range(1, 1 << len(x)):
        at = [i for i in range(len(x)) if mask >> i & 1]
        w = np.zeros(len(x))
        w[at] = np.linalg.lstsq(g[np.ix_(at, at)], x[at], rcond=None)[0]
        if (w >= 0).all():
            best = min(best, (w @ g @ w - 2 * w @ x, w), key=lambda b: b[0])
    return best


def test_nonnegative_weights_against_all_supports():
    rng = np.random.default_rng(3)
    for _ in range(200):
        n = int(rng.integers(1, 7))
        a, y = rng.normal(size=(30, n)) + rng.normal(size=(30, 1)), rng.normal(size=30) + 1
        g, x = a.T @ a / 30, a.T @ y / 30
        w = blends.nonnegative_solve(g, x)
        assert (w >= 0).all() and abs((w @ g @ w - 2 * w @ x) - plain_nonnegative(g, x)[0]) < 1e-9


def test_annealing_and_climbing(spark):
    rng = np.random.default_rng(4)
    n, y = 12, rng.normal(50, 10, 120)
    preds = y[:, None] + rng.normal(0, 4, (120, n)) + rng.normal(0, 6, n)
    names = [f"m{i}" for i in range(n)]
    table = spark.createDataFrame([(*map(float, p), float(v)) for p, v in zip(preds, y)], ", ".join(f"{x} double" for x in [*names, "y"])).coalesce(1).cache()
    masks = ((np.arange(1, 1 << n)[:, None] >> np.arange(n)) & 1).astype(float)
    mae = np.abs(masks @ preds.T / masks.sum(1)[:, None] - y).mean(1)
    found, value = blends.annealing(table, names)
    assert abs(value - mae.min()) < 1e-9 and found == [x for x, m in zip(names, masks[mae.argmin()]) if m]
    few = blends.annealing(table, names, chains=4, rounds=5)
    assert few == blends.annealing(table, names, chains=4, rounds=5) and few[1] >= mae.min() - 1e-12
    path = blends.hill_climb(table, names)
    assert all(a[2] > b[2] for a, b in zip(path, path[1:])) and path[-1][2] >= mae.min() - 1e-12


def test_annealing_over_thirty_models(spark):
    rng = np.random.default_rng(6)
    names = [f"m{i}" for i in range(30)]
    table = spark.createDataFrame([(*map(float, v + rng.normal(0, 3, 30)), float(v)) for v in rng.normal(50, 10, 60)], ", ".join(f"{x} double" for x in [*names, "y"])).coalesce(1).cache()
    found, value = blends.annealing(table, names, chains=4, rounds=5)
    assert set(found) <= set(names) and value <= blends.hill_climb(table, names)[0][2]


def test_workers_have_the_package_wherever_the_driver_runs(tmp_path):
    """From another folder, with the package on the driver's path only."""
    code = f"""
import sys; sys.path.insert(0, {str(jobs.__file__.rsplit('/tideline/', 1)[0])!r})
from tideline.session import session
from tideline.queries import modelling, series
from tideline import registry
spark = session("local[2]", 2)
for name in ("I12_holt_winters", "D07_spline"):
    registry.QUERIES[name](spark, "/root/testdata/sf0.001").write.parquet({str(tmp_path)!r} + "/" + name)
print("rows", spark.read.parquet({str(tmp_path)!r} + "/I12_holt_winters").count())
"""
    import os

    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=240)
    assert out.returncode == 0 and "rows" in out.stdout, out.stderr[-2000:]

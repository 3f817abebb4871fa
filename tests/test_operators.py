"""Operators against pandas or numpy on small edge cases; block-size invariance; no look-ahead."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tideline.functions import scalers
from tideline.operators import clean, days, gaps, merge, windows
from tideline.plans import blends, jobs, leakage, pipelines, production, scoring
from tideline.sources import readers
from tideline.specs import AvailabilityRule, PivotSpec, Step, WindowSpec, matches, resolve


def series(spark, values, start="2024-03-01", keys=("a",), step="h"):
    ts = pd.date_range(start, periods=len(values), freq=step)
    rows = [(k, t.to_pydatetime(), None if v is None else float(v)) for k in keys for t, v in zip(ts, values)]
    return spark.createDataFrame(rows, "k string, ts timestamp, v double"), ts


def collected(df, col="v", by="ts"):
    return [r[col] for r in df.orderBy(by).collect()]


@pytest.mark.parametrize("block", ["day", "week", "month"])
@pytest.mark.parametrize("adjust", [False, True])
def test_ewma_equals_pandas(spark, block, adjust):
    rng = np.random.default_rng(1)
    v = [None if rng.random() < 0.3 else rng.normal() for _ in range(400)]
    v[:30] = [None] * 30
    v[100:160] = [None] * 60
    df, ts = series(spark, v)
    got = np.array(collected(windows.ewma(df, "v", 6, ["k"], adjust=adjust, block=block), "ewma"), float)
    want = pd.Series(v, dtype=float).ewm(span=6, adjust=adjust, ignore_na=False).mean().to_numpy()
    np.testing.assert_allclose(got, want, atol=1e-10)


def test_ewma_fixture(spark):
    df, _ = series(spark, [1, 2, None, None, 5, 7])
    assert [round(x, 4) for x in collected(windows.ewma(df, "v", 3, ["k"]), "ewma")] == [1, 1.5, 1.5, 1.5, 4.3, 5.65]


@pytest.mark.parametrize("block", ["day", "week", "month"])
def test_ffill_and_gap_runs(spark, block):
    rng = np.random.default_rng(2)
    v = [None if rng.random() < 0.5 else float(i) for i in range(200)]
    df, _ = series(spark, v, keys=("a", "b"))
    want = pd.Series(v, dtype=float).ffill()
    got = collected(gaps.ffill(df, ["v"], ["k"], block=block).where("k = 'a'"))
    np.testing.assert_allclose(np.array(got, float), want)
    s = pd.Series(v, dtype=float)
    island = s.notna().cumsum()
    runs = s.isna().groupby(island).transform("sum").where(s.isna(), 0)
    assert collected(gaps.gap_runs(df, "v", ["k"], block=block).where("k = 'b'"), "run_length") == runs.tolist()


def test_spline_is_the_global_one(spark):
    rng = np.random.default_rng(3)
    full = np.cumsum(rng.normal(size=300))
    v = full.astype(object).copy()
    for a, n in ((50, 1), (80, 5), (120, 6), (0, 2), (297, 3), (290, 1)):
        v[a : a + n] = None
    df, _ = series(spark, list(v))
    got = np.array(collected(gaps.interpolate_gaps(df, ["v"], 5, ["k"])), float)
    x = np.array([i for i, a in enumerate(v) if a is not None], float)
    want = np.array([np.nan if a is None else a for a in v], float)
    at = np.r_[50, 80:85, 290]
    want[at] = gaps.cubic(x, np.array([v[int(i)] for i in x], float), at.astype(float))
    np.testing.assert_allclose(got, want, atol=1e-8)


def test_cubic_reproduces_cubics():
    x = np.array([0, 1, 2, 4, 5, 7.0])
    for n in (2, 3, 4, 6):
        p = np.poly1d(np.arange(1, min(n, 4) + 1))
        at = np.linspace(0, x[n - 1], 9)
        np.testing.assert_allclose(gaps.cubic(x[:n], p(x[:n]), at), p(at), atol=1e-9)


def test_dst_days_have_24_slots(spark):
    df, _ = series(spark, range(24 * 300), "2024-02-01")
    out = days.normalize_dst(df, ["v"], ["k"])
    counts = out.groupBy("local_date").count().orderBy("local_date").collect()[1:-1]
    assert all(r["count"] == 24 for r in counts)
    spring = {r.slot: r.v for r in out.where("local_date = '2024-03-31'").collect()}
    assert spring[2] == (spring[1] + spring[3]) / 2


def test_rolling_equals_brute_force(spark):
    rng = np.random.default_rng(4)
    v = [None if rng.random() < 0.2 else rng.normal() * 10 + 1e6 for _ in range(24 * 12)]
    df, ts = series(spark, v, "2024-01-01")
    specs = [WindowSpec(-3, -1, ("mean", "std", "min", "max", "sum")), WindowSpec(-2, 0, hours=(1, 2)), WindowSpec(-2, -1, end_hour=9)]
    got = windows.rolling(df, ["v"], specs, ["k"], tz="UTC").orderBy("ts").toPandas()
    s = pd.Series(v, index=ts, dtype=float)
    for t, row in zip(ts[::17], got.iloc[::17].itertuples()):
        day = t.normalize()
        w = s[(s.index >= day - pd.Timedelta(days=3)) & (s.index < day)].dropna()
        assert (len(w) == 0) == pd.isna(row.v_d3_d1_mean)
        if len(w):
            np.testing.assert_allclose([row.v_d3_d1_mean, row.v_d3_d1_std, row.v_d3_d1_min, row.v_d3_d1_max, row.v_d3_d1_sum], [w.mean(), w.std(ddof=0), w.min(), w.max(), w.sum()], rtol=1e-9, atol=1e-6)
        x = s[(s.index >= day - pd.Timedelta(days=2)) & (s.index < day) & ((s.index < day - pd.Timedelta(days=1)) | (s.index.hour < 9))].dropna()
        if len(x):
            np.testing.assert_allclose(row.v_d2_d1_to9_mean, x.mean(), rtol=1e-9)


def test_features_do_not_look_ahead(spark):
    v = list(np.random.default_rng(5).normal(size=24 * 40))
    late = v[: 24 * 30] + [x + 100 for x in v[24 * 30 :]]

    def features(values):
        df, _ = series(spark, values, "2024-01-01")
        out = windows.rolling(df, ["v"], [WindowSpec(-7, -1)], ["k"], tz="UTC")
        out = windows.same_hour_lag(out, "v", [1], ["k"], tz="UTC")
        out = windows.ewma_features(out, ["v"], [6], -1, None, ["k"], tz="UTC")
        return out.where("ts < '2024-01-31'").drop("v").orderBy("ts").toPandas()

    pd.testing.assert_frame_equal(features(v), features(late))


def test_windows_reject_clashes(spark):
    df, _ = series(spark, [1, 2])
    with pytest.raises(ValueError):
        windows.rolling(df, ["v"], [WindowSpec(-1, -1, end_hour=4, hours=(1,)), WindowSpec(-1, -1, hours=(1,))], ["k"])
    with pytest.raises(ValueError):
        windows.rolling(df, ["v"], [WindowSpec(-1, -1), WindowSpec(-2, -2)], ["k"], overwrite=True)


def test_incremental_equals_rebuild(spark):
    df, _ = series(spark, range(24 * 40), "2024-01-01", keys=("a", "b"))
    old = df.where("ts < '2024-01-25'")
    got = merge.upsert(old, df.where("ts >= '2024-01-10'"), ["k", "ts"], 14, ["k"])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, df.collect()))


def test_asof_edges(spark):
    daily = spark.createDataFrame([("2024-01-05", 1.0), ("2024-01-08", None), ("2024-01-10", 3.0)], "date string, p double").withColumn("date", F.to_date("date"))
    rows = spark.createDataFrame([(f"2024-01-{d:02d} 05:00:00",) for d in (4, 5, 6, 8, 9, 10, 12)], "ts string").withColumn("ts", F.to_timestamp("ts"))
    assert collected(merge.asof(rows, daily, ["p"]), "p") == [None, 1.0, 1.0, None, None, 3.0, 3.0]
    assert collected(merge.asof(rows, daily, ["p"], allow_exact=False), "p") == [None, None, 1.0, 1.0, None, None, 3.0]
    assert collected(merge.asof(rows, daily.limit(0), ["p"]), "p") == [None] * 7


def test_horizon_needs_24_slots(spark):
    df, _ = series(spark, range(48), "2024-01-01")
    fore, _ = series(spark, range(23), "2024-01-03")
    with pytest.raises(ValueError):
        merge.extend_horizon(df, fore, "2024-01-03", ["v"], [], ["k"])


def test_repairs(spark):
    df = spark.createDataFrame([(1, None, 2.0), (2, None, None), (3, 4.0, None)], "ts int, a double, b double")
    assert collected(df.withColumn("s", clean.any_sum(["a", "b"])), "s") == [2.0, None, 4.0]
    assert collected(clean.net_export(df, "n", ["a"], ["b"]), "n") == [-2.0, None, 4.0]
    assert clean.align_columns(df, ["b", "zz"]).columns == ["b", "zz"]


@pytest.mark.parametrize("kind", [scalers.LogShift, scalers.YeoJohnson, scalers.QuantileNormal])
def test_scalers_invert(spark, kind):
    v = list(np.random.default_rng(6).gamma(2, 10, size=300) - 5)
    df, _ = series(spark, v)
    m = kind(["v"]).fit(df)
    scaled = m.transform(df)
    np.testing.assert_allclose(collected(m.inverse(scaled)), v, atol=0.05 if kind is scalers.QuantileNormal else 1e-6)
    if kind is not scalers.LogShift:
        z = np.array(collected(scaled))
        assert abs(np.mean(z)) < 0.05 and abs(np.std(z) - 1) < 0.1


def test_holt_winters_follows_the_recurrence(spark):
    rng = np.random.default_rng(7)
    y = 10 + np.sin(np.arange(24 * 5) * 2 * np.pi / 24) * 3 + rng.normal(size=120)
    df, _ = series(spark, list(y))
    got = scoring.holt_winters_rolling(df, "v", ["k"], alpha=0.3, beta=0.1, gamma=0.2).orderBy("ts").collect()
    level, trend, seasons, want = y[:24].mean(), 0.0, list(y[:24] - y[:24].mean()), []
    for d in range(1, 5):
        want += [level + trend * (h + 1) + seasons[h] for h in range(24)]
        for h in range(24):
            x, old = y[24 * d + h], level
            level = 0.3 * (x - seasons[h]) + 0.7 * (level + trend)
            trend = 0.1 * (level - old) + 0.9 * trend
            seasons[h] = 0.2 * (x - level) + 0.8 * seasons[h]
    np.testing.assert_allclose([r.pred for r in got], want, atol=1e-9)


def test_holt_winters_of_several_series_with_gaps(spark):
    rng = np.random.default_rng(8)
    y = [float(v) if v > -1.5 else None for v in rng.normal(size=72)]
    a, _ = series(spark, y)
    both = a.unionByName(a.withColumn("k", F.lit("other")).withColumn("v", F.col("v") * 2)).unionByName(a.orderBy("ts").limit(24).withColumn("k", F.lit("short")))
    got = scoring.holt_winters_rolling(both, "v", ["k"]).orderBy("k", "ts").collect()
    by = {k: [r.pred for r in got if r.k == k] for k in {r.k for r in got}}
    alone = [r.pred for r in scoring.holt_winters_rolling(a, "v", ["k"]).orderBy("ts").collect()]
    (first,) = set(by) - {"other"}
    assert len(alone) == 48 and all(p is not None for p in alone)
    np.testing.assert_allclose(by[first], alone, atol=1e-12)
    np.testing.assert_allclose(by["other"], np.array(alone) * 2, atol=1e-9)
    assert scoring.holt_winters_rolling(a.limit(0), "v", ["k"]).count() == 0


def test_production_registry(spark, tmp_path):
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import SQLTransformer

    store = production.Production(spark, f"file://{tmp_path}/p")
    models = {m: PipelineModel([SQLTransformer(statement=f"SELECT *, {e} AS prediction FROM __THIS__")]) for m, e in (("a", "x"), ("b", "x * 2"))}
    config = spark.createDataFrame([("a", "c", ["x"], 0.75, 1.0), ("b", "c", ["x"], 0.25, 3.0)], "model string, category string, features array<string>, weight double, mae double")
    with pytest.raises(ValueError):
        store.save({"a": models["a"]}, config)
    store.save(models, config)
    df = spark.createDataFrame([(1, 4.0, 5.0)], "ts int, x double, y double")
    assert [(r.ts, r.y, r.pred) for r in store.blend(store.score(df)).collect()] == [(1, 5.0, 5.0)]
    assert sorted((r.model, r.n_features, r.weight) for r in store.summary().collect()) == [("a", 1, 0.75), ("b", 1, 0.25)]
    with pytest.raises(ValueError, match="x"):
        store.score(df.drop("x"))


def test_named_aggregates_and_retrains(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", None)], "k string, v double")
    got = {r.k: (r.v_mean, r.v_std, r.v_sum) for r in windows.aggregate(df, ["v"], ["mean", "std", "sum"], ["k"]).collect()}
    assert got == {"a": (2.0, 1.0, 4.0), "b": (None, None, None)}
    with pytest.raises(ValueError):
        windows.aggregate(df, ["v"], ["mode"])
    h = spark.createDataFrame([("a", 1, 10.0, 13.0), ("a", 2, 10.0, 11.0), ("b", 1, 0.0, 1.0)], "k string, date int, old_blend_mae double, new_blend_mae double")
    assert sorted((r.k, r.date, r.needs_reselection) for r in jobs.retrain_history(h.limit(0), h, 1, ["k"]).collect()) == [("a", 2, False), ("b", 1, False)]
    assert [r.date for r in jobs.retrain_history(h, h.limit(0), 1).collect()] == [2]


def test_folds_and_splits():
    assert scoring.folds(30, 2, 5, gap=1) == [(0, 0, 24, 25, 30), (1, 0, 19, 20, 25)]
    with pytest.raises(ValueError):
        scoring.folds(5, 3, 2)


def test_degradation_flag(spark):
    df = spark.createDataFrame([(10.0, 12.0), (10.0, 12.01), (0.0, 1.0)], "o double, n double")
    assert [r.f for r in df.select(blends.needs_reselection(F.col("o"), F.col("n")).alias("f")).collect()] == [False, True, False]


def test_simplex_weights_find_the_mixture(spark):
    rng = np.random.default_rng(8)
    a, b, c_ = rng.normal(size=(3, 500))
    rows = [(float(0.7 * x + 0.3 * y), float(x), float(y), float(z)) for x, y, z in zip(a, b, c_)]
    df = spark.createDataFrame(rows, "y double, a double, b double, c double")
    for loss in ("rmse", "mae"):
        w = blends.simplex_weights(df, ["a", "b", "c"], loss)
        assert abs(w["a"] - 0.7) < 1e-3 and abs(w["b"] - 0.3) < 1e-3 and w["c"] < 1e-3


def test_leakage_rules():
    rules = [AvailabilityRule("actual*", -1, 10), AvailabilityRule("price", -1), AvailabilityRule("actual_slow", -2)]
    window = lambda **k: [Step("windows", {"columns": ("actual_x",), "windows": (WindowSpec(-3, -1, **k),), "overwrite": True})]
    assert leakage.check(window(), rules, ["actual_x"]) and not leakage.check(window(), rules, ["actual_x"], "compat")
    assert not leakage.check([Step("windows", {"columns": ("actual_x",), "windows": (WindowSpec(-1, -1, end_hour=10),), "overwrite": True})], rules, ["actual_x"])
    assert leakage.check([Step("windows", {"columns": ("actual_x",), "windows": (WindowSpec(-1, -1, end_hour=11),), "overwrite": True})], rules, ["actual_x"])
    assert leakage.check([Step("windows", {"columns": ("actual_slow",), "windows": (WindowSpec(-1, -1),), "overwrite": True})], rules, ["actual_slow"])
    assert leakage.check([], rules, ["price"]) == ["price: never lagged or dropped"]
    with pytest.raises(ValueError):
        leakage.validate([], rules, ["price"])


def test_all_pipeline_versions_compile(spark):
    from tideline.queries.modelling import ROLES

    df, _ = series(spark, np.random.default_rng(9).normal(size=24 * 4).tolist())
    wide = df.select("ts", *[(F.col("v") * (i + 1)).alias(x) for i, x in enumerate(("view", "click", "purchase", "signup", "error"))])
    for version in ("v1_hourly", "v1_daily", "v1_preprocessor", "v1_ml", "v2", "v3", "v4", "v5_slim", "v5_full"):
        for cutoff in (10, 7, None):
            assert all(s.op in pipelines.OPS for s in pipelines.pipeline(version, ROLES, cutoff))
    for version, cutoff in (("v1_hourly", 10), ("v1_daily", 10), ("v5_full", None)):
        out = pipelines.compile_steps(pipelines.pipeline(version, ROLES, cutoff))(wide)
        assert len(set(out.columns)) == len(out.columns)
    with pytest.raises(ValueError):
        pipelines.compile_steps([])
    with pytest.raises(ValueError):
        pipelines.pipeline("v9", ROLES)


def test_names():
    assert matches("a*", "abc") and not matches("a*", "ba") and matches("*_x_*", "a_x_b") and not matches("a", "ab")
    assert resolve(["a1", "a2", "b"], ["a*", "b", "zz"], "keep") == ["a1", "a2", "b", "zz"]
    assert WindowSpec(-7, -1, hours=tuple(range(8, 20))).name("c", "mean") == "c_d7_d1_h8-19_mean"
    assert WindowSpec(-1, -1, end_hour=10).name("c", "mean") == "c_d1_to10_mean"


def test_pivot_day_offsets(spark):
    df, _ = series(spark, range(72), "2024-01-01")
    out = windows.daily_pivot(df, [PivotSpec("v", 0, "y"), PivotSpec("v", -1, "lag")], keys=["k"], tz="UTC").orderBy("local_date").collect()
    assert [r.y_5 for r in out] == [5, 29, 53] and [r.lag_5 for r in out] == [None, 5, 29]


def test_reports_of_any_length_and_header(spark, tmp_path):
    """Headers differ by file, cells are quoted, lines are many."""
    (tmp_path / "a.csv").write_text("Market report,,\n Date , Primary Market,Unnamed\r\n2024-01-01,1.5,\r\n\n2024-01-02,,\n")
    (tmp_path / "b.csv").write_text("Banner\nUnnamed,Secondary Market ,Date\n" + "".join(f'"x, {i}",{i},2024-02-{1 + i % 28:02}\n' for i in range(5000)))
    got = readers.read_report_csv(spark, f"file://{tmp_path}", {"Primary Market": "primary", "Secondary Market": "secondary"})
    assert got.count() == 5002
    rows = {(str(r.date), r.primary, r.secondary) for r in got.collect()}
    assert {("2024-01-01", 1.5, None), ("2024-01-02", None, None), ("2024-02-02", None, 1.0), ("2024-02-28", None, 4983.0)} <= rows


def test_hill_climb_takes_many_models(spark):
    """Of 14 models, with errors that cancel between the first two: these two are found."""
    names = [f"m{i:02}" for i in range(14)]
    rows = [(float(t), *[t + (3.0 if m == 0 else -3.0 if m == 1 else 4.0 + m + t % 3) for m in range(14)]) for t in range(60)]
    path = blends.hill_climb(spark.createDataFrame(rows, ["y", *names]), names)
    assert path[0][2] == 3.0 and path[-1][1] == "m00+m01" and path[-1][2] == 0.0


def test_user_functions_and_fitted_steps(spark):
    """A pipeline takes any function DataFrame -> DataFrame, also one that holds what it has learned."""
    train = spark.createDataFrame([(1, 2.0), (2, 6.0)], "i int, x double")

    def fit(df):
        mean = df.agg(F.avg("x")).first()[0]
        return lambda other: other.withColumn("centred", F.col("x") - mean)

    steps = [Step("custom", {"fn": lambda df: df.withColumn("x", F.col("x") * 2), "label": "double"}), Step("custom", {"fn": fit(train), "label": "centre"})]
    out = pipelines.compile_steps(steps)(spark.createDataFrame([(7, 5.0)], "i int, x double"))
    assert out.select("x", "centred").collect() == [(10.0, 6.0)]

"""Chronological splits, metrics, baselines, rolling Holt-Winters."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tideline.session import ship
from tideline.specs import c


def day_ranks(df: DataFrame, keys: list[str] = [], date: str = "local_date") -> DataFrame:
    """(keys, date, rank, n): place of each day among the key's days."""
    days = df.select(*keys, date).distinct()
    return days.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(date))).withColumn("n", F.count("*").over(Window.partitionBy(*keys)))


def chrono_split(df: DataFrame, shares: dict[str, float], keys: list[str] = [], date: str = "local_date", group: int = 1, out: str = "split") -> DataFrame:
    """Labels in order of time by share of days, rounded down to whole groups of days; the last label takes the rest."""
    days = day_ranks(df, keys, date)
    names, upto, bounds = list(shares), 0.0, []
    label = F.lit(names[-1])
    for name in names[:-1]:
        upto += shares[name]
        bounds.append((name, F.floor(F.col("n") * round(upto, 9) / group) * group))
    for name, edge in reversed(bounds):
        label = F.when(F.col("rank") <= edge, F.lit(name)).otherwise(label)
    return df.join(days.select(*keys, date, label.alias(out)), [*keys, date])


def folds(n_groups: int, n_splits: int, test: float | int = 0.1, mode: str = "expanding", gap: int = 0, train: int | None = None) -> list[tuple[int, int, int, int, int]]:
    """(fold, train_start, train_end, test_start, test_end) in group ordinals, ends exclusive, newest first."""
    size = int(n_groups * test) if isinstance(test, float) else test
    if size < 1:
        raise ValueError("the test part is empty")
    out = []
    for k in range(n_splits):
        end = n_groups - k * size
        start = end - size
        train_end = start - gap
        first = n_groups - n_splits * size - gap
        train_start = 0 if mode == "expanding" else max(0, train_end - (train or first))
        if train_end <= train_start:
            raise ValueError(f"fold {k} has nothing to train on")
        out.append((k, train_start, train_end, start, end))
    return out


def with_folds(df: DataFrame, spec: list[tuple[int, int, int, int, int]], keys: list[str] = [], date: str = "local_date") -> DataFrame:
    """Each row once per fold it is in, with fold and part (train or test)."""
    days = day_ranks(df, keys, date).withColumn("at_", F.col("rank") - 1)
    spans = F.array(*[F.struct(F.lit(f).alias("fold"), F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(p).alias("p"), F.lit(q).alias("q")) for f, a, b, p, q in spec])
    part = lambda s: F.when((F.col("at_") >= s["a"]) & (F.col("at_") < s["b"]), "train").when((F.col("at_") >= s["p"]) & (F.col("at_") < s["q"]), "test")
    tagged = days.select(*keys, date, F.inline(F.filter(F.transform(spans, lambda s: F.struct(s["fold"].alias("fold"), part(s).alias("part"))), lambda s: s["part"].isNotNull())))
    return df.join(tagged, [*keys, date])


def metric_columns(y: str | Column = "y", p: str | Column = "pred") -> dict[str, Column]:
    """rmse, mae, me and r2 over rows with both values, as aggregates."""
    y, p = (c(y) if isinstance(y, str) else y), (c(p) if isinstance(p, str) else p)
    both = y.isNotNull() & p.isNotNull()
    y, e = F.when(both, y), F.when(both, p - y)
    return {"mae": F.avg(F.abs(e)), "rmse": F.sqrt(F.avg(e * e)), "me": F.avg(e), "r2": 1 - F.try_divide(F.sum(e * e), F.nullif(F.var_pop(y) * F.count(y), F.lit(0.0)))}


def metrics(df: DataFrame, by: list[str] = [], y: str = "y", p: str = "pred") -> DataFrame:
    return df.groupBy(*by).agg(*[v.alias(k) for k, v in metric_columns(y, p).items()], F.count_if(c(y).isNotNull() & c(p).isNotNull()).alias("n"))


def daily_metrics(df: DataFrame, by: list[str] = [], slot: str = "slot", y: str = "y", p: str = "pred") -> DataFrame:
    """daily_max_rmse and rmse_std (of the population) over the slots' RMSEs, beside the overall metrics."""
    hours = df.groupBy(*by, slot).agg(metric_columns(y, p)["rmse"].alias("h"))
    spread = hours.groupBy(*by).agg(F.max("h").alias("daily_max_rmse"), F.stddev_pop("h").alias("rmse_std"))
    overall = metrics(df, by, y, p)
    return overall.join(spread, by) if by else overall.join(F.broadcast(spread))


def hourly_and_daily(df: DataFrame, by: list[str] = [], slot: str = "slot", y: str = "y", p: str = "pred") -> DataFrame:
    """(metric, value) with hourly_ and daily_ prefixes."""
    m = daily_metrics(df, by, slot, y, p)
    cells = [F.struct(F.lit(f"hourly_{k}").alias("metric"), c(k).alias("value")) for k in ("mae", "rmse", "me", "r2")] + [F.struct(F.lit(f"daily_{k}").alias("metric"), c(v).alias("value")) for k, v in (("mae", "mae"), ("rmse", "rmse"), ("max_rmse", "daily_max_rmse"), ("rmse_std", "rmse_std"))]
    return m.select(*by, F.inline(F.array(*cells)))


def skill(df: DataFrame, baseline: DataFrame, keys: list[str] = [], time: str = "ts", by: list[str] = [], y: str = "y", p: str = "pred", b: str = "base") -> DataFrame:
    """1 - error / baseline error over times that both have; missing where the baseline is perfect or absent."""
    both = df.join(baseline.select(*keys, time, c(b)), [*keys, time])
    own, base = metric_columns(y, p), metric_columns(y, b)
    return both.groupBy(*by).agg(*[(1 - F.try_divide(own[k], F.nullif(base[k], F.lit(0.0)))).alias(f"{k}_skill") for k in ("rmse", "mae")])


def model_day_errors(preds: DataFrame, actuals: DataFrame, date: str = "date", model: str = "model", array: str = "values") -> DataFrame:
    """model, date, mae, rmse of daily prediction arrays against complete actual days."""
    p = preds.select(date, model, F.posexplode(array).alias("slot", "pred"))
    a = actuals.select(date, F.posexplode(array).alias("slot", "y"))
    m = metric_columns()
    return p.join(a, [date, "slot"]).groupBy(date, model).agg(m["mae"].alias("mae"), m["rmse"].alias("rmse"))


def fold_summary(errors: DataFrame, model: str = "model") -> DataFrame:
    return errors.groupBy(model).agg(*[f(x).alias(f"{x}_{n}") for x in ("mae", "rmse") for n, f in (("mean", F.avg), ("std", F.stddev_pop))])


def naive_baselines(df: DataFrame, column: str, lags: dict[str, int], keys: list[str] = [], time: str = "ts") -> DataFrame:
    """(keys, time, baseline, y, pred): values some hours ago, by time; rows without one are left out."""
    y = df.where(c(column).isNotNull()).select(*keys, time, c(column).alias("y"))
    moved = F.explode(F.array(*[F.struct(F.lit(n).alias("baseline"), F.lit(h).alias("h")) for n, h in lags.items()]))
    past = y.select(*keys, time, F.col("y").alias("pred"), moved.alias("b_")).select(*keys, (c(time) + F.make_dt_interval(F.lit(0), F.col("b_.h"))).alias(time), "pred", F.col("b_.baseline").alias("baseline"))
    return y.join(past, [*keys, time])


def transformed_baselines(naive: DataFrame, shift: float) -> DataFrame:
    """The baselines again under transforms: none, and log_shift there and back."""
    back = F.exp(F.log(F.col("pred") + shift)) - shift
    cells = F.array(F.struct(F.lit("none").alias("transform"), F.col("pred").alias("pred")), F.struct(F.lit("log_shift").alias("transform"), back.alias("pred")))
    return naive.select(*[x for x in naive.columns if x != "pred"], F.inline(cells))


def holt_winters_rolling(df: DataFrame, column: str, keys: list[str], time: str = "ts", alpha: float = 0.2, beta: float = 0.01, gamma: float = 0.2, m: int = 24, horizon: int = 24) -> DataFrame:
    """(keys, time, y, pred): additive Holt-Winters; each day is forecast whole, then absorbed.

    The level starts at the first season's mean, the seasons at its deviations, the
    trend at 0. A series is folded in order (that is what the method is), as a stream
    of sorted rows of which a task holds one season; series run in parallel. Missing
    values are absorbed as their own forecast; a series of one season gives no rows.
    """
    ship(df.sparkSession)
    rows = df.select(*keys, c(time), c(column).cast("double").alias("y"), F.to_json(F.struct(*map(c, keys))).alias("key_") if keys else F.lit("").alias("key_"))
    ordered = rows.repartition(*map(c, keys or ["key_"])).sortWithinPartitions("key_", time, "y")
    schema = StructType([*[f for f in ordered.schema if f.name != "key_"], StructField("pred", DoubleType())])

    def fold(batches):
        now, state = None, None
        for batch in batches:
            preds = []
            for key, x in zip(batch.column("key_").to_pylist(), batch.column("y").to_pylist()):
                if key != now:
                    now, state = key, _Seasons(alpha, beta, gamma, m, horizon)
                preds.append(state.step(x))
            known = batch.drop_columns(["key_"]).append_column("pred", pa.array([p[1] for p in preds], pa.float64()))
            yield known.filter(pa.array([p[0] for p in preds], pa.bool_()))

    return ordered.mapInArrow(fold, schema)


class _Seasons:
    """The state of one series: level, trend, seasons, and those that the day's forecasts were made from."""

    def __init__(self, alpha: float, beta: float, gamma: float, m: int, horizon: int):
        self.rates, self.m, self.horizon, self.head, self.i = (alpha, beta, gamma), m, horizon, [], 0

    def step(self, x: float | None) -> tuple[bool, float | None]:
        """Whether the row is beyond the first season, and its forecast."""
        if len(self.head) < self.m:
            self.head.append(x)
            if len(self.head) == self.m:
                there = [v for v in self.head if v is not None]
                self.level, self.trend = sum(there) / max(len(there), 1), 0.0
                self.seasons = [0.0 if v is None else v - self.level for v in self.head]
            return False, None
        at, ahead = self.i % self.m, self.i % self.horizon
        if ahead == 0:
            self.made = self.level, self.trend, list(self.seasons)
        forecast = self.made[0] + self.made[1] * (ahead + 1) + self.made[2][at]
        (alpha, beta, gamma), season, before = self.rates, self.seasons[at], self.level
        if x is None:
            x = before + self.trend + season
        self.level = alpha * (x - season) + (1 - alpha) * (before + self.trend)
        self.trend = beta * (self.level - before) + (1 - beta) * self.trend
        self.seasons[at] = gamma * (x - self.level) + (1 - gamma) * season
        self.i += 1
        return True, forecast

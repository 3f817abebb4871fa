"""Fitted scalers with inverses. fit(df) runs one aggregate (or a few) and returns a model of plain numbers."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.specs import c


@dataclass
class LogShift:
    """log(x + shift), where shift = |least value of all columns| + 1."""

    columns: list[str]
    shift: float = 1.0

    def fit(self, df: DataFrame) -> LogShift:
        low = df.agg(F.min(F.least(*map(c, self.columns))) if len(self.columns) > 1 else F.min(self.columns[0])).first()[0]
        return LogShift(self.columns, abs(low or 0.0) + 1.0)

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({x: F.log(F.when(c(x) + self.shift > 0, c(x) + self.shift)) for x in self.columns})

    def inverse(self, df: DataFrame, columns: list[str] | None = None) -> DataFrame:
        return df.withColumns({x: F.exp(x) - self.shift for x in columns or self.columns})


def yeo_johnson(x: Column, lam: float) -> Column:
    up = F.log1p(x) if abs(lam) < 1e-9 else (F.pow(x + 1, F.lit(lam)) - 1) / lam
    down = -F.log1p(-x) if abs(lam - 2) < 1e-9 else -(F.pow(1 - x, F.lit(2 - lam)) - 1) / (2 - lam)
    return F.when(x >= 0, up).when(x < 0, down)


def yeo_johnson_inverse(y: Column, lam: float) -> Column:
    up = F.expm1(y) if abs(lam) < 1e-9 else F.pow(y * lam + 1, F.lit(1 / lam)) - 1
    down = 1 - F.exp(-y) if abs(lam - 2) < 1e-9 else 1 - F.pow(1 - y * (2 - lam), F.lit(1 / (2 - lam)))
    return F.when(y >= 0, up).when(y < 0, down)


@dataclass
class YeoJohnson:
    """Power transform of greatest likelihood per column, then mean 0 and deviation 1 (of the population)."""

    columns: list[str]
    params: dict[str, tuple[float, float, float]] | None = None  # lambda, mean, deviation

    def fit(self, df: DataFrame, low: float = -4.0, high: float = 6.0, grid: int = 11, rounds: int = 5) -> YeoJohnson:
        spans = {x: (low, high) for x in self.columns}
        for _ in range(rounds):  # every round is one aggregate over all columns and trial values
            trials = {x: [a + (b - a) * i / (grid - 1) for i in range(grid)] for x, (a, b) in spans.items()}
            aggs = [F.struct(F.log(F.var_pop(yeo_johnson(c(x), t))).alias("v"), F.avg(F.signum(x) * F.log1p(F.abs(x))).alias("j")).alias(f"{i}_{k}") for i, x in enumerate(self.columns) for k, t in enumerate(trials[x])]
            row = df.agg(*aggs).first()
            for i, x in enumerate(self.columns):
                score = [-(row[f"{i}_{k}"]["v"] or 0.0) / 2 + (t - 1) * (row[f"{i}_{k}"]["j"] or 0.0) for k, t in enumerate(trials[x])]
                best, width = trials[x][max(range(grid), key=score.__getitem__)], (spans[x][1] - spans[x][0]) / (grid - 1)
                spans[x] = (best - width, best + width)
        lam = {x: sum(s) / 2 for x, s in spans.items()}
        row = df.agg(*[f(yeo_johnson(c(x), lam[x])).alias(f"{n}_{i}") for i, x in enumerate(self.columns) for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
        return YeoJohnson(self.columns, {x: (lam[x], row[f"m_{i}"] or 0.0, row[f"s_{i}"] or 1.0) for i, x in enumerate(self.columns)})

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({x: (yeo_johnson(c(x), lam) - m) / s for x, (lam, m, s) in self.params.items()})

    def inverse(self, df: DataFrame) -> DataFrame:
        return df.withColumns({x: yeo_johnson_inverse(c(x) * s + m, lam) for x, (lam, m, s) in self.params.items()})


def normal_quantile(p: Column) -> Column:
    """Inverse of the normal distribution function by a rational start and two Newton steps."""
    q = F.least(p, 1 - p)
    t = F.sqrt(-2 * F.log(q))
    z = t - (t * (t * 0.010328 + 0.802853) + 2.515517) / (t * (t * (t * 0.001308 + 0.189269) + 1.432788) + 1)
    z = F.when(p < 0.5, -z).otherwise(z)
    # as a lambda over the start, each step's expression holds its argument once
    step = lambda z: z - (normal_cdf(z) - p) / (F.exp(-z * z / 2) / math.sqrt(2 * math.pi))
    for _ in range(2):
        z = F.get(F.transform(F.array(z), step), F.lit(0))
    return z


def normal_cdf(z: Column) -> Column:
    """Hart's double-precision form: a rational term near the middle, a continued fraction in the tails."""
    return F.get(F.transform(F.array(z), _cdf), F.lit(0))


def _cdf(z: Column) -> Column:
    x = F.abs(z)
    e = F.exp(-x * x / 2)
    num = den = F.lit(0.0)
    for k in (3.52624965998911e-02, 0.700383064443688, 6.37396220353165, 33.912866078383, 112.079291497871, 221.213596169931, 220.206867912376):
        num = num * x + k
    for k in (8.83883476483184e-02, 1.75566716318264, 16.064177579207, 86.7807322029461, 296.564248779674, 637.333633378831, 793.826512519948, 440.413735824752):
        den = den * x + k
    far = e / (x + 1 / (x + 2 / (x + 3 / (x + 4 / (x + 0.65))))) / 2.506628274631
    low = F.when(x > 37, 0.0).when(x < 7.07106781186547, e * num / den).otherwise(far)
    return F.when(z > 0, 1 - low).otherwise(low)


@dataclass
class QuantileNormal:
    """Empirical quantiles (``n`` knots) to a normal, linear between knots."""

    columns: list[str]
    n: int = 1000
    knots: dict[str, list[float]] | None = None

    def fit(self, df: DataFrame, accuracy: int = 100_000) -> QuantileNormal:
        at = [i / (self.n - 1) for i in range(self.n)]
        row = df.agg(*[F.percentile_approx(x, at, accuracy).alias(f"q{i}") for i, x in enumerate(self.columns)]).first()
        return QuantileNormal(self.columns, self.n, {x: [float(v) for v in row[f"q{i}"] or [0.0] * self.n] for i, x in enumerate(self.columns)})

    def _rank(self, x: Column, knots: list[float]) -> Column:
        arr = F.lit(knots)
        below, upto = F.size(F.filter(arr, lambda k: k < x)), F.size(F.filter(arr, lambda k: k <= x))
        lo, hi = F.get(arr, below - 1), F.get(arr, below)
        between = (below - 1 + F.try_divide(x - lo, hi - lo)) / (len(knots) - 1)
        # on a run of equal knots: its middle
        equal = (below + upto - 1) / 2 / (len(knots) - 1)
        return F.when(x.isNotNull(), F.when(upto == 0, 0.0).when(below == len(knots), 1.0).when(upto > below, equal).otherwise(between))

    def transform(self, df: DataFrame) -> DataFrame:
        edge = 1e-7
        return df.withColumns({x: normal_quantile(F.least(F.greatest(self._rank(c(x), k), F.lit(edge)), F.lit(1 - edge))) for x, k in self.knots.items()})

    def inverse(self, df: DataFrame) -> DataFrame:
        out = {}
        for x, k in self.knots.items():
            arr, n = F.lit(k), len(k) - 1

            def value(at: Column) -> Column:
                i = F.least(F.floor(at), F.lit(n - 1)).cast("int")
                return F.get(arr, i) + (at - i) * (F.get(arr, i + 1) - F.get(arr, i))

            out[x] = F.get(F.transform(F.array(normal_cdf(c(x)) * n), value), F.lit(0))
        return df.withColumns(out)


def no_op(df: DataFrame, columns: list[str], suffix: str = "_raw", keep: bool = True) -> DataFrame:
    out = df.withColumns({f"{x}{suffix}": c(x) for x in columns})
    return out if keep else out.drop(*columns)

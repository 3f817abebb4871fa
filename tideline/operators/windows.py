"""Day-relative windows, exponentially weighted means, lags, daily aggregates and pivots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.operators.days import local, with_local
from tideline.specs import MARKET_TZ, PivotSpec, WindowSpec, c, first_rule

EPOCH_DAY = "1970-01-01"


def _day_no() -> Column:
    return F.datediff("local_date", F.lit(EPOCH_DAY).cast("date"))


def _parts(columns: list[str], specs: list[WindowSpec]) -> dict[tuple, Column]:
    """The row filters that windows need: all, an hour set, or hours before a cutoff."""
    out = {}
    for s in specs:
        out[("h", s.hours)] = F.col("slot").isin(*s.hours) if s.hours else F.lit(True)
        if s.end_hour is not None:
            out[("to", s.end_hour)] = F.col("slot") < s.end_hour
    return out


def rolling(df: DataFrame, columns: list[str], specs: list[WindowSpec], keys: list[str] = [], tz: str = MARKET_TZ, time: str = "ts", overwrite: bool = False) -> DataFrame:
    """Statistics of rows of days [D + start, D + end], given to every row of day D.

    Days are summarised once (count, mean, squared deviations, extremes), windows
    run over those summaries by calendar day, and one join brings results back.
    std is that of the population; an empty sum is 0, other statistics missing.
    """
    if overwrite and (len(specs) != 1 or len(specs[0].aggs) != 1):
        raise ValueError("overwriting takes one window with one statistic")
    rows = with_local(df, tz, time)
    parts = _parts(columns, specs)
    tag = {p: f"p{i}" for i, p in enumerate(parts)}
    aggs = []
    for x in columns:
        for p, ok in parts.items():
            v = F.when(ok, c(x))
            aggs += [F.count(v).alias(f"n_{tag[p]}_{x}"), F.avg(v).alias(f"mu_{tag[p]}_{x}"), F.var_pop(v).alias(f"va_{tag[p]}_{x}"), F.min(v).alias(f"lo_{tag[p]}_{x}"), F.max(v).alias(f"hi_{tag[p]}_{x}")]
    days = rows.groupBy(*keys, "local_date").agg(*aggs).withColumn("day_", _day_no())
    everything, by_day = Window.partitionBy(*keys), Window.partitionBy(*keys).orderBy("day_")
    # deviations are taken from a centre per series, so squares stay small
    centre = {x: F.try_divide(F.sum(c(f"n_{t}_{x}") * F.coalesce(c(f"mu_{t}_{x}"), F.lit(0.0))).over(everything), F.sum(f"n_{t}_{x}").over(everything)) for x in columns for t in [tag[("h", specs[0].hours)]]}
    days = days.withColumns({f"centre_{x}": F.coalesce(v, F.lit(0.0)) for x, v in centre.items()})

    def over(x: str, p: tuple, start: int, end: int) -> dict[str, Column]:
        t, w = tag[p], by_day.rangeBetween(start, end)
        n, mu, off = c(f"n_{t}_{x}"), c(f"mu_{t}_{x}"), c(f"mu_{t}_{x}") - c(f"centre_{x}")
        return {"n": F.coalesce(F.sum(n).over(w), F.lit(0)), "sum": F.coalesce(F.sum(n * mu).over(w), F.lit(0.0)), "dev": F.coalesce(F.sum(n * off).over(w), F.lit(0.0)), "sq": F.coalesce(F.sum(n * (c(f"va_{t}_{x}") + off * off)).over(w), F.lit(0.0)), "min": F.min(f"lo_{t}_{x}").over(w), "max": F.max(f"hi_{t}_{x}").over(w)}

    out = {}
    for x in columns:
        for s in specs:
            if s.end_hour is None:
                m = over(x, ("h", s.hours), s.start_day, s.end_day)
            else:
                m = over(x, ("to", s.end_hour), s.end_day, s.end_day)
                if s.start_day < s.end_day:
                    full = over(x, ("h", s.hours), s.start_day, s.end_day - 1)
                    m = {k: F.least(m[k], full[k]) if k == "min" else F.greatest(m[k], full[k]) if k == "max" else m[k] + full[k] for k in m}
            mean = F.try_divide(m["sum"], m["n"])
            value = {"mean": mean, "sum": m["sum"], "min": m["min"], "max": m["max"], "std": F.sqrt(F.greatest(F.try_divide(m["sq"], m["n"]) - F.pow(F.try_divide(m["dev"], m["n"]), 2), F.lit(0.0)))}
            for a in s.aggs:
                name = x if overwrite else s.name(x, a)
                if name in out or (not overwrite and name in df.columns):
                    raise ValueError(f"two columns would be called {name}")
                out[name] = F.when(m["n"] > 0, value[a]) if a == "std" else value[a]
    stats = days.select(*keys, "local_date", *[v.alias(f"s_{k}") for k, v in out.items()])
    # a day that has rows now may look at days of which it is not one, so the day table itself is the left side
    joined = rows.join(stats, [*keys, "local_date"], "left")
    return joined.select(*[c(x) for x in df.columns if x not in out], *[c(f"s_{k}").alias(k) for k in out])


def ewma(df: DataFrame, column: str, span: float, keys: list[str] = [], time: str = "ts", adjust: bool = False, block: str = "month", out: str = "ewma") -> DataFrame:
    """(keys, time, out): the exponentially weighted mean at every row.

    Missing rows let old weight decay and carry the last mean on. A block is
    summarised by what it does to a state that comes in; the few summaries of a
    series are folded to each block's incoming state, and blocks are replayed
    from there, all at once.
    """
    a = 2.0 / (span + 1.0)
    keep = 1.0 - a
    blocks = df.withColumn("block_", F.date_trunc(block, time)).groupBy(*keys, "block_").agg(F.sort_array(F.collect_list(F.struct(c(time).alias("t"), c(column).cast("double").alias("x")))).alias("rows_"))

    # state: mean, weight it has when the next row comes (before decay), for adjust the weight is the sum of weights
    def step(s: Column, r: Column) -> Column:
        o, x = s["o"] * keep, r["x"]
        new = F.lit(1.0 if adjust else a)
        met = F.when(s["w"].isNull(), x).otherwise((o * s["w"] + new * x) / (o + new))
        weight = F.when(s["w"].isNull(), F.lit(1.0)).otherwise(o + 1.0 if adjust else F.lit(1.0))
        return F.struct(F.when(x.isNull(), s["w"]).otherwise(met).alias("w"), F.when(x.isNull(), o).otherwise(weight).alias("o"))

    none = F.struct(F.lit(None).cast("double").alias("w"), F.lit(1.0).alias("o"))
    # summary: rows ahead of the first value, that value, the affine map of the mean behind it, weight left at the end
    first = F.aggregate("rows_", F.struct(F.lit(0).alias("lead"), F.lit(None).cast("double").alias("x")), lambda s, r: F.struct(F.when(s["x"].isNull() & r["x"].isNull(), s["lead"] + 1).otherwise(s["lead"]).alias("lead"), F.coalesce(s["x"], r["x"]).alias("x")))
    summed = blocks.withColumn("first_", first).withColumn("n_", F.size("rows_"))
    if adjust:
        # numerator and denominator are linear in what comes in
        part = F.aggregate("rows_", F.struct(F.lit(0.0).alias("p"), F.lit(0.0).alias("q")), lambda s, r: F.struct((s["p"] * keep + F.coalesce(r["x"], F.lit(0.0))).alias("p"), (s["q"] * keep + F.when(r["x"].isNull(), 0.0).otherwise(1.0)).alias("q")))
        summary = F.struct("block_", F.col("n_").alias("n"), part.alias("s"))
        start = F.struct(F.lit(0.0).alias("p"), F.lit(0.0).alias("q"))

        def fold(s: Column, b: Column) -> Column:
            decay = F.pow(F.lit(keep), b["n"])
            return F.struct((s["p"] * decay + b["s"]["p"]).alias("p"), (s["q"] * decay + b["s"]["q"]).alias("q"))

        as_state = lambda s: F.struct(F.when(s["q"] > 0, F.try_divide(s["p"], s["q"])).alias("w"), F.when(s["q"] > 0, s["q"]).otherwise(1.0).alias("o"))
    else:
        tail = F.slice("rows_", F.col("first_.lead") + 2, F.greatest(F.col("n_") - F.col("first_.lead") - 1, F.lit(0)))
        unit = F.struct(F.lit(1.0).alias("A"), F.lit(0.0).alias("B"), F.lit(1.0).alias("o"))

        def compose(s: Column, r: Column) -> Column:
            o = s["o"] * keep
            return F.when(r["x"].isNull(), F.struct(s["A"].alias("A"), s["B"].alias("B"), o.alias("o"))).otherwise(F.struct((o * s["A"] / (o + a)).alias("A"), ((o * s["B"] + a * r["x"]) / (o + a)).alias("B"), F.lit(1.0).alias("o")))

        summary = F.struct("block_", F.col("n_").alias("n"), F.struct(F.col("first_.lead").alias("lead"), F.col("first_.x").alias("x"), F.aggregate(tail, unit, compose).alias("m")).alias("s"))
        start = none

        def fold(s: Column, b: Column) -> Column:
            o, x = s["o"] * F.pow(F.lit(keep), b["s"]["lead"] + 1), b["s"]["x"]
            w1 = F.when(s["w"].isNull(), x).otherwise((o * s["w"] + a * x) / (o + a))
            return F.when(x.isNull(), F.struct(s["w"].alias("w"), (s["o"] * F.pow(F.lit(keep), b["n"])).alias("o"))).otherwise(F.struct((b["s"]["m"]["A"] * w1 + b["s"]["m"]["B"]).alias("w"), b["s"]["m"]["o"].alias("o")))

        as_state = lambda s: s
    per_series = summed.groupBy(*keys).agg(F.sort_array(F.collect_list(summary)).alias("all_"))
    incoming = F.transform("all_", lambda b, i: F.struct(b["block_"].alias("block_"), as_state(F.aggregate(F.slice("all_", F.lit(1), i), start, fold)).alias("in_")))
    carried = per_series.select(*keys, F.inline(incoming))
    replayed = blocks.join(carried, [*keys, "block_"]).withColumn(
        "out_",
        F.aggregate("rows_", F.struct(F.col("in_").alias("s"), F.array().cast("array<double>").alias("ws")), lambda st, r: (lambda s: F.struct(s.alias("s"), F.array_append(st["ws"], s["w"]).alias("ws")))(step(st["s"], r)), lambda st: st["ws"]),
    )
    return replayed.select(*keys, F.explode(F.arrays_zip(F.col("rows_.t").alias("t"), F.col("out_").alias("w"))).alias("r_")).select(*keys, F.col("r_.t").alias(time), F.col("r_.w").alias(out))


def ewma_features(df: DataFrame, columns: list[str], spans: list[int], cutoff_day: int = -1, cutoff_hour: int | None = None, keys: list[str] = [], tz: str = MARKET_TZ, time: str = "ts", adjust: bool = False, suffix: str = "", block: str = "month") -> DataFrame:
    """Adds ``{column}_ewma_{span}{suffix}``: the mean as of day D + cutoff_day (its last row, or that of hour cutoff_hour - 1)."""
    rows = with_local(df, tz, time)
    for x in columns:
        for span in spans:
            name = f"{x}_ewma_{span}{suffix}"
            w = with_local(ewma(df, x, span, keys, time, adjust, block, "w_"), tz, time)
            if cutoff_hour is not None:
                w = w.where(F.col("slot") == cutoff_hour - 1)
            daily = w.groupBy(*keys, "local_date").agg(F.max_by("w_", time).alias(name)).withColumn("local_date", F.date_sub("local_date", cutoff_day))
            rows = rows.join(daily, [*keys, "local_date"], "left")
    return rows.drop("local_date", "slot")


def same_hour_lag(df: DataFrame, column: str, days: list[int], keys: list[str] = [], tz: str = MARKET_TZ, time: str = "ts") -> DataFrame:
    """Adds ``{column}_lag_{k}d``: the value of the same local hour k days ago (the mean where an hour repeats)."""
    rows = with_local(df, tz, time)
    values = rows.groupBy(*keys, "local_date", "slot").agg(F.avg(column).alias("v_"))
    for k in days:
        past = values.select(*keys, F.date_add("local_date", k).alias("local_date"), "slot", F.col("v_").alias(f"{column}_lag_{k}d"))
        rows = rows.join(past, [*keys, "local_date", "slot"], "left")
    return rows.drop("local_date", "slot")


def hour_lag(df: DataFrame, column: str, hours: list[int], keys: list[str] = [], time: str = "ts") -> DataFrame:
    """Adds ``{column}_lag_{h}h``: the value h hours ago, by time, not by row."""
    base = df
    for h in hours:
        past = base.groupBy(*keys, (c(time) + F.make_dt_interval(F.lit(0), F.lit(h))).alias(time)).agg(F.avg(column).alias(f"{column}_lag_{h}h"))
        df = df.join(past, [*keys, time], "left")
    return df


def daily_aggregates(df: DataFrame, columns: list[str], aggs: list[str], keys: list[str] = [], tz: str = MARKET_TZ, time: str = "ts") -> DataFrame:
    """Adds each row's daily ``{column}_daily_{agg}`` and ``{column}_daily_share`` (of the day's sum; missing where that is 0). std is the sample's."""
    day = Window.partitionBy(*keys, F.to_date(local(time, tz)))
    fn = {"sum": lambda x: F.coalesce(F.sum(x), F.lit(0.0)), "mean": F.avg, "max": F.max, "min": F.min, "std": F.stddev_samp}
    over = {"sum": lambda x: F.coalesce(F.sum(x).over(day), F.lit(0.0))} | {k: (lambda f: lambda x: f(x).over(day))(f) for k, f in fn.items() if k != "sum"}
    new = {f"{x}_daily_{a}": over[a](x) for x in columns for a in aggs}
    share = {f"{x}_daily_share": F.try_divide(c(x), F.nullif(F.sum(x).over(day), F.lit(0.0))) for x in columns}
    return df.withColumns(new | share)


def daily_pivot(df: DataFrame, pivots: list[PivotSpec], rules: list[tuple[str, str]] = (), keys: list[str] = [], tz: str = MARKET_TZ, time: str = "ts") -> DataFrame:
    """One row per (keys, local_date): 24 columns for each pivot, and every other column by its first matching rule, mean by default."""
    rows = with_local(df, tz, time)
    listed = {p.column for p in pivots}
    rest = [x for x, kind in df.dtypes if kind in ("double", "int", "bigint", "float") and x not in listed and x not in keys and x != time]
    fn = {"mean": F.avg, "sum": lambda x: F.coalesce(F.sum(x), F.lit(0)), "min": F.min, "max": F.max, "first": lambda x: F.min_by(x, F.when(c(x).isNotNull(), c(time))), "last": lambda x: F.max_by(x, F.when(c(x).isNotNull(), c(time)))}
    days = rows.groupBy(*keys, "local_date").agg(F.lit(1).alias("there_"), *[fn[first_rule(x, list(rules))](x).alias(x) for x in rest])
    for p in pivots:
        prefix = p.prefix or p.column
        slots = rows.groupBy(*keys, "local_date").agg(*[F.avg(F.when(F.col("slot") == h, c(p.column))).alias(f"{prefix}_{h}") for h in range(24)])
        days = days.join(slots.withColumn("local_date", F.date_sub("local_date", p.day_offset)), [*keys, "local_date"], "left")
    return days.drop("there_")


#: Named aggregates over what is there; the deviation is the population's.
AGGREGATES = {"mean": F.avg, "std": F.stddev_pop, "min": F.min, "max": F.max, "sum": F.sum}


def aggregate(df: DataFrame, columns: list[str], names: list[str], by: list[str] = []) -> DataFrame:
    """(by, ``{column}_{name}``) for each pair of a column and a name of ``AGGREGATES``."""
    if unknown := [n for n in names if n not in AGGREGATES]:
        raise ValueError(f"unknown aggregates {unknown}")
    return df.groupBy(*map(c, by)).agg(*[AGGREGATES[n](c(x)).alias(f"{x}_{n}") for x in columns for n in names])

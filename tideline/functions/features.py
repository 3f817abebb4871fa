"""Row-wise feature functions: spreads, ratios, shares, calendars, interactions, names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.operators.clean import any_sum
from tideline.operators.days import local
from tideline.specs import MARKET_TZ, c, resolve

# German state populations (millions) and periods of the cyclical terms.
STATE_POPULATIONS = {"NW": 17.9, "BY": 13.2, "BW": 11.1, "NI": 8.0, "HE": 6.3, "SN": 4.1, "RP": 4.1, "BE": 3.7, "SH": 2.9, "BB": 2.5, "ST": 2.2, "TH": 2.1, "HH": 1.9, "MV": 1.6, "SL": 1.0, "HB": 0.7}
CYCLES = {"hour": 24, "day_of_week": 7, "month": 12}


def drop_columns(df: DataFrame, exclude: list[str], include: list[str] = ()) -> DataFrame:
    kept = set(resolve(df.columns, list(include), "ignore"))
    return df.drop(*[x for x in resolve(df.columns, list(exclude), "ignore") if x not in kept])


def rename_target(df: DataFrame, old: str, new: str = "y") -> DataFrame:
    return df.withColumnRenamed(old, new)


def clean_name(text: Column) -> Column:
    """Lower case; blanks, slashes and colons become one underscore; reserved signs go."""
    x = F.regexp_replace(F.translate(text, " /\\:", "____"), r'[<>"|?*]', "")
    return F.lower(F.regexp_replace(F.regexp_replace(x, "_+", "_"), "^_+|_+$", ""))


def regime_flags(df: DataFrame, split, quarter_start, time: str = "ts") -> DataFrame:
    at = lambda t: F.lit(t).cast("timestamp")
    return df.withColumns({"regime_before_split": (c(time) < at(split)).cast("int"), "regime_quarter_hourly": (c(time) >= at(quarter_start)).cast("int")})


def spreads(df: DataFrame, target: str, others: list[str], drop: bool = False) -> DataFrame:
    out = df.withColumns({f"spread_{x}": c(target) - c(x) for x in others if x in df.columns})
    return out.drop(*others) if drop else out


def ratios(df: DataFrame, target: str, others: list[str], drop: bool = False) -> DataFrame:
    """Missing where the other is 0."""
    out = df.withColumns({f"ratio_{x}": F.try_divide(c(target), c(x)) for x in others if x in df.columns})
    return out.drop(*others) if drop else out


def net_exports(df: DataFrame, pairs: list[tuple[str, str, str]], drop: bool = False) -> DataFrame:
    """``net_export_{name}``; one side alone if the other column is absent."""
    new = {}
    for out, back, name in pairs:
        has = (out in df.columns, back in df.columns)
        if any(has):
            new[f"net_export_{name}"] = c(out) - c(back) if all(has) else c(out) if has[0] else -c(back)
    result = df.withColumns(new)
    return result.drop(*[x for p in pairs for x in p[:2]]) if drop else result


def generation_shares(df: DataFrame, sources: list[str], renewable: list[str] = (), load: str | None = None, drop: bool = False) -> DataFrame:
    """total_generation, ``{source}_pct``, and if asked renewable_pct and supply_demand_gap."""
    there = [x for x in sources if x in df.columns]
    total = any_sum(there)
    new = {"total_generation": total} | {f"{x}_pct": F.try_divide(c(x), total) for x in there}
    if renewable:
        new["renewable_pct"] = F.try_divide(any_sum([x for x in renewable if x in there]), total)
    if load:
        new["supply_demand_gap"] = total - c(load)
    out = df.withColumns(new)
    return out.drop(*there) if drop else out


def forecast_shares(df: DataFrame, total: str, parts: list[str], drop: bool = False) -> DataFrame:
    out = df.withColumns({f"{x}_pct": F.try_divide(c(x), c(total)) for x in parts if x in df.columns})
    return out.drop(*parts) if drop else out


def calendar(df: DataFrame, tz: str = MARKET_TZ, time: str = "ts", linear: bool = True, cyclical: bool = True) -> DataFrame:
    t = local(time, tz)
    parts = {"hour": F.hour(t), "day_of_week": F.weekday(t), "day_of_month": F.dayofmonth(t), "month": F.month(t), "week_of_year": F.weekofyear(t), "is_weekend": (F.weekday(t) >= 5).cast("int")}
    new = dict(parts) if linear else {}
    if cyclical:
        for name, period in CYCLES.items():
            angle = (parts[name] - (1 if name == "month" else 0)) * (2 * 3.141592653589793 / period)
            new |= {f"{name}_sin": F.sin(angle), f"{name}_cos": F.cos(angle)}
    return df.withColumns(new)


def easter(year: Column) -> Column:
    """Easter Sunday of the Gregorian calendar (anonymous algorithm of 1876)."""
    a, b, rest = year % 19, F.floor(year / 100), year % 100
    d, e = F.floor(b / 4), b % 4
    g = F.floor((b * 8 + 13) / 25)
    h = (a * 19 + b - d - g + 15) % 30
    i, k = F.floor(rest / 4), rest % 4
    m = (F.lit(32) + e * 2 + i * 2 - h - k) % 7
    n = F.floor((a + h * 11 + m * 22) / 451)
    return F.make_date(year.cast("int"), F.floor((h + m - n * 7 + 114) / 31).cast("int"), ((h + m - n * 7 + 114) % 31 + 1).cast("int"))


#: Public holidays as (days from Easter or month and day, states; none: all).
HOLIDAYS: list[tuple[int | tuple[int, int], tuple[str, ...]]] = [
    ((1, 1), ()), ((1, 6), ("BW", "BY", "ST")), (-2, ()), (1, ()), ((5, 1), ()), (39, ()), (50, ()),
    (60, ("BW", "BY", "HE", "NW", "RP", "SL")), ((8, 15), ("BY", "SL")), ((10, 3), ()),
    ((10, 31), ("BB", "MV", "SN", "ST", "TH", "HB", "HH", "NI", "SH")), ((11, 1), ("BW", "BY", "NW", "RP", "SL")),
    ((12, 25), ()), ((12, 26), ()),
]


def with_holidays(df: DataFrame, tz: str = MARKET_TZ, time: str = "ts", populations: dict[str, float] = STATE_POPULATIONS) -> DataFrame:
    """Adds holiday_score: the share of people whose state has a holiday on the local day; 0 on other days, whatever the year."""
    total = sum(populations.values())
    day = df.withColumn("date_", F.to_date(local(time, tz))).withColumn("easter_", easter(F.year("date_")))
    score = F.lit(0.0)
    for when, states in HOLIDAYS:
        here = F.datediff("date_", "easter_") == when if isinstance(when, int) else (F.month("date_") == when[0]) & (F.dayofmonth("date_") == when[1])
        score = score + F.when(here, sum(populations[s] for s in states) / total if states else 1.0).otherwise(0.0)
    return day.withColumn("holiday_score", F.least(score, F.lit(1.0))).drop("date_", "easter_")


def total_flows(df: DataFrame, exports: list[str], imports: list[str]) -> DataFrame:
    return df.withColumns({"total_exports": any_sum(exports), "total_imports": any_sum(imports)})


def ranges(df: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """name -> largest minus smallest."""
    return df.withColumns({k: c(hi) - c(lo) for k, (hi, lo) in pairs.items()})


def day_interactions(df: DataFrame, columns: list[str], tz: str = MARKET_TZ, time: str = "ts", origin: str = "2015-01-05") -> DataFrame:
    day = F.datediff(F.to_date(local(time, tz)), F.lit(origin).cast("date"))
    new = {"day_index": day, "year_index": F.year(local(time, tz)) - int(origin[:4])}
    return df.withColumns(new | {f"{x}_x_day": c(x) * day for x in columns})


def decay_weights(df: DataFrame, day: str = "day_index", half_life: float = 365.0, out: str = "weight") -> DataFrame:
    newest = df.agg(F.max(day).alias("newest_"))
    return df.join(F.broadcast(newest)).withColumn(out, F.exp(F.lit(0.6931471805599453 / half_life) * (c(day) - F.col("newest_")))).drop("newest_")


def group_importance(df: DataFrame, groups: list[tuple[str, str]], feature: str = "feature", importance: str = "importance") -> DataFrame:
    """feature_group, total, n, mean by the first group whose pattern is found; ``other`` for the rest."""
    label = F.lit("other")
    for name, pattern in reversed(groups):
        label = F.when(c(feature).rlike(pattern), F.lit(name)).otherwise(label)
    return df.groupBy(label.alias("feature_group")).agg(F.sum(importance).alias("total"), F.count("*").alias("n"), F.avg(importance).alias("mean"))


#: Which category a model class belongs to.
MODEL_CATEGORIES = {"Ridge": "linear", "Lasso": "linear", "ElasticNet": "linear", "HuberRegressor": "linear", "LGBMRegressor": "lightgbm", "XGBRegressor": "xgboost", "CatBoostRegressor": "catboost"}


def model_category(df: DataFrame, model_class: str = "model_class", categories: dict[str, str] = MODEL_CATEGORIES) -> DataFrame:
    pairs = F.create_map(*[F.lit(x) for kv in categories.items() for x in kv])
    return df.withColumn("category", F.coalesce(F.try_element_at(pairs, c(model_class)), F.lit("other")))

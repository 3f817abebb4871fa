"""Feature pipelines as lists of steps, and the function that folds them over a table.

Versions are written against roles (target, neighbour prices, actuals, forecasts,
commodities, flows), so one definition serves any table whose columns are named
in a ``Roles``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from tideline.functions import features as ft
from tideline.functions.scalers import LogShift
from tideline.operators import windows as win
from tideline.session import pin
from tideline.specs import MARKET_TZ, PivotSpec, Step, WindowSpec, check_steps, resolve


@dataclass(frozen=True)
class Roles:
    target: str
    neighbours: tuple[str, ...] = ()
    actuals: tuple[str, ...] = ()
    morning: tuple[str, ...] = ()
    generation: tuple[str, ...] = ()
    renewable: tuple[str, ...] = ()
    load: str | None = None
    forecast_total: str | None = None
    forecast_parts: tuple[str, ...] = ()
    forecasts: tuple[str, ...] = ()
    commodities: tuple[str, ...] = ()
    flows: tuple[tuple[str, str, str], ...] = ()
    drop: tuple[str, ...] = ()


def _compute_window(df, p, keys, tz):
    return win.rolling(df, [x for x in p["columns"] if x in df.columns], list(p["windows"]), keys, tz, overwrite=p.get("overwrite", False))


def _scale(df, p, keys, tz):
    columns = resolve(df.columns, list(p["columns"]), "ignore")
    return LogShift(columns).fit(df).transform(df) if columns else df


OPS = {
    "calendar": lambda df, p, k, tz: ft.calendar(df, tz, linear=p.get("linear", True), cyclical=p.get("cyclical", True)),
    "holidays": lambda df, p, k, tz: ft.with_holidays(df, tz),
    "spreads": lambda df, p, k, tz: ft.spreads(df, p["target"], list(p["others"]), p.get("drop", False)),
    "ratios": lambda df, p, k, tz: ft.ratios(df, p["target"], list(p["others"]), p.get("drop", False)),
    "net_exports": lambda df, p, k, tz: ft.net_exports(df, list(p["pairs"]), p.get("drop", False)),
    "total_flows": lambda df, p, k, tz: ft.total_flows(df, list(p["exports"]), list(p["imports"])),
    "shares": lambda df, p, k, tz: ft.generation_shares(df, list(p["sources"]), list(p.get("renewable", ())), p.get("load")),
    "forecast_shares": lambda df, p, k, tz: ft.forecast_shares(df, p["total"], list(p["parts"])),
    "windows": _compute_window,
    "ewma": lambda df, p, k, tz: win.ewma_features(df, list(p["columns"]), list(p["spans"]), p.get("cutoff_day", -1), p.get("cutoff_hour"), k, tz, suffix=p.get("suffix", "")),
    "same_hour_lag": lambda df, p, k, tz: win.same_hour_lag(df, p["column"], list(p["days"]), k, tz),
    "hour_lag": lambda df, p, k, tz: win.hour_lag(df, p["column"], list(p["hours"]), k),
    "daily": lambda df, p, k, tz: win.daily_aggregates(df, list(p["columns"]), list(p["aggs"]), k, tz),
    "pivot": lambda df, p, k, tz: win.daily_pivot(df, list(p["pivots"]), list(p.get("rules", ())), k, tz),
    "ranges": lambda df, p, k, tz: ft.ranges(df, dict(p["pairs"])),
    "rename": lambda df, p, k, tz: ft.rename_target(df, p["old"], p["new"]),
    "drop": lambda df, p, k, tz: ft.drop_columns(df, list(p["exclude"]), list(p.get("include", ()))),
    "interactions": lambda df, p, k, tz: ft.day_interactions(df, [x for x in p["columns"] if x in df.columns], tz),
    "log_shift": _scale,
    "custom": lambda df, p, k, tz: p["fn"](df),
    "fitted": lambda df, p, k, tz: p["estimator"].fit(df).transform(df),
}


#: Steps that join a table with what they make from it.
JOINING = {"windows", "ewma", "same_hour_lag", "hour_lag", "pivot"}


def compile_steps(steps: list[Step], keys: list[str] = [], tz: str = MARKET_TZ, cut=pin):
    """A function DataFrame -> DataFrame that applies the steps in order.

    Ahead of each joining step ``cut`` pins the table, so the plan grows with the
    number of steps and not as a power of it.
    """
    check_steps(steps)
    if unknown := [s.op for s in steps if s.op not in OPS]:
        raise ValueError(f"unknown operators {unknown}")

    def run(df: DataFrame) -> DataFrame:
        for i, s in enumerate(steps):
            if i and s.op in JOINING:
                df = cut(df)
            df = OPS[s.op](df, s.params, keys, s.params.get("tz", tz))
        return df

    return run


def target_windows(n: int) -> list[WindowSpec]:
    """The target's windows of the versions: 10, 12 or 15 statistics."""
    out = [WindowSpec(-7, -7), WindowSpec(-7, -1, ("mean", "std", "max", "min")), WindowSpec(-7, -1, hours=tuple(range(8, 20))), WindowSpec(-30, -1, ("mean", "std", "min", "max"))]
    if n >= 12:
        out += [WindowSpec(-2, -1, ("std",)), WindowSpec(-3, -1, ("std",))]
    if n >= 15:
        out += [WindowSpec(-1, -1, ("max", "min", "std"))]
    return out


def known_lags(r: Roles, more: tuple[str, ...] = ()) -> list[Step]:
    """Columns replaced by the last day's mean that is known: actuals and commodities two days ago, prices one."""
    lag = lambda columns, day: Step("windows", {"columns": tuple(columns), "windows": (WindowSpec(day, day),), "overwrite": True, "label": f"lag{day}{len(columns)}{columns[:1]}"})
    return [lag(cs, d) for cs, d in ((r.actuals + more, -2), (r.neighbours, -1), (r.commodities, -2)) if cs]


def _pivots(r: Roles, prices: bool = True) -> list[PivotSpec]:
    return [PivotSpec(r.target, 0, "y"), *([PivotSpec("price_lag", -1, "price_lag")] if prices else []), *[PivotSpec(x, 0) for x in r.forecasts]]


def _shares(r: Roles, renewable: bool = False, gap: bool = False) -> list[Step]:
    out = []
    if r.generation:
        out.append(Step("shares", {"sources": r.generation, "renewable": r.renewable if renewable else (), "load": r.load if gap else None}))
    if r.forecast_total:
        out.append(Step("forecast_shares", {"total": r.forecast_total, "parts": r.forecast_parts}))
    return out


def _price_lag(r: Roles) -> Step:
    from pyspark.sql import functions as F

    return Step("custom", {"fn": lambda df: df.withColumn("price_lag", F.col(f"`{r.target}`")), "label": "price_lag"})


def pipeline(version: str, r: Roles, morning_cutoff: int | None = 10) -> list[Step]:
    """The named versions: v1_hourly, v1_daily, v1_preprocessor, v1_ml, v2, v3, v4, v5_slim, v5_full."""
    t10 = Step("windows", {"columns": (r.target,), "windows": tuple(target_windows(10)), "label": "target"})
    spans = (6, 24, 168, 720, 2160)
    old_ewma = Step("ewma", {"columns": (r.target,), "spans": spans, "label": "ewma"})
    relative = [Step("spreads", {"target": r.target, "others": r.neighbours}), Step("net_exports", {"pairs": r.flows})]
    ratio = Step("ratios", {"target": r.target, "others": r.neighbours})
    cal = [Step("calendar"), Step("holidays")]
    drop = Step("drop", {"exclude": r.drop, "label": "drop"})
    no_hours = Step("drop", {"exclude": ("hour", "hour_sin", "hour_cos"), "label": "hours"})
    price_range = Step("ranges", {"pairs": {f"price_range_{n}d": (f"{r.target}_d{n}_d1_max", f"{r.target}_d{n}_d1_min") for n in (7, 30)}})
    months = Step("drop", {"exclude": ("month*", "regime*", *[x for f in r.flows for x in f[:2]]), "label": "months"})
    if version == "v1_hourly":
        return [*cal, *relative, ratio, *_shares(r), drop]
    if version in ("v1_daily", "v1_preprocessor"):
        daily = version == "v1_daily"
        steps = [*relative, *([ratio] if daily else []), t10, old_ewma, _price_lag(r), *known_lags(r), *_shares(r), *cal, Step("pivot", {"pivots": tuple(_pivots(r))}), no_hours]
        return steps + ([Step("log_shift", {"columns": ("y_*", "price_lag_*")})] if daily else [])
    if version == "v1_ml":
        return [Step("custom", {"fn": lambda df: df, "label": "passthrough"})]
    if version == "v2":
        return [t10, old_ewma, _price_lag(r), *known_lags(r), *_shares(r)[1:], *cal, Step("pivot", {"pivots": tuple(_pivots(r))}), no_hours]
    if version in ("v3", "v4"):
        head = [
            t10,
            Step("ewma", {"columns": (r.target, *r.neighbours[:4]), "spans": (6, 24, 2160), "label": "prices"}),
            Step("ewma", {"columns": r.actuals[:3], "spans": (24, 168, 2160), "cutoff_hour": morning_cutoff, "label": "actuals"}),
            Step("ewma", {"columns": r.commodities, "spans": (24, 720, 2160), "cutoff_day": -2, "label": "commodities"}),
            Step("windows", {"columns": r.morning or r.actuals, "windows": (WindowSpec(-1, -1, hours=tuple(range(morning_cutoff + 1 if morning_cutoff else 11))),), "label": "morning"}),
        ]
        if version == "v3":
            return [*head, _price_lag(r), *known_lags(r), *_shares(r, True, True), Step("calendar"), price_range, months, Step("pivot", {"pivots": tuple(_pivots(r))})]
        return [*head, *known_lags(r), Step("same_hour_lag", {"column": r.target, "days": (1, 7)}), Step("daily", {"columns": r.forecasts[:2], "aggs": ("sum", "mean", "max")}), *_shares(r, True, True), Step("calendar"), price_range, Step("rename", {"old": r.target, "new": "y"}), months]
    if version in ("v5_slim", "v5_full"):
        full, h = version == "v5_full", morning_cutoff
        outs, backs = tuple(f[0] for f in r.flows), tuple(f[1] for f in r.flows)
        morning = r.morning if full else r.morning[:3]
        steps = [Step("windows", {"columns": (r.target,), "windows": tuple(target_windows(15 if full else 12)), "label": "target"}), Step("ewma", {"columns": (r.target, *r.neighbours[:1]), "spans": (6, 24, 2160), "label": "prices"})]
        if h is not None:
            steps.append(Step("ewma", {"columns": (r.target,), "spans": (6, 24), "cutoff_hour": h, "suffix": f"_h{h}", "label": "today"}))
        steps += [Step("ewma", {"columns": r.actuals[:3], "spans": (24, 168, 2160), "cutoff_day": -1 if h is not None else -2, "cutoff_hour": h, "label": "actuals"}), Step("ewma", {"columns": r.commodities, "spans": (24, 720, 2160), "cutoff_day": -2, "label": "commodities"})]
        if h is not None and morning:
            steps.append(Step("windows", {"columns": morning, "windows": (WindowSpec(-1, -1, hours=tuple(range(h))),), "label": "morning"}))
        if full and r.neighbours:
            steps.append(Step("windows", {"columns": r.neighbours[:4], "windows": (WindowSpec(-1, -1, ("max", "min", "std")),), "label": "neighbours"}))
        steps.append(Step("total_flows", {"exports": outs, "imports": backs}))
        steps += [Step("same_hour_lag", {"column": x, "days": (1, 2) if full else (1,), "label": f"lag {x}"}) for x in r.neighbours[:2]]
        steps += [Step("same_hour_lag", {"column": x, "days": (2,), "label": f"lag {x}"}) for x in r.actuals[:3]]
        steps.append(Step("same_hour_lag", {"column": r.target, "days": (1, 2, 7, 14), "label": "lag target"}))
        if full:
            steps += [Step("hour_lag", {"column": r.target, "hours": (25, 26), "label": "near target"}), *[Step("hour_lag", {"column": x, "hours": (1, 2), "label": f"near {x}"}) for x in r.forecasts]]
        steps += known_lags(r, ("total_exports", "total_imports"))
        steps += [Step("daily", {"columns": r.forecasts if full else r.forecasts[:2], "aggs": ("sum", "mean", "max", "min", "std") if full else ("sum", "mean", "max")}), *_shares(r, full, True), Step("calendar"), price_range, Step("rename", {"old": r.target, "new": "y"})]
        steps += [drop, Step("interactions", {"columns": (f"{r.target}_d7_d1_mean", f"{r.target}_lag_1d", *r.forecasts[:2], *r.commodities[:1]) if not full else (f"{r.target}_d7_d1_mean", f"{r.target}_lag_1d", f"{r.target}_lag_7d", *r.forecasts, *r.commodities, *r.neighbours[:2])})]
        return [s for s in steps if s.params.get("columns", True)]
    raise ValueError(f"unknown version {version}")

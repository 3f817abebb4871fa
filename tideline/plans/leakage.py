"""Leakage checks: of a pipeline's steps against availability rules, and of data against prediction times."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.specs import AvailabilityRule, Step, c, matches


def rule_for(column: str, rules: list[AvailabilityRule]) -> AvailabilityRule | None:
    """The tightest matching rule: the earliest day, then the earliest hour."""
    found = [r for r in rules if matches(r.pattern, column)]
    return min(found, key=lambda r: (r.max_offset, 24 if r.cutoff_hour is None else r.cutoff_hour), default=None)


def _too_late(rule: AvailabilityRule, end_day: int, end_hour: int | None, hours: tuple[int, ...] | None, strict: bool) -> bool:
    if end_day != rule.max_offset or rule.cutoff_hour is None:
        return end_day > rule.max_offset
    if end_hour is not None:
        return end_hour > rule.cutoff_hour
    if hours and strict:
        return max(hours) >= rule.cutoff_hour
    return strict


def check(steps: list[Step], rules: list[AvailabilityRule], inputs: list[str], mode: str = "strict") -> list[str]:
    """What the steps see too early, and which inputs with a rule no step makes safe; ``compat`` skips the checks within the cutoff day."""
    strict, out, handled = mode == "strict", [], set()
    for s in steps:
        p = s.params
        for x in p.get("columns", ()) if s.op in ("windows", "ewma") else ():
            rule = rule_for(x, rules)
            if rule is None:
                continue
            if s.op == "windows":
                for w in p["windows"]:
                    if _too_late(rule, w.end_day, w.end_hour, w.hours, strict):
                        out.append(f"{x}: window to day {w.end_day} but known to {rule.max_offset}" + (f" before {rule.cutoff_hour}:00" if rule.cutoff_hour is not None else ""))
                if p.get("overwrite"):
                    handled.add(x)
            elif _too_late(rule, p.get("cutoff_day", -1), p.get("cutoff_hour"), None, strict):
                out.append(f"{x}: mean as of day {p.get('cutoff_day', -1)} but known to {rule.max_offset}")
        if s.op == "same_hour_lag" and (rule := rule_for(p["column"], rules)):
            late = [k for k in p["days"] if -k > rule.max_offset or strict and -k == rule.max_offset and rule.cutoff_hour is not None]
            out += [f"{p['column']}: lag of {k} days but known to {rule.max_offset}" for k in late]
        if s.op == "rename":
            handled.add(p["old"])
        if s.op == "drop":
            handled |= {x for x in inputs if any(matches(e, x) for e in p["exclude"])}
        if s.op == "pivot":
            handled |= {v.column for v in p["pivots"] if v.prefix == "y"}
    out += [f"{x}: never lagged or dropped" for x in inputs if x not in handled and (r := rule_for(x, rules)) and r.max_offset < 0]
    return out


def validate(steps: list[Step], rules: list[AvailabilityRule], inputs: list[str], mode: str = "strict") -> None:
    if found := check(steps, rules, inputs, mode):
        raise ValueError("; ".join(found))


def audit(features: DataFrame, feature: str = "feature", available_at: str = "available_at", predicted_at: str = "predicted_at") -> DataFrame:
    """feature, n, n_violations: how often a value was not yet available when it was used."""
    return features.groupBy(feature).agg(F.count("*").alias("n"), F.count_if(c(available_at) > c(predicted_at)).alias("n_violations"))

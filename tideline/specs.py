"""Specifications and names: pure Python, worked out before any Spark job runs."""

from __future__ import annotations

import fnmatch
import warnings
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

MARKET_TZ = "Europe/Berlin"


def c(name: str) -> Column:
    """A column by its exact name, whatever signs are in it."""
    return F.col(f"`{name}`")


@dataclass(frozen=True)
class WindowSpec:
    """Days [D + start_day, D + end_day]; only ``hours``, or before ``end_hour`` on the last day."""

    start_day: int
    end_day: int
    aggs: tuple[str, ...] = ("mean",)
    hours: tuple[int, ...] | None = None
    end_hour: int | None = None

    def __post_init__(self):
        if self.start_day > self.end_day:
            raise ValueError("start_day is after end_day")

    def name(self, column: str, agg: str) -> str:
        """E.g. price_d7_d1_h8-19_mean, load_d1_to10_mean."""
        days = f"d{-self.start_day}" if self.start_day == self.end_day else f"d{-self.start_day}_d{-self.end_day}"
        part = ""
        if self.hours:
            run = self.hours == tuple(range(min(self.hours), max(self.hours) + 1))
            part = f"_h{min(self.hours)}-{max(self.hours)}" if run else "_h" + "-".join(map(str, self.hours))
        elif self.end_hour is not None:
            part = f"_to{self.end_hour}"
        return f"{column}_{days}{part}_{agg}"


@dataclass(frozen=True)
class PivotSpec:
    """A column turned into 24 columns ``prefix_0`` ... ``prefix_23``, from the day ``day_offset`` away."""

    column: str
    day_offset: int = 0
    prefix: str | None = None


@dataclass(frozen=True)
class AvailabilityRule:
    """Columns matching ``pattern`` are known up to day ``max_offset``; there, before ``cutoff_hour`` only."""

    pattern: str
    max_offset: int
    cutoff_hour: int | None = None
    tier: str = "default"


@dataclass(frozen=True)
class Step:
    """One step of a feature pipeline: an operator's name and its parameters."""

    op: str
    params: dict = field(default_factory=dict)

    def __hash__(self):
        return hash((self.op, repr(sorted(self.params.items()))))


def matches(pattern: str, name: str) -> bool:
    """A trailing ``*`` means prefix; other wildcards glob; anything else is the exact name."""
    if pattern.endswith("*") and not any(x in pattern[:-1] for x in "*?"):
        return name.startswith(pattern[:-1])
    return fnmatch.fnmatchcase(name, pattern) if any(x in pattern for x in "*?") else name == pattern


def resolve(columns: list[str], patterns: list[str], missing: str = "warn") -> list[str]:
    """Columns that match, in order and once. ``missing``: warn, ignore or keep what nothing matches."""
    out: list[str] = []
    for p in patterns:
        found = [x for x in columns if matches(p, x)]
        if not found and missing == "warn":
            warnings.warn(f"no column matches {p}", stacklevel=2)
        if not found and missing == "keep":
            found = [p]
        out += [x for x in found if x not in out]
    return out


def first_rule(name: str, rules: list[tuple[str, str]], default: str = "mean") -> str:
    """The aggregate of the first rule whose pattern matches."""
    return next((agg for p, agg in rules if matches(p, name)), default)


def check_steps(steps: list[Step]) -> None:
    """A pipeline has steps, and their labels are unique."""
    if not steps:
        raise ValueError("a pipeline needs at least one step")
    labels = [s.params.get("label", f"{i}:{s.op}") for i, s in enumerate(steps)]
    if len(set(labels)) < len(labels):
        raise ValueError("step labels repeat")


def dataset_path(base: str, name: str, resolution: str = "hour") -> str:
    if resolution not in ("hour", "quarterhour"):
        raise ValueError(f"unknown resolution {resolution}")
    return f"{base.rstrip('/')}/{name}_{resolution}"

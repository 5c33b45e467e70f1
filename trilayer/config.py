"""Rules and settings as plain data. Operators compile them into columns."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field


@dataclass(frozen=True)
class SourceSpec:
    """One landing source. The first of `paths` that exists is read."""

    paths: tuple[str, ...]
    required: bool = True
    label: str | None = None


@dataclass(frozen=True)
class Contract:
    """What a valid row looks like. Range bounds are inclusive, None is open."""

    types: Mapping[str, str]
    required: tuple[str, ...] = ()
    ranges: Mapping[str, tuple[float | None, float | None]] = field(default_factory=dict)
    domains: Mapping[str, frozenset[int]] = field(default_factory=dict)
    fail_fast: bool = True


@dataclass(frozen=True)
class SegmentRule:
    """`gate` AND (any of `any_of`).

    A gate without values is always true, an `any_of` entry without values is
    never true, so a rule with no values at all selects nothing.
    """

    gate: tuple[str, tuple[str, ...]]
    any_of: tuple[tuple[str, tuple[int, ...]], ...]

    @property
    def columns(self) -> list[str]:
        return [self.gate[0], *[name for name, _ in self.any_of]]

    @property
    def is_empty(self) -> bool:
        return not self.gate[1] and not any(values for _, values in self.any_of)


@dataclass(frozen=True)
class UpliftRates:
    """Probability of one more casualty as (when zero, when positive)."""

    segment_day: tuple[float, float]
    segment_other: tuple[float, float]
    rest: tuple[float, float]


@dataclass(frozen=True)
class ScenarioConfig:
    """Everything the scenario job needs besides the base table."""

    target_year: int
    rule: SegmentRule
    rates: UpliftRates
    seed: int
    growth: float
    order_by: tuple[str, ...]
    year: str = "yr"
    key: str = "incident_id"
    light: str = "light"
    total: str = "casualties"
    parts: tuple[str, ...] = ("fatal", "serious", "minor")
    grown_part: str = "minor"
    day_codes: tuple[int, ...] = ()

"""The incident table: its contract, dictionaries, segment and scenario settings."""

from __future__ import annotations

from trilayer import fixed_values as fixed
from trilayer.config import Contract, ScenarioConfig, SegmentRule, UpliftRates
from trilayer.operators.enrich import matching_codes

YEAR, KEY, MEASURE = "yr", "incident_id", "casualties"
WEATHER, LIGHT, ZONE = "weather", "light", "zone"
STRATEGIC = "strategic"

# Ids are 64-bit: a table of the size this is meant for has more rows than an int holds.
TYPES = {
    "incident_id": "bigint",
    "yr": "int",
    "mon": "int",
    "wday": "int",
    "hr": "int",
    "zone_detail": "int",
    "zone": "int",
    "road_type": "int",
    "road_owner": "int",
    "incident_type": "int",
    "surface": "int",
    "light": "int",
    "weather": "int",
    "visibility": "int",
    "casualties": "int",
    "fatal": "int",
    "serious": "int",
    "minor": "int",
    "km": "double",
}

CONTRACT = Contract(
    types=TYPES,
    required=("yr", "casualties", "weather", "light", "zone"),
    ranges={"mon": (1, 12), "wday": (1, 7), "hr": (0, 23), "casualties": (0, None)},
    domains={
        "weather": frozenset(int(code) for code in fixed.WEATHER_LABELS),
        "light": frozenset(int(code) for code in fixed.LIGHT_LABELS),
    },
)

# (source column, label column, dictionary); applied where the source column exists.
LABELS = (
    ("weather", "weather_desc", fixed.WEATHER_LABELS),
    ("light", "light_desc", fixed.LIGHT_LABELS),
    ("incident_type", "incident_type_desc", fixed.INCIDENT_TYPE_LABELS),
)

SEGMENT_RULE = SegmentRule(
    gate=(ZONE, fixed.SEGMENT_ZONE),
    any_of=((WEATHER, fixed.SEGMENT_WEATHER), (LIGHT, fixed.SEGMENT_LIGHT)),
)

KPI_DIMS = (YEAR, STRATEGIC, WEATHER, LIGHT)
DAY_CODES = matching_codes(fixed.LIGHT_LABELS, fixed.DAY_KEYWORDS)


def scenario_config(
    target_year: int = fixed.SCENARIO_YEAR,
    seed: int = fixed.SCENARIO_SEED,
    growth: float = fixed.SCENARIO_GROWTH,
    day_codes: tuple[int, ...] = DAY_CODES,
) -> ScenarioConfig:
    return ScenarioConfig(
        target_year=target_year,
        rule=SEGMENT_RULE,
        rates=UpliftRates(
            segment_day=fixed.UPLIFT_SEGMENT_DAY,
            segment_other=fixed.UPLIFT_SEGMENT_OTHER,
            rest=fixed.UPLIFT_REST,
        ),
        seed=seed,
        growth=growth,
        order_by=(KEY,),
        day_codes=day_codes,
    )

"""Build the scenario year from the base year's landing rows."""

from __future__ import annotations

import logging
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trilayer.config import ScenarioConfig
from trilayer.fixed_values import GROWTH_LIMIT
from trilayer.functions.numbers import safe_int
from trilayer.operators.enrich import day_column, segment_column, segment_present
from trilayer.operators.marts import max_key_column, mode_of
from trilayer.operators.ordering import number_rows
from trilayer.operators.quality import CORRUPT_RECORD
from trilayer.operators.scenario import DRAW_ID, bootstrap, reassign_ids, scenario_size, uplift
from trilayer.operators.typing import with_year
from trilayer.sinks.tables import write_landing, write_run_metadata
from trilayer.sources.delimited import INGEST_TS, SOURCE_FILE, read_delimited

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Scenario:
    rows: DataFrame
    metadata: Mapping[str, object]


def _day_codes(base: DataFrame, config: ScenarioConfig) -> tuple[int, ...]:
    """Configured codes, or else the most frequent light code of the base."""
    if config.day_codes or config.light not in base.columns:
        return config.day_codes
    typed = base.select(safe_int(F.col(config.light)).alias(config.light))
    top = mode_of(typed, config.light).first()
    log.warning("no day codes configured, using the most frequent light code: %s", top)
    return (top[config.light],) if top else ()


def build_scenario(base: DataFrame, config: ScenarioConfig) -> Scenario:
    """A resample of `base`, re-keyed, moved to the target year and uplifted.

    Two numbers reach the driver: the row count and the largest id.
    """
    # Ties of the key go by all other columns, so the file layout decides nothing.
    keys = [c for c in config.order_by if c in base.columns]
    numbered = number_rows(base, [*keys, *[c for c in base.columns if c not in keys]])
    has_key = config.key in base.columns
    counted = numbered.agg(
        F.count(F.lit(1)).alias("n"),
        scenario_size(F.count(F.lit(1)), F.lit(config.growth)).alias("n_out"),
        (max_key_column(config.key) if has_key else F.lit(0)).alias("top"),
    ).first()
    if not counted["n"]:
        raise ValueError("the base table is empty")

    codes = _day_codes(base, config)
    rule = segment_present(config.rule, base.columns)
    drawn = bootstrap(numbered, counted["n"], counted["n_out"], config.seed)
    moved = with_year(drawn, config.target_year, config.year)
    keyed = reassign_ids(moved, config.key, counted["top"] + 1)

    def typed(name: str) -> F.Column:
        return safe_int(F.col(name))

    light = typed(config.light) if config.light in base.columns else F.lit(None).cast("int")
    rows = uplift(
        keyed,
        config.rates,
        config.seed,
        is_segment=segment_column(rule, typed),
        is_day=day_column(light, codes),
        total=config.total,
        parts=config.parts,
        grown_part=config.grown_part,
    ).drop(DRAW_ID)

    targets = dict(config.rule.any_of)
    metadata = {
        "seed": config.seed,
        "growth": max(-GROWTH_LIMIT, min(GROWTH_LIMIT, config.growth)),
        "n_base": counted["n"],
        "n_generated": counted["n_out"],
        "day_codes": list(codes),
        "target_weather": sorted(targets.get("weather", ())),
        "target_light": sorted(targets.get("light", ())),
        "target_zone": sorted(config.rule.gate[1]),
    }
    return Scenario(rows, metadata)


def run_scenario(
    spark: SparkSession, base_path: str, scenario_path: str, config: ScenarioConfig
) -> Scenario:
    """Read the base landing folder and replace the scenario's, with its record beside it.

    Corrupt lines, which the base year's silver quarantines, are not drawn from; the
    record says how many were left out.
    """
    if base_path.rstrip("/") == scenario_path.rstrip("/"):
        raise ValueError("the scenario would overwrite its base")
    landed = read_delimited(spark, base_path)
    base = landed.filter(F.col(CORRUPT_RECORD).isNull()).drop(CORRUPT_RECORD, SOURCE_FILE, INGEST_TS)
    scenario = build_scenario(base, config)
    n_corrupt = landed.count() - scenario.metadata["n_base"]
    write_landing(scenario.rows, scenario_path)
    record = {**scenario.metadata, "n_corrupt": n_corrupt, "source": base_path, "output": scenario_path}
    write_run_metadata(spark, record, f"{scenario_path}/_run_metadata")
    return scenario

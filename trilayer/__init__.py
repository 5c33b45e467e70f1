"""Layered (bronze, silver, gold) table work on Spark."""

from trilayer.config import Contract, ScenarioConfig, SegmentRule, SourceSpec, UpliftRates

__all__ = ["Contract", "ScenarioConfig", "SegmentRule", "SourceSpec", "UpliftRates"]

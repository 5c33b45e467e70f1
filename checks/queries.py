"""One query per operator, over whole driver tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.fixture import (
    BASE_YEAR,
    COLUMNS,
    SCENARIO_YEAR,
    incidents,
    incidents_with_parts,
    table,
)
from trilayer import fixed_values as fixed
from trilayer.config import SourceSpec
from trilayer.functions import hash_uniform, parse_bool, safe_double, safe_int, safe_ratio, zero_fill
from trilayer.operators import distribution, enrich, marts, ordering, quality, scenario, typing
from trilayer.plans.gold import enriched
from trilayer.plans.incidents import (
    CONTRACT,
    DAY_CODES,
    KPI_DIMS,
    MEASURE,
    SEGMENT_RULE,
    STRATEGIC,
    TYPES,
    scenario_config,
)
from trilayer.plans.pipeline import Layout, land_base, run_all
from trilayer.plans.report import day_label, light_label, segment_text
from trilayer.plans.scenario import build_scenario, run_scenario
from trilayer.plans.silver import checked_rows
from trilayer.sinks import (
    replace_partition,
    scratch_dir,
    split_write,
    write_landing,
    write_table,
)
from trilayer.sources import read_delimited, read_partitioned, read_side, read_sources
from trilayer.sources.tables import QUARANTINE_SIDE, VALID_SIDE

Query = Callable[[SparkSession, str], DataFrame]
METRICS = (marts.ROWS, marts.TOTAL, marts.MEAN)
POINTS: Mapping[str, float] = {"p25": 0.25, "p50": 0.5, "p90": 0.9, "p99": 0.99}
ID = "incident_id"

CONFIG = scenario_config(target_year=SCENARIO_YEAR)


def typed(spark: SparkSession, sf: str) -> DataFrame:
    return typing.apply_types(incidents(spark, sf), TYPES)


def checked(spark: SparkSession, sf: str) -> DataFrame:
    return checked_rows(incidents(spark, sf))


def gold(spark: SparkSession, sf: str) -> DataFrame:
    return enriched(typing.valid_rows(checked(spark, sf)))


def two_years(df: DataFrame) -> DataFrame:
    return typing.restrict_to(df, "yr", [BASE_YEAR, SCENARIO_YEAR])


def base_rows(spark: SparkSession, sf: str) -> DataFrame:
    return incidents_with_parts(spark, sf).filter(F.col("yr") == str(BASE_YEAR))


def joined(name: str) -> F.Column:
    return F.array_join(name, ",").alias(name)


# --- sources and sinks --------------------------------------------------------


def csv_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "landing")
    padded = incidents(spark, sf).withColumnsRenamed({"km": " km ", "weather": "weather "})
    write_landing(padded, path)
    return read_delimited(spark, path).select(*COLUMNS)


def land_years(spark: SparkSession, sf: str) -> list[SourceSpec]:
    """The base year and all others in different layouts, and a third source that is not there."""
    root, raw = scratch_dir(spark, "sources"), incidents(spark, sf)
    write_landing(raw.filter(F.col("yr") == str(BASE_YEAR)), f"{root}/base")
    other = raw.filter(F.col("yr") != str(BASE_YEAR))
    write_landing(other.select(*reversed([c for c in COLUMNS if c != "km"])), f"{root}/scenario")
    return [
        SourceSpec((f"{root}/base/one-file.csv", f"{root}/base"), label="base"),
        SourceSpec((f"{root}/scenario",), required=False, label="scenario"),
        SourceSpec((f"{root}/absent",), required=False),
    ]


def sources_union(spark: SparkSession, sf: str) -> DataFrame:
    return read_sources(spark, land_years(spark, sf)).select(*COLUMNS)


def scenario_marker(spark: SparkSession, sf: str) -> DataFrame:
    landed = read_sources(spark, land_years(spark, sf))
    return landed.groupBy("scenario", "yr").agg(F.count(F.lit(1)).alias("n"))


RUN_TS = datetime(2026, 1, 14, 6, 30, tzinfo=timezone.utc)


def lineage(spark: SparkSession, sf: str) -> DataFrame:
    """The folder and kind of the file that each row came from, and the run's time."""
    landed = read_sources(spark, land_years(spark, sf), run_ts=RUN_TS)
    return landed.select(
        ID,
        F.regexp_extract("source_file", r"/([^/]+)/part-[^/]+\.csv$", 1).alias("folder"),
        F.unix_seconds("ingest_ts").alias("ingest_seconds"),
    )


def land_broken(spark: SparkSession, sf: str, only_base: bool = False) -> str:
    """Landing text of which some lines have lost their last fields and some have gained one."""
    raw, path = incidents_with_parts(spark, sf), scratch_dir(spark, "broken")
    if only_base:
        raw = raw.filter(F.col("yr") == str(BASE_YEAR))
    texts = [F.coalesce(c, F.lit("")) for c in raw.columns]
    key = F.col(ID).cast("long")
    line = (
        F.when(key % 101 == 0, F.concat_ws(";", *texts[:-2]))
        .when(key % 103 == 0, F.concat_ws(";", *texts, F.lit("more")))
        .otherwise(F.concat_ws(";", *texts))
    )
    # One column whose name is the whole header, written without quotes.
    lines = raw.select(line.alias(";".join(raw.columns)))
    lines.write.option("header", True).option("sep", "\x01").option("quote", "\x00").csv(path)
    return path


def dq_corrupt(spark: SparkSession, sf: str) -> DataFrame:
    """Every line of the broken landing: corrupt ones are flagged, and none of them is valid."""
    landed = checked_rows(read_delimited(spark, land_broken(spark, sf)))
    return landed.select(ID, joined(quality.CORRUPT), (F.col(quality.VALID) & (F.size(quality.CORRUPT) > 0)).alias("passed"))


def corrupt_sides(spark: SparkSession, sf: str) -> DataFrame:
    """Lines and corrupt lines by side of the stored split: together they are all lines."""
    path = scratch_dir(spark, "corrupt-split")
    split_write(checked_rows(read_delimited(spark, land_broken(spark, sf))), path)
    return read_partitioned(spark, path).groupBy("side").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.size(quality.CORRUPT) > 0).alias("n_corrupt")
    )


ROWS_PER_FILE = 100


def clustered_files(spark: SparkSession, sf: str) -> DataFrame:
    """Rows and files of each partition value after the rebalance: a value's rows come
    together, and fill files of a bounded number of rows."""
    path = scratch_dir(spark, "clustered")
    write_table(typed(spark, sf), path, "yr", cluster=True, max_records_per_file=ROWS_PER_FILE)
    rows = read_partitioned(spark, path).withColumn("file", F.col("_metadata.file_path"))
    per_file = rows.groupBy("yr", "file").agg(F.count(F.lit(1)).alias("n"))
    return per_file.groupBy("yr").agg(
        F.sum("n").alias("n"), F.max("n").alias("largest_file"), F.count_if(F.col("n") < ROWS_PER_FILE).alias("short_files")
    )


def exact_whole_numbers(spark: SparkSession, sf: str) -> DataFrame:
    """Texts around the limits of doubles and of 64 bits, and text that is no number."""
    big = (F.lit(9007199254740993).cast("decimal(20,0)") + F.col("o_orderkey")).cast("string")
    near = (F.lit(9223372036854775807).cast("decimal(20,0)") + 3 - F.col("o_orderkey") % 7).cast("string")
    orders = table(spark, sf, "orders")
    texts = {
        "marked": F.concat(F.lit(" "), big, F.lit(",0 ")),
        "plain": big,
        "near_limit": near,
        "half": F.concat((F.col("o_orderkey") % 1000).cast("string"), F.lit(".5")),
        "word": F.concat(F.lit("x"), F.col("o_orderkey").cast("string")),
    }
    return orders.select("o_orderkey", *[safe_int(text, "bigint").alias(name) for name, text in texts.items()])


def partitioned_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "table")
    write_table(typed(spark, sf), path, "yr", cluster=True)
    return read_partitioned(spark, path).select(*COLUMNS)


def replace_partition_twice(spark: SparkSession, sf: str) -> DataFrame:
    path, rows = scratch_dir(spark, "replace"), typed(spark, sf)
    write_table(rows, path, "yr")
    newer = rows.filter(F.col("yr") == SCENARIO_YEAR).withColumn(MEASURE, F.col(MEASURE) + 1)
    for _ in range(2):
        replace_partition(newer, path, "yr")
    return read_partitioned(spark, path).select(*COLUMNS)


def split_side(side: str) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        path = scratch_dir(spark, "split")
        split_write(checked(spark, sf), path)
        return read_side(spark, path, side).select(*COLUMNS, joined(quality.MISSING), joined(quality.DOMAIN), joined(quality.RANGE))

    return query


def zero_valid_policy(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "zero-valid")
    impossible = replace(CONTRACT, ranges={MEASURE: (1_000_000, None)})
    split_write(checked_rows(incidents(spark, sf), impossible), path)
    return read_partitioned(spark, path).groupBy("side").agg(
        F.count(F.lit(1)).alias("n"), F.sum(ID).alias("id_sum")
    )


def run_metadata(spark: SparkSession, sf: str) -> DataFrame:
    """The numbers in the record of a scenario drawn from a landing with corrupt lines."""
    path = scratch_dir(spark, "scenario")
    run_scenario(spark, land_broken(spark, sf, only_base=True), path, CONFIG)
    record = spark.read.json(f"{path}/_run_metadata")
    return record.select(
        "seed", "growth", "n_base", "n_generated", "n_corrupt",
        *[F.array_join(F.col(c).cast("array<string>"), ",").alias(c) for c in ("day_codes", "target_weather", "target_light", "target_zone")],
    )


# --- projections --------------------------------------------------------------


def parse_bool_words(spark: SparkSession, sf: str) -> DataFrame:
    words = "case o_orderkey % 9 when 0 then ' TRUE ' when 1 then 'Sí' when 2 then 'si' when 3 then '1' when 4 then 'T' when 5 then 'no' when 6 then '' when 7 then 'YES' end"
    text = table(spark, sf, "orders").selectExpr("o_orderkey", f"{words} as word")
    return text.withColumn("flag", parse_bool(F.col("word")))


def zero_fill_weather(spark: SparkSession, sf: str) -> DataFrame:
    return incidents(spark, sf).select(
        ID, safe_double(F.col("weather")).alias("parsed"), zero_fill(F.col("weather")).alias("filled")
    )


def fallback_labels(spark: SparkSession, sf: str) -> DataFrame:
    labelled = incidents(spark, sf)
    for code in ("light", "weather"):
        labelled = typing.fallback_label(labelled, code, f"{code}_desc", fixed.UNKNOWN_LABEL)
    return labelled.select(ID, "light_desc", "weather_desc")


# --- quality ------------------------------------------------------------------


def fault_column(name: str) -> Query:
    return lambda spark, sf: checked(spark, sf).select(ID, joined(name))


def dq_profile(spark: SparkSession, sf: str) -> DataFrame:
    faults = [joined(name) for name in quality.FAULT_ARRAYS]
    return checked(spark, sf).groupBy(*faults, quality.VALID).agg(F.count(F.lit(1)).alias("n"))


def pipeline_warnings(spark: SparkSession, sf: str) -> DataFrame:
    warned = typed(spark, sf)
    for text in ("late file", "rule failed", "late file"):
        warned = quality.add_warning(warned, text)
    return warned.select(ID, joined(quality.WARNINGS))


# --- enrichment ---------------------------------------------------------------


def lookup_map(spark: SparkSession, sf: str) -> DataFrame:
    return enriched(typed(spark, sf)).select(
        ID, "weather_desc", "light_desc", "incident_type_desc"
    )


def lookup_broadcast(spark: SparkSession, sf: str) -> DataFrame:
    customer, nation = table(spark, sf, "customer"), table(spark, sf, "nation")
    labelled = enrich.lookup_table(
        customer, nation, "c_nationkey", "nation_name", "n_nationkey", "n_name"
    )
    return labelled.select("c_custkey", "nation_name")


def lookup_large(spark: SparkSession, sf: str) -> DataFrame:
    """All parts; the codes of seventh lines are in no dictionary."""
    code = F.when(F.col("l_linenumber") == 7, -F.col("l_partkey")).otherwise(F.col("l_partkey"))
    lines = table(spark, sf, "lineitem").withColumn("code", code)
    labelled = enrich.lookup_table(
        lines, table(spark, sf, "part"), "code", "part_name", "p_partkey", "p_name", "other"
    )
    return labelled.groupBy("part_name").agg(F.count(F.lit(1)).alias("n"))


def lookup_salted(spark: SparkSession, sf: str) -> DataFrame:
    """A dictionary beyond the bound, and a code that holds a third of the lines."""
    code = F.when(F.col("l_orderkey") % 3 == 0, 1).otherwise(F.col("l_partkey"))
    lines = table(spark, sf, "lineitem").withColumn("code", code)
    labelled = enrich.lookup_table(
        lines, table(spark, sf, "part"), "code", "part_name", "p_partkey", "p_name", "other",
        spread_by=["l_orderkey", "l_linenumber"], max_rows=100,
    )
    return labelled.groupBy("part_name").agg(F.count(F.lit(1)).alias("n"))


def codes_matching(spark: SparkSession, sf: str) -> DataFrame:
    return enrich.codes_matching(table(spark, sf, "part"), "p_partkey", "p_name", ["ring", "bolt"])


def segment_flag(spark: SparkSession, sf: str) -> DataFrame:
    flagged = enrich.segment(typed(spark, sf), SEGMENT_RULE, STRATEGIC)
    labelled = enrich.segment_label(
        flagged, STRATEGIC, fixed.SEGMENT_LABEL, fixed.NOT_SEGMENT_LABEL
    )
    return labelled.select(ID, STRATEGIC, "segment_label")


def day_flag(spark: SparkSession, sf: str) -> DataFrame:
    flagged = enrich.day_flag(typed(spark, sf), DAY_CODES)
    return flagged.select(ID, "is_day", day_label().alias("day_label"))


def calendar_labels(spark: SparkSession, sf: str) -> DataFrame:
    named = enrich.lookup(typed(spark, sf), fixed.MONTH_LABELS, "mon", "month_name")
    named = enrich.lookup(named, fixed.WEEKDAY_LABELS, "wday", "weekday_name")
    return named.groupBy("month_name", "weekday_name").agg(F.count(F.lit(1)).alias("n"))


# --- marts --------------------------------------------------------------------


def kpi_mart(spark: SparkSession, sf: str) -> DataFrame:
    return marts.kpi_mart(gold(spark, sf), KPI_DIMS, MEASURE)


def by_year(spark: SparkSession, sf: str) -> DataFrame:
    return marts.by_year(gold(spark, sf))


def by_year_day(spark: SparkSession, sf: str) -> DataFrame:
    return marts.by_year_and(two_years(gold(spark, sf)), day_label(), "day_label")


def by_year_light(spark: SparkSession, sf: str) -> DataFrame:
    return marts.by_year_and(two_years(gold(spark, sf)), light_label(), "light_label")


def by_year_segment(spark: SparkSession, sf: str) -> DataFrame:
    return marts.by_year_and(two_years(gold(spark, sf)), segment_text(), "segment_label")


def safe_ratio_by_hour(spark: SparkSession, sf: str) -> DataFrame:
    """Bad per good rows by hour; the hours out of range have no good row."""
    sides = checked(spark, sf).groupBy("hr").agg(
        F.count_if(~F.col(quality.VALID)).alias("bad"), F.count_if(quality.VALID).alias("good")
    )
    return sides.withColumn("ratio", safe_ratio(F.col("bad"), F.col("good")))


def compare_years(spark: SparkSession, sf: str) -> DataFrame:
    return marts.compare(marts.by_year(gold(spark, sf)), BASE_YEAR, SCENARIO_YEAR, METRICS)


def compare_days(spark: SparkSession, sf: str) -> DataFrame:
    return marts.compare(
        by_year_day(spark, sf), BASE_YEAR, SCENARIO_YEAR, METRICS, by=["day_label"]
    )


def to_long(spark: SparkSession, sf: str) -> DataFrame:
    return marts.to_long(marts.by_year(gold(spark, sf)), ["yr"], METRICS)


def reduction_what_if(spark: SparkSession, sf: str) -> DataFrame:
    reduced = marts.reduction_what_if(
        gold(spark, sf), STRATEGIC, MEASURE, fixed.REDUCTION_FACTOR, "reduced"
    )
    return reduced.groupBy("yr", STRATEGIC).agg(
        F.sum(MEASURE).alias("casualties_total"), F.round(F.sum("reduced"), 4).alias("reduced_total")
    )


def percentiles_by_rank(spark: SparkSession, sf: str) -> DataFrame:
    found = distribution.percentiles_by_rank(typed(spark, sf), ["yr"], "km", POINTS)
    return found.select("yr", *[F.round(p, 4).alias(p) for p in POINTS])


# --- scenario -----------------------------------------------------------------


def hash_uniform_orders(spark: SparkSession, sf: str) -> DataFrame:
    draw = hash_uniform(fixed.SCENARIO_SEED, "uplift", F.col("o_orderkey"))
    return table(spark, sf, "orders").select("o_orderkey", draw.alias("u"))


def scenario_size(spark: SparkSession, sf: str) -> DataFrame:
    """Growth from -9% to +9% by year, so that both clamps act."""
    counted = typed(spark, sf).groupBy("yr").agg(F.count(F.lit(1)).alias("n"))
    growth = (F.col("yr") - 1998) * F.lit(0.03)
    return counted.withColumn("n_out", scenario.scenario_size(F.col("n"), growth))


def number_rows(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return ordering.number_rows(orders, ["o_totalprice", "o_orderkey"])


def running_total(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "cast(l_quantity as bigint) as quantity"
    )
    return ordering.running_total(lines, ["l_orderkey", "l_linenumber", "quantity"], "quantity")


def bootstrap(spark: SparkSession, sf: str) -> DataFrame:
    base = incidents(spark, sf).select(ID, MEASURE)
    numbered = ordering.number_rows(base, [ID])
    n = numbered.count()
    return scenario.bootstrap(numbered, n, 2 * n, fixed.SCENARIO_SEED)


def sum_components(spark: SparkSession, sf: str) -> DataFrame:
    """The total is overwritten with a wrong value first."""
    rows = incidents_with_parts(spark, sf).withColumn(MEASURE, F.lit(99))
    summed = scenario.sum_components(rows, ("fatal", "serious", "minor"), MEASURE)
    return summed.select(ID, MEASURE)


def uplifted(rows: DataFrame) -> DataFrame:
    rows = typing.apply_types(rows, TYPES)
    return scenario.uplift(
        rows,
        CONFIG.rates,
        CONFIG.seed,
        is_segment=enrich.segment_column(SEGMENT_RULE),
        is_day=enrich.day_column(F.col("light"), DAY_CODES),
        row_id=ID,
    )


def uplift(spark: SparkSession, sf: str) -> DataFrame:
    return uplifted(incidents_with_parts(spark, sf)).select(ID, MEASURE, "fatal", "serious", "minor")


def uplift_total_only(spark: SparkSession, sf: str) -> DataFrame:
    return uplifted(incidents(spark, sf)).select(ID, MEASURE)


def scenario_full(spark: SparkSession, sf: str) -> DataFrame:
    return build_scenario(base_rows(spark, sf), CONFIG).rows


def pipeline_layout(spark: SparkSession, sf: str) -> Layout:
    """The whole pipeline on disk: land, scenario, silver, gold, report."""
    layout = Layout(scratch_dir(spark, "pipeline"), BASE_YEAR, SCENARIO_YEAR)
    land_base(base_rows(spark, sf), layout)
    run_all(spark, layout)
    return layout


def pipeline_kpis(spark: SparkSession, sf: str) -> DataFrame:
    return read_partitioned(spark, pipeline_layout(spark, sf).kpis)


def pipeline_comparison(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{pipeline_layout(spark, sf).report}/comparison")


QUERIES: dict[str, Query] = {
    "typed_incidents": typed,
    "csv_round_trip": csv_round_trip,
    "sources_union": sources_union,
    "lineage": lineage,
    "partitioned_round_trip": partitioned_round_trip,
    "replace_partition": replace_partition_twice,
    "parse_bool": parse_bool_words,
    "zero_fill": zero_fill_weather,
    "restrict_years": lambda spark, sf: two_years(typed(spark, sf)),
    "fallback_label": fallback_labels,
    "dq_missing": fault_column(quality.MISSING),
    "dq_domain": fault_column(quality.DOMAIN),
    "dq_range": fault_column(quality.RANGE),
    "dq_corrupt": dq_corrupt,
    "corrupt_sides": corrupt_sides,
    "clustered_files": clustered_files,
    "exact_whole_numbers": exact_whole_numbers,
    "dq_profile": dq_profile,
    "dq_totals": lambda spark, sf: quality.dq_totals(checked(spark, sf)),
    "valid_rows": lambda spark, sf: typing.valid_rows(checked(spark, sf)).select(*COLUMNS),
    "invalid_rows": lambda spark, sf: typing.invalid_rows(checked(spark, sf)).select(*COLUMNS),
    "split_valid_rows": split_side(VALID_SIDE),
    "quarantine_rows": split_side(QUARANTINE_SIDE),
    "zero_valid_policy": zero_valid_policy,
    "pipeline_warnings": pipeline_warnings,
    "lookup_map": lookup_map,
    "lookup_broadcast": lookup_broadcast,
    "lookup_large": lookup_large,
    "lookup_salted": lookup_salted,
    "codes_matching": codes_matching,
    "segment_flag": segment_flag,
    "day_flag": day_flag,
    "kpi_mart": kpi_mart,
    "by_year": by_year,
    "by_year_day": by_year_day,
    "by_year_light": by_year_light,
    "by_year_segment": by_year_segment,
    "safe_ratio": safe_ratio_by_hour,
    "compare_years": compare_years,
    "compare_days": compare_days,
    "to_long": to_long,
    "mode_of": lambda spark, sf: marts.mode_of(typed(spark, sf), "weather"),
    "max_key": lambda spark, sf: marts.max_key(incidents(spark, sf), ID),
    "hash_uniform": hash_uniform_orders,
    "scenario_size": scenario_size,
    "number_rows": number_rows,
    "running_total": running_total,
    "bootstrap": bootstrap,
    "sum_components": sum_components,
    "uplift": uplift,
    "uplift_total_only": uplift_total_only,
    "scenario_full": scenario_full,
    "scenario_marker": scenario_marker,
    "percentiles": lambda spark, sf: distribution.percentiles(typed(spark, sf), ["yr"], MEASURE, POINTS),
    "percentiles_by_rank": percentiles_by_rank,
    "value_distribution": lambda spark, sf: distribution.value_distribution(typed(spark, sf), ["yr"], MEASURE),
    "zero_share": lambda spark, sf: distribution.zero_share(typed(spark, sf), ["yr"], MEASURE),
    "calendar_labels": calendar_labels,
    "reduction_what_if": reduction_what_if,
    "run_metadata": run_metadata,
    "pipeline_kpis": pipeline_kpis,
    "pipeline_comparison": pipeline_comparison,
}

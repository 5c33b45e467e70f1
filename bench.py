"""Time the headline queries and the on-disk jobs; prints one JSON line.

BENCH_SF_DIR, BENCH_CPUS and BENCH_RUNS choose the data, the cores and the number of
warm runs; each figure is the median of those, after one run that is not counted.
"""

from __future__ import annotations

import json
import logging
import os
import statistics
import sys
import time
from collections.abc import Callable

from pyspark.sql import SparkSession

from checks.fixture import BASE_YEAR, SCENARIO_YEAR, incidents_with_parts
from checks.queries import QUERIES
from trilayer.plans.gold import run_gold
from trilayer.plans.incidents import scenario_config
from trilayer.plans.pipeline import Layout, land_base
from trilayer.plans.report import run_report
from trilayer.plans.scenario import run_scenario
from trilayer.plans.silver import run_silver
from trilayer.sinks import scratch_dir

HEADLINE = (
    "typed_incidents", "dq_profile", "valid_rows", "kpi_mart", "by_year", "by_year_day",
    "by_year_light", "by_year_segment", "compare_years", "lookup_map", "lookup_large",
    "percentiles", "percentiles_by_rank", "number_rows", "bootstrap", "uplift",
    "scenario_full", "csv_round_trip", "split_valid_rows",
)


def jobs(spark: SparkSession, sf_dir: str) -> dict[str, Callable[[], object]]:
    """The jobs over one landed installation, in running order; all years are landed."""
    layout = Layout(scratch_dir(spark, "bench"), BASE_YEAR, SCENARIO_YEAR)
    land_base(incidents_with_parts(spark, sf_dir), layout)
    config = scenario_config(target_year=SCENARIO_YEAR)
    base, scenario = layout.landing(BASE_YEAR), layout.landing(SCENARIO_YEAR)
    return {
        "job_scenario": lambda: run_scenario(spark, base, scenario, config),
        "job_silver": lambda: run_silver(spark, layout.sources(), layout.silver),
        "job_gold": lambda: run_gold(spark, layout.silver, layout.gold, layout.kpis),
        "job_report": lambda: run_report(
            spark, layout.kpis, layout.report, BASE_YEAR, SCENARIO_YEAR
        ),
    }


def median_seconds(run: Callable[[], object], runs: int) -> float:
    run()
    times = []
    for _ in range(runs):
        start = time.perf_counter()
        run()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    logging.disable(logging.WARNING)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("trilayer-bench")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", False)
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.codegen.hugeMethodLimit", 8000)
        .config("spark.python.sql.dataFrameDebugging.enabled", False)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def query(name: str) -> Callable[[], object]:
        return lambda: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    timings: dict[str, float] = {}
    for name, run in {**{n: query(n) for n in HEADLINE}, **jobs(spark, sf_dir)}.items():
        timings[name] = median_seconds(run, runs)
        print(f"{name} {timings[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
                "runs": runs,
            }
        )
    )


if __name__ == "__main__":
    main()

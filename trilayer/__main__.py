"""`spark-submit trilayer/__main__.py --root DIR JOB` runs one job, or all of them."""

from __future__ import annotations

import argparse
import logging

from trilayer import fixed_values as fixed
from trilayer.plans.gold import run_gold
from trilayer.plans.incidents import scenario_config
from trilayer.plans.pipeline import Layout, land_base, run_all
from trilayer.plans.report import run_report
from trilayer.plans.scenario import run_scenario
from trilayer.plans.session import create_session
from trilayer.plans.silver import run_silver


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="trilayer")
    parser.add_argument("job", choices=["land", "scenario", "silver", "gold", "report", "all"])
    parser.add_argument("--root", required=True, help="folder of the installation")
    parser.add_argument("--input", help="Parquet table to land as the base year (job land)")
    parser.add_argument("--base-year", type=int, default=fixed.BASE_YEAR)
    parser.add_argument("--scenario-year", type=int, default=fixed.SCENARIO_YEAR)
    parser.add_argument("--shuffle-partitions", type=int)
    parser.add_argument("--cluster", action="store_true", help="few files per year, by a shuffle")
    args = parser.parse_args(argv)
    if args.job == "land" and not args.input:
        parser.error("job land needs --input")

    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s %(message)s")
    layout = Layout(args.root.rstrip("/"), args.base_year, args.scenario_year)
    spark = create_session(shuffle_partitions=args.shuffle_partitions)
    try:
        if args.job == "land":
            land_base(spark.read.parquet(args.input), layout)
        elif args.job == "scenario":
            run_scenario(
                spark,
                layout.landing(layout.base_year),
                layout.landing(layout.scenario_year),
                scenario_config(target_year=layout.scenario_year),
            )
        elif args.job == "silver":
            run_silver(spark, layout.sources(), layout.silver, cluster=args.cluster)
        elif args.job == "gold":
            run_gold(spark, layout.silver, layout.gold, layout.kpis, cluster=args.cluster)
        elif args.job == "report":
            run_report(spark, layout.kpis, layout.report, layout.base_year, layout.scenario_year)
        else:
            run_all(spark, layout, cluster=args.cluster)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()

"""Command line: one subcommand per layer, or all of them in order.

    python -m smeltery.jobs all --raw s3a://lake/raw --store s3a://lake/store \\
        --dataset yellow --periods 2023-01,2023-02 --zones s3a://lake/raw/zones.csv
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from .operators import QualityGateError
from .plans import layers
from .plans.trips import RAW_COLUMNS
from .session import build_session
from .sources import period_path
from .streaming import ingest_new_files, read_ingested


def _arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="smeltery")
    steps = parser.add_subparsers(dest="step", required=True)

    ingest = steps.add_parser("ingest", help="take files that landed since the last run")
    for name in ("raw", "target", "checkpoint"):
        ingest.add_argument(f"--{name}", required=True)
    ingest.add_argument("--dataset", default="yellow", help="the folder below --raw to watch")

    commands = {
        "bronze": "conform the listed periods and the zone file",
        "zones": "load the zone file alone, beside an incremental ingest",
        "silver": "filter, derive, de-duplicate",
        "gold": "fact and dimensions, checked before they become current",
        "marts": "daily revenue, pickup zones, payment breakdown",
        "views": "point catalog views at the current tables",
        "all": "every layer in order",
    }
    for step, text in commands.items():
        command = steps.add_parser(step, help=text)
        command.add_argument("--store", required=True)
        if step in ("bronze", "all"):
            command.add_argument("--raw", required=True)
            command.add_argument("--dataset", default="yellow")
            command.add_argument("--periods", required=True, help="comma-separated, e.g. 2023-01")
            command.add_argument("--inventory", help="folder that remembers what landed files store")
        if step in ("bronze", "zones", "all"):
            command.add_argument("--zones", required=True)
        if step == "silver":
            command.add_argument("--ingested", help="target of the ingest step, instead of bronze")
    return parser


def _periods(args: argparse.Namespace) -> list[str]:
    names = [p.strip() for p in args.periods.split(",") if p.strip()]
    if not names:
        raise ValueError("--periods names no period")
    return [period_path(args.raw, args.dataset, p) for p in names]


def _silver(spark: SparkSession, args: argparse.Namespace) -> None:
    bronze: DataFrame | None = (
        read_ingested(spark, args.ingested, RAW_COLUMNS) if args.ingested else None
    )
    # The bronze step has told what silver leaves out; an ingest has not.
    layers.build_silver(spark, args.store, bronze=bronze, reported=bronze is None)


def main(argv: Sequence[str] | None = None) -> int:
    """Exit code 1 when the quality gate refuses, with one line per failed check."""
    args = _arguments().parse_args(argv)
    spark = build_session(f"smeltery-{args.step}")
    try:
        if args.step == "ingest":
            ingest_new_files(
                spark, args.raw, args.target, args.checkpoint, RAW_COLUMNS, dataset=args.dataset
            )
        elif args.step == "bronze":
            layers.load_bronze(spark, args.store, _periods(args), args.zones, inventory=args.inventory)
        elif args.step == "zones":
            layers.load_zones(spark, args.store, args.zones)
        elif args.step == "silver":
            _silver(spark, args)
        elif args.step == "gold":
            layers.build_gold(spark, args.store)
        elif args.step == "marts":
            layers.build_marts(spark, args.store)
        elif args.step == "views":
            layers.expose_views(spark, args.store)
        else:
            layers.build_all(spark, args.store, _periods(args), args.zones, inventory=args.inventory)
    except QualityGateError as error:
        for failure in error.failures:
            print(f"FAIL {failure}")
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())

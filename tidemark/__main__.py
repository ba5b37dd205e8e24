"""Run rollups from the command line.

    python -m tidemark run minutes --events PATH --store PATH
    python -m tidemark run hourly_metrics 2024-01-15T14 --events PATH --store PATH
    python -m tidemark backfill 2024-01-01 2024-01-31 --events PATH --store PATH

``run`` takes a grain (all its tables) or one table. Without a period it takes the
last closed one. ``backfill`` takes a first and a last day, by default yesterday.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tidemark.plans.periods import backfill_days, run_period
from tidemark.plans.rollup import Options, Rollups
from tidemark.schema import GRAINS, TABLES
from tidemark.sources.events import read_events
from tidemark.sources.first_seen import FirstSeenLog
from tidemark.sources.store import RollupStore


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="tidemark", description=__doc__.split("\n")[0])
    commands = out.add_subparsers(dest="command", required=True)
    run = commands.add_parser("run", help="one period of a grain or a table")
    run.add_argument("what", choices=[*GRAINS, *TABLES])
    run.add_argument("period", nargs="?")
    fill = commands.add_parser("backfill", help="all tables over a range of days")
    fill.add_argument("start", nargs="?")
    fill.add_argument("end", nargs="?")
    for command in (run, fill):
        command.add_argument("--events", required=True, help="Parquet events")
        command.add_argument("--store", required=True, help="folder of the rollup tables")
        command.add_argument("--seen", help="folder of the first-seen log, if one is kept")
        command.add_argument("--source-zone", default=Options.source_zone)
        command.add_argument("--base-zone", default=Options.base_zone)
        command.add_argument("--report-zone", default=Options.report_zone)
    return out


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"rollups {args.command}").getOrCreate()
    options = Options(args.source_zone, args.base_zone, args.report_zone)
    log = FirstSeenLog(spark, args.seen) if args.seen else None
    store = RollupStore(spark, args.store)
    jobs = Rollups(spark, read_events(spark, args.events), store, options, log)
    if args.command == "backfill":
        jobs.backfill(backfill_days(args.start, args.end))
    elif args.what in TABLES:
        jobs.run(args.what, run_period(TABLES[args.what].grain, args.period))
    elif args.period is None:
        jobs.run_latest(args.what)
    else:
        jobs.run_grain(args.what, run_period(args.what, args.period))


if __name__ == "__main__":
    main()

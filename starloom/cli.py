"""Run a job on insurance files: `spark-submit run.py {batch,mart,medallion} --insurance insurance.csv ...`."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .constants import CALENDAR_END, CALENDAR_START, INSURANCE_SCHEMA
from .operators.checks import row_counts
from .operators.staging import shared_dir
from .plans.calendar import calendar_extended, read_calendar
from .plans.runs import Layout, continue_medallion, rebuild_medallion, run_batch, run_mart, run_medallion
from .session import tune
from .sinks.tables import ensure_database
from .sources.files import read_csv, read_json_nested


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="starloom", description=__doc__)
    parser.add_argument("job", choices=["batch", "mart", "medallion"])
    parser.add_argument("--insurance", help="CSV file or folder of insurance rows")
    parser.add_argument("--resume", action="store_true", help="go on from the tables of an earlier run (medallion)")
    parser.add_argument("--members", default="members-2", help="name of the batch of new insurance rows (medallion --resume --insurance)")
    parser.add_argument("--rebuild", action="store_true", help="build silver and gold of an earlier run anew (medallion)")
    parser.add_argument("--scale", type=int, help="digits after the point of amounts that are decimals: their sums are then exact")
    parser.add_argument("--order", help="unique column that fixes row ids; default: the order rows are read in")
    parser.add_argument("--providers", help="JSON document with a list `regions` (mart)")
    parser.add_argument("--shuffle-partitions", type=int, help="partitions that shuffles start with; merged at run time")
    parser.add_argument("--database", default="default")
    parser.add_argument("--prefix", default="", help="start of every table name")
    parser.add_argument("--base", help="folder for event files and stream checkpoints (medallion); default: the shared folder")
    parser.add_argument("--increment", default="increment-1", help="load id of the batch increment; empty for none (medallion)")
    parser.add_argument("--calendar", default=f"{CALENDAR_START}:{CALENDAR_END}", help="first day:day after the last (medallion)")
    args = parser.parse_args(argv)
    if (args.resume or args.rebuild) and args.job != "medallion":
        parser.error("only a medallion run can be resumed or rebuilt")
    if not args.insurance and not (args.resume or args.rebuild):
        parser.error("--insurance is missing")
    return args


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parse(argv)
    spark = tune(spark or SparkSession.builder.appName(f"starloom-{args.job}").getOrCreate(), args.shuffle_partitions)
    ensure_database(spark, args.database)
    layout = Layout(args.prefix, scale=args.scale)
    base = args.base or f"{shared_dir(spark)}/starloom/{args.database}"
    # a file may have a further column to order by; then its header decides
    insurance = read_csv(spark, args.insurance, None if args.order else INSURANCE_SCHEMA) if args.insurance else None
    if args.resume or args.rebuild:
        if args.resume:
            names = continue_medallion(spark, layout, base, args.increment or None, insurance, args.order, args.members)
        if args.rebuild:
            names = rebuild_medallion(spark, layout)
        row_counts({n: spark.table(t) for n, t in names.items()}).show(len(names), truncate=False)
        return
    if args.job == "batch":
        tables = run_batch(spark, insurance, args.order, layout, read_calendar(spark))
        tables.pop("violations").show(truncate=False)
    elif args.job == "mart":
        providers = read_json_nested(spark, args.providers, "regions")
        tables = run_mart(insurance, providers, args.order, layout)
        tables.pop("row_counts")
        tables.pop("violations").show(truncate=False)
    else:
        start, end = args.calendar.split(":")
        calendar = calendar_extended(spark, start, end)
        names = run_medallion(spark, insurance, args.order, calendar, layout, base, args.increment or None)
        tables = {n: spark.table(t) for n, t in names.items()}
    row_counts(tables).show(len(tables), truncate=False)

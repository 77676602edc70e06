"""Run one stage, or all of them, as a Spark application.

    spark-submit --py-files vanewatch.zip vanewatch/__main__.py ingest RUN --store ROOT --source PATH
    python -m vanewatch transform RUN RUN RUN --store ROOT --states
    python -m vanewatch publish RUN --jdbc-url URL --user NAME --start T --end T

The database password is read from the environment variable JDBC_PASSWORD.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import SparkSession

from vanewatch.plans.stages import MODES, run_pipeline, run_stage, run_stage_of_runs
from vanewatch.schemas import RequiredColumns
from vanewatch.sources.jdbc_store import JdbcStore
from vanewatch.sources.parquet_store import ParquetStore


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="vanewatch")
    parser.add_argument("mode", choices=[*MODES, "all"])
    parser.add_argument("run", nargs="+", help="run id; transform and publish take several")
    target = parser.add_mutually_exclusive_group(required=True)
    target.add_argument("--store", help="root folder of the parquet tables")
    target.add_argument("--jdbc-url")
    parser.add_argument("--user")
    parser.add_argument("--driver", default="org.postgresql.Driver")
    parser.add_argument("--source", help="CSV file or folder, for ingest")
    parser.add_argument("--start", help="first time of the period, for publish")
    parser.add_argument("--end", help="last time of the period, for publish")
    parser.add_argument("--k", type=float, default=2.0, help="standard deviations that make an anomaly")
    parser.add_argument("--without-time", action="store_true", help="store anomalies without their time")
    parser.add_argument("--append", action="store_true", help="add to a run in parquet tables instead of replacing it")
    parser.add_argument("--daily", action="store_true", help="lay silver out by day in parquet tables")
    parser.add_argument("--ordered", action="store_true", help="sort silver files by time in parquet tables")
    parser.add_argument("--states", action="store_true", help="store statistics of each day with silver")
    parser.add_argument(
        "--required", choices=RequiredColumns.HOW, default="ignore", help="what a NULL in a required column does"
    )
    parser.add_argument("--at-once", type=int, default=4, help="runs that are published at the same time")
    parser.add_argument("--connections", type=int, default=8, help="JDBC connections at the same time")
    parser.add_argument("--fetch-rows", type=int, default=10_000, help="rows of one JDBC fetch")
    parser.add_argument(
        "--split", action="append", default=[], metavar="TABLE:CONDITION",
        help="one of the disjoint conditions that divide a JDBC scan of a table; repeat it for each",
    )
    args = parser.parse_args(argv)
    if args.mode in ("ingest", "all") and not args.source:
        parser.error("--source is required")
    if args.mode in ("publish", "all") and not (args.start and args.end):
        parser.error("--start and --end are required")
    if args.mode in ("ingest", "all") and len(args.run) > 1:
        parser.error(f"{args.mode} takes one run")
    if not all(":" in split for split in args.split):
        parser.error("--split needs TABLE:CONDITION")
    return args


def splits_of(parts: list[str]) -> dict[str, list[str]]:
    """Conditions by table."""
    found: dict[str, list[str]] = {}
    for part in parts:
        table, condition = part.split(":", 1)
        found.setdefault(table, []).append(condition)
    return found


def main(argv: list[str] | None = None) -> None:
    args = parse(argv)
    spark = SparkSession.builder.appName(f"vanewatch {args.mode}").getOrCreate()
    if args.store:
        store = ParquetStore(
            spark,
            args.store,
            mode="append" if args.append else "replace",
            daily=args.daily,
            ordered=args.ordered,
            required=args.required,
        )
    else:
        options = {"url": args.jdbc_url, "driver": args.driver}
        if args.user:
            options |= {"user": args.user, "password": os.environ.get("JDBC_PASSWORD", "")}
        store = JdbcStore(
            spark,
            options,
            connections=args.connections,
            fetch_rows=args.fetch_rows,
            splits=splits_of(args.split),
        )
    how = {"k": args.k, "include_time": not args.without_time, "states": args.states}
    if args.mode == "all":
        run_pipeline(spark, store, args.source, args.run[0], args.start, args.end, **how)
    elif args.mode == "ingest":
        run_stage(spark, "ingest", args.run[0], store, path=args.source)
    else:
        run_stage_of_runs(
            spark, args.mode, args.run, store, at_once=args.at_once, start=args.start, end=args.end, **how
        )


if __name__ == "__main__":
    main()

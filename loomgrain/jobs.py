"""Command line for spark-submit: load, changes, batch, lake, compact, generate."""

from __future__ import annotations

import argparse
import os
from datetime import date

from pyspark.sql import SparkSession

from loomgrain.contracts import RETAIL
from loomgrain.plans.changes import apply_changes
from loomgrain.plans.datasets import SIZES, write_banking, write_changes, write_course, write_io_lab, write_scenario
from loomgrain.plans.lake import BANKING_TABLES, build_bronze_silver, compact_folder, load_batches
from loomgrain.plans.loads import database_target, folder_target, load
from loomgrain.session import build_session, object_store_settings, release
from loomgrain.sources.jdbc import Database
from loomgrain.sources.readers import FORMATS
from loomgrain.sources.routing import pick_tables, route, select_scenarios


def positive(text: str) -> int:
    value = int(text)
    if value <= 0:
        raise argparse.ArgumentTypeError("must be greater than zero")
    return value


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(description=__doc__)
    root.add_argument("--s3-endpoint", help="object store; keys come from S3_ACCESS_KEY and S3_SECRET_KEY")
    jobs = root.add_subparsers(dest="job", required=True)

    job = jobs.add_parser("load", help="validated load of one table")
    job.add_argument("--source", required=True)
    job.add_argument("--format", choices=FORMATS, required=True)
    job.add_argument("--table", choices=sorted(RETAIL), required=True)
    job.add_argument("--scenario", default="manual")
    job.add_argument("--mode", choices=["append", "overwrite"], default="append")
    job.add_argument("--target", help="folder for Parquet output")
    job.add_argument("--jdbc-url", help="database instead of a folder; user and password from JDBC_USER and JDBC_PASSWORD")
    job.add_argument("--jdbc-schema", default="training")
    job.add_argument("--batch-rows", type=positive, default=10_000)
    job.add_argument("--rejects", required=True)
    job.add_argument("--audit", required=True)
    job.add_argument("--run-id", help="name of the run; a run that died is repeated under its name")

    job = jobs.add_parser("changes", help="apply change files to a versioned dataset")
    job.add_argument("--source", required=True)
    job.add_argument("--format", choices=FORMATS, required=True)
    job.add_argument("--dataset", required=True)
    job.add_argument("--rejects", required=True)

    job = jobs.add_parser("batch", help="bulk, incremental, reprocess or compact load of dated folders")
    job.add_argument("--source", required=True)
    job.add_argument("--target", required=True)
    job.add_argument("--load-type", choices=["bulk", "incremental", "reprocess", "compact"], default="incremental")
    job.add_argument("--batch-date")
    job.add_argument("--source-format", choices=FORMATS, default="csv")
    job.add_argument("--target-format", choices=FORMATS, default="parquet")
    job.add_argument("--tables", nargs="*")
    job.add_argument("--mode", choices=["append", "overwrite"])

    job = jobs.add_parser("lake", help="bronze and silver tables from scenario folders")
    job.add_argument("--source", required=True)
    job.add_argument("--format", choices=FORMATS, default="csv")
    job.add_argument("--scenarios", default="all")
    job.add_argument("--bronze", default="bronze_layer")
    job.add_argument("--silver", default="silver_layer")
    job.add_argument("--using", default="parquet")

    job = jobs.add_parser("compact", help="rewrite a folder as fewer files")
    job.add_argument("--source", required=True)
    job.add_argument("--target", required=True)
    job.add_argument("--format", choices=FORMATS, required=True)
    job.add_argument("--files", type=positive, help="default: from the folder's bytes")

    job = jobs.add_parser("generate", help="write a generated dataset")
    job.add_argument("kind", choices=["course", "scenarios", "changes", "io", "banking"])
    job.add_argument("--target", required=True)
    job.add_argument("--format", choices=FORMATS, default="csv")
    job.add_argument("--scenarios", default="all")
    job.add_argument("--size", choices=sorted(SIZES), default="small")
    job.add_argument("--employees", type=positive, default=1_000_000)
    job.add_argument("--rows-per-file", type=positive, default=10_000)
    job.add_argument("--updates", type=int, default=100)
    job.add_argument("--deletes", type=int, default=25)
    job.add_argument("--customers", type=positive, default=1000)
    job.add_argument("--days", type=positive, default=7)
    job.add_argument("--first-day", type=date.fromisoformat, default=date(2026, 1, 1))
    job.add_argument("--allow-more-files", action="store_true")
    return root


def run(spark: SparkSession, args: argparse.Namespace) -> object:
    if args.job == "load":
        if bool(args.target) == bool(args.jdbc_url):
            raise ValueError("give either --target or --jdbc-url")
        if args.target:
            target = folder_target(args.target, mode=args.mode, run_id=args.run_id)
        else:
            database = Database(args.jdbc_url, os.environ.get("JDBC_USER"), os.environ.get("JDBC_PASSWORD"))
            target = database_target(database, args.jdbc_schema, args.mode, args.batch_rows)
        contract = RETAIL[args.table]
        done = load(spark, args.format, args.source, contract, target, args.scenario, args.rejects, args.audit, args.run_id)
        return {"table": args.table, "accepted_rows": done.accepted_rows, "rejected_rows": done.rejected_rows}
    if args.job == "changes":
        return apply_changes(spark, args.format, args.source, args.dataset, args.rejects)
    if args.job == "batch":
        return load_batches(
            spark,
            args.source,
            args.target,
            pick_tables(BANKING_TABLES, args.tables),
            args.load_type,
            args.batch_date,
            args.source_format,
            args.target_format,
            mode=args.mode,
        )
    if args.job == "lake":
        sources = route(args.source, args.scenarios, args.format)
        return sorted(build_bronze_silver(spark, sources, args.format, args.bronze, args.silver, args.using))
    if args.job == "compact":
        return compact_folder(spark, args.format, args.source, args.target, args.files)
    if args.kind == "course":
        return write_course(
            spark, args.target, args.format, employees=args.employees, rows_per_file=args.rows_per_file, allow_more=args.allow_more_files
        )
    if args.kind == "scenarios":
        files, rows = SIZES[args.size]
        return [
            write_scenario(spark, args.target, number, args.format, files, rows, allow_more=args.allow_more_files)
            for number in select_scenarios(args.scenarios)
        ]
    if args.kind == "changes":
        return write_changes(spark, args.target, args.updates, args.deletes, args.rows_per_file, allow_more=args.allow_more_files)
    if args.kind == "io":
        return write_io_lab(spark, args.target, allow_more=args.allow_more_files)
    return write_banking(spark, args.target, args.format, args.customers, args.first_day, args.days)


def main() -> None:
    args = parser().parse_args()
    extra = {}
    if args.s3_endpoint:
        extra = object_store_settings(
            args.s3_endpoint, os.environ.get("S3_ACCESS_KEY", ""), os.environ.get("S3_SECRET_KEY", "")
        )
    spark = build_session(f"loomgrain-{args.job}", extra=extra)
    try:
        print(run(spark, args))
    finally:
        release(spark)
        spark.stop()


if __name__ == "__main__":
    main()

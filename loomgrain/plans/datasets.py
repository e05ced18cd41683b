"""Generated datasets written in the layouts under study, with their manifests."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, timedelta
from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgrain.contracts import CHANGES, RETAIL, SCENARIOS
from loomgrain.sinks.writers import write_layout, write_table
from loomgrain.sources import banking, generators as gen
from loomgrain.sources.files import MANIFEST_SCHEMA

# Largest number of files written without an explicit wish for more.
COURSE_FILES = 250_000
IO_FILES = 5_000
SCENARIO_FILES = 250_000

# Files and rows per file of the scenario sizes.
SIZES = {"small": (20, 10), "large": (2, 100_000), "ultra": (10_000, 1)}


def write_manifest(spark: SparkSession, root: str, scenario: str, entries: list[tuple[str, str, int, int]]) -> None:
    """Expected files and rows, kept beside the table folders so that no table scan meets it."""
    frame = spark.createDataFrame([(scenario, entries)], MANIFEST_SCHEMA)
    frame.coalesce(1).write.mode("overwrite").json(f"{root}/_manifests/{scenario}")


def write_scenario(
    spark: SparkSession,
    root: str,
    number: str,
    fmt: str,
    files: int,
    rows_per_file: int,
    max_files: int = SCENARIO_FILES,
    allow_more: bool = False,
) -> list[tuple[str, str, int, int]]:
    """The tables of one scenario, ``files`` files of ``rows_per_file`` rows each."""
    folder, dataset, tables = SCENARIOS[number]
    entries = []
    for table in tables:
        rows = gen.RETAIL_GENERATORS[table](gen.row_numbers(spark, files * rows_per_file))
        keyed = rows.withColumn("_n", _number(table, RETAIL[table].key[0]))
        path = f"{root}/{folder}/{dataset}/{fmt}/{table}"
        written = write_layout(keyed, fmt, path, rows_per_file, "_n", max_files, allow_more, drop_number=True)
        entries.append((table, fmt, written, files * rows_per_file))
    write_manifest(spark, root, number, entries)
    return entries


def _number(table: str, key: str):
    """The row number back from the key."""
    if table == "dept":
        return (F.col(key) / 10).cast("long")
    return F.col(key) - 7000 if table == "emp" else F.col(key)


def write_changes(
    spark: SparkSession,
    root: str,
    updates: int,
    deletes: int,
    rows_per_file: int,
    fmts: Iterable[str] = ("csv", "json", "parquet"),
    allow_more: bool = False,
) -> list[tuple[str, str, int, int]]:
    """``updates`` U records and ``deletes`` D records, in each format."""
    if updates < 0 or deletes < 0:
        raise ValueError("updates and deletes cannot be negative")
    rows = updates + deletes
    entries = []
    for fmt in fmts if rows else ():
        frame = gen.change_records(gen.row_numbers(spark, rows), updates).withColumn("_n", F.col("transaction_id"))
        path = f"{root}/11_cdc_sales_transaction/{fmt}/{CHANGES.name}"
        files = write_layout(frame, fmt, path, rows_per_file, "_n", SCENARIO_FILES, allow_more, drop_number=True)
        entries.append((CHANGES.name, fmt, files, rows))
    if entries:
        write_manifest(spark, root, "cdc", entries)
    return entries


def write_course(
    spark: SparkSession,
    root: str,
    fmt: str,
    departments: int = 100,
    employees: int = 1_000_000,
    projects: int = 100,
    grades: int = 1_000_000,
    rows_per_file: int = 10_000,
    with_assignments: bool = True,
    allow_more: bool = False,
) -> dict[str, int]:
    """The five course tables; returns the files of each."""
    for name, value in {"departments": departments, "employees": employees, "projects": projects, "grades": grades}.items():
        if value <= 0:
            raise ValueError(f"{name} must be greater than zero")
    sizes = {"dept": departments, "emp": employees, "projects": projects, "salgrade": grades}
    if with_assignments:
        sizes["emp_projects"] = employees * projects
    total = sum(ceil(rows / rows_per_file) for rows in sizes.values())
    if total > COURSE_FILES and not allow_more:
        raise ValueError(f"{total} files planned, {COURSE_FILES} allowed")
    make = {
        "dept": gen.course_dept,
        "emp": lambda rows: gen.course_emp(rows, departments),
        "projects": gen.course_projects,
        "salgrade": gen.course_salgrade,
        "emp_projects": lambda rows: gen.course_emp_projects(rows, projects),
    }
    number = {
        "dept": lambda: (F.col("deptno") / 10).cast("long"),
        "emp": lambda: F.col("empno") - 7000,
        "projects": lambda: F.col("projectno"),
        "salgrade": lambda: F.col("grade"),
        "emp_projects": lambda: F.col("emp_projectno") - 1000,
    }
    return {
        table: write_layout(
            make[table](gen.row_numbers(spark, rows)).withColumn("_n", number[table]()),
            fmt,
            f"{root}/{table}",
            rows_per_file,
            "_n",
            COURSE_FILES,
            allow_more,
            drop_number=True,
        )
        for table, rows in sizes.items()
    }


def write_emp_updates(spark: SparkSession, root: str, fmt: str, sizes: dict[str, int]) -> None:
    """Update sets by label, e.g. ``{"small": 100, "large": 100_000}``."""
    for label, rows in sizes.items():
        write_table(gen.emp_updates(gen.row_numbers(spark, rows), label), fmt, f"{root}/{label}/{fmt}")


def write_io_lab(
    spark: SparkSession,
    root: str,
    csv_rows: int = 100_000,
    tiny_tables: tuple[str, ...] = ("customers", "orders", "order_items"),
    tiny_files: int = 100,
    lookup_files: int = 25,
    parquet_files: int = 2,
    parquet_rows: int = 100_000,
    allow_more: bool = False,
) -> None:
    """A large CSV, one-row CSV files, a lookup table of them, and Parquet parts."""
    total = len(tiny_tables) * tiny_files + lookup_files
    if total > IO_FILES and not allow_more:
        raise ValueError(f"{total} tiny files planned, {IO_FILES} allowed")

    def rows(n: int) -> DataFrame:
        return gen.io_rows(gen.row_numbers(spark, n))

    write_table(rows(csv_rows), "csv", f"{root}/large_csv")
    for table, files in [*[(name, tiny_files) for name in tiny_tables], ("products", lookup_files)]:
        write_layout(rows(files), "csv", f"{root}/one_row_csv/{table}", 1, "record_id", files)
    write_layout(
        rows(parquet_files * parquet_rows), "parquet", f"{root}/many_parquets", parquet_rows, "record_id", parquet_files
    )


def write_banking(
    spark: SparkSession, root: str, fmt: str, customers: int = 1000, first_day: date = date(2026, 1, 1), days: int = 7, files_per_date: int = 4
) -> None:
    """The nine banking tables in ``<table>/batch_date=`` folders of small files."""
    people = gen.row_numbers(spark, customers).withColumnRenamed("n", "customer_id")
    calendar = [first_day + timedelta(days=i) for i in range(days)]
    for table, frame in banking.banking_tables(people, calendar).items():
        # the feed is meant to arrive as several files per date
        part = F.pmod(F.xxhash64(*frame.columns), F.lit(files_per_date))
        spread = frame.withColumn("_part", part).repartition(days * files_per_date, "batch_date", "_part").drop("_part")
        write_table(spread, fmt, f"{root}/{table}", partition_by=["batch_date"])

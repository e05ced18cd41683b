"""Bronze and silver tables, and dated batch loads."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomgrain.functions.values import normal_email
from loomgrain.operators.skew import broadcast_if_small
from loomgrain.plans.publish import (
    FILE,
    current_version,
    list_written,
    make_current,
    names_of,
    new_folder,
    read_files,
    version_files,
    version_schema,
)
from loomgrain.session import delete_path, materialise, path_exists, session_settings
from loomgrain.sinks.tables import create_namespace, replace_table
from loomgrain.sinks.writers import TARGET_FILE_BYTES, write_table
from loomgrain.sources.files import list_files
from loomgrain.sources.gate import alike, refuse_unlike_files
from loomgrain.sources.readers import read_batch, read_table

ROWS_PER_FILE = 5_000_000

# Tables of the banking feed.
BANKING_TABLES = (
    "customers",
    "account_plans",
    "accounts",
    "loan_types",
    "loans",
    "salary_deposits",
    "loan_payments",
    "payment_reminders",
    "account_transactions",
)


def with_lineage(df: DataFrame, scenario: str, table: str, fmt: str) -> DataFrame:
    return df.withColumns(
        {
            "source_scenario": F.lit(scenario),
            "source_table": F.lit(table),
            "source_format": F.lit(fmt),
            "bronze_load_ts": F.current_timestamp(),
        }
    )


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """Rows of all frames; a column a frame lacks is NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def clean(df: DataFrame) -> DataFrame:
    """Trim every text column, lower-case the email, drop repeated rows."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType):
            column = normal_email(column) if field.name == "email" else F.trim(column)
        columns.append(column.alias(field.name))
    return df.select(*columns).dropDuplicates()


def to_silver(df: DataFrame, key: list[str] | None = None) -> DataFrame:
    """Cleaned rows with their load time.

    Lineage columns count as part of a row, so the same record arriving from
    two scenarios stays twice. With ``key`` one row per key is kept instead:
    that of the first scenario, then the smallest remaining values.
    """
    cleaned = clean(df)
    if key:
        rest = [c for c in cleaned.columns if c not in key]
        ordered = [c for c in ("source_scenario",) if c in rest] + [c for c in rest if c != "source_scenario"]
        cleaned = (
            cleaned.groupBy(*key)
            .agg(F.min(F.struct(*ordered)).alias("_row"))
            .select(*key, *[F.col(f"_row.`{c}`").alias(c) for c in rest])
            .select(*cleaned.columns)
        )
    return cleaned.withColumn("silver_load_ts", F.current_timestamp())


def build_bronze_silver(
    spark: SparkSession,
    sources: list[tuple[str, str, str]],
    fmt: str,
    bronze: str,
    silver: str,
    using: str = "parquet",
    locations: dict[str, str] | None = None,
    schemas: dict[str, T.StructType] | None = None,
    unlike: str = "refuse",
) -> dict[str, tuple[DataFrame, DataFrame]]:
    """Bronze and silver table per source table of (scenario, table, path).

    A column whose type differs between the scenarios of a table stops the
    build before anything is written; with ``unlike`` "text" it becomes text.
    """
    for namespace in (bronze, silver):
        create_namespace(spark, namespace, (locations or {}).get(namespace))
    frames: dict[str, dict[str, DataFrame]] = {}
    for scenario, table, path in sources:
        refuse_unlike_files(spark, fmt, path)
        df = read_table(spark, fmt, path, schema=(schemas or {}).get(table))
        frames.setdefault(table, {})[f"{scenario}: {path}"] = with_lineage(df, scenario, table, fmt)
    checked = {table: alike(parts, unlike) for table, parts in frames.items()}
    built = {}
    for table, parts in checked.items():
        loaded = replace_table(spark, f"{bronze}.{table}", union_by_name(parts), using)
        built[table] = (loaded, replace_table(spark, f"{silver}.{table}", to_silver(loaded), using))
    return built


def load_batches(
    spark: SparkSession,
    source_root: str,
    target_root: str,
    tables: list[str],
    load_type: str,
    batch_date: str | None = None,
    source_format: str = "csv",
    target_format: str = "parquet",
    schemas: dict[str, T.StructType] | None = None,
    mode: str | None = None,
    rows_per_file: int = ROWS_PER_FILE,
    repeated: str = "refuse",
) -> list[str]:
    """bulk, incremental, reprocess or compact load of dated source folders.

    bulk loads every date, the others one. reprocess replaces just its date and
    clears it if the source has no rows for it any more; compact writes that
    date's rows as few files to ``<target_root>_compacted``. An incremental
    load of a date that is there already is refused, or with ``repeated``
    "replace" takes its place, so that a repeated load never doubles a date.
    Returns the folders written.
    """
    if repeated not in {"refuse", "replace"}:
        raise ValueError(f"unknown way to handle a repeated date: {repeated}")
    if load_type not in {"bulk", "incremental", "reprocess", "compact"}:
        raise ValueError(f"unknown load type: {load_type}")
    if load_type != "bulk" and not batch_date:
        raise ValueError(f"{load_type} loads need a batch_date")
    written = []
    for table in tables:
        refuse_unlike_files(spark, source_format, f"{source_root}/{table}")
        rows = read_batch(
            packing_session(spark) if load_type == "compact" else spark,
            source_format,
            f"{source_root}/{table}",
            None if load_type == "bulk" else batch_date,
            (schemas or {}).get(table),
        )
        if load_type == "compact":
            # the folder name carries the date, so the files need not
            target = f"{target_root}_compacted/{table}/batch_date={batch_date}"
            write_table(rows.drop("batch_date"), target_format, target, mode or "overwrite", rows_per_file=rows_per_file)
        else:
            target = f"{target_root}/{table}"
            kind = load_type
            day = f"{target}/batch_date={batch_date}"
            if load_type == "incremental" and path_exists(spark, day):
                if repeated == "refuse":
                    raise FileExistsError(f"{day} is loaded already")
                kind = "reprocess"
            if kind == "reprocess" and rows.isEmpty():
                # a dynamic overwrite touches only dates that have rows
                delete_path(spark, day)
            else:
                write_dated(rows, target_format, target, kind, mode, rows_per_file)
        written.append(target)
    return written


def write_dated(
    rows: DataFrame, fmt: str, target: str, load_type: str, mode: str | None = None, rows_per_file: int = ROWS_PER_FILE
) -> None:
    """Write ``batch_date=`` folders; a date gets as many tasks as its rows need.

    The tasks of all dates are numbered, so no two of them meet by chance. Rows
    without a date are kept and go to the default folder of the partitioning.
    """
    default = {"bulk": "overwrite", "incremental": "append", "reprocess": "overwrite"}[load_type]
    # one row per date
    tasks = materialise(
        rows.groupBy("batch_date").agg(
            F.ceil(F.count(F.lit(1)) / F.lit(rows_per_file)).cast("int").alias("_tasks")
        ),
        "date-tasks",
    )
    all_tasks = tasks.agg(F.sum("_tasks").alias("tasks")).first()["tasks"] or 1
    before = Window.orderBy("batch_date").rowsBetween(Window.unboundedPreceding, -1)
    numbered = tasks.select(
        F.col("batch_date").alias("_date"), "_tasks", F.coalesce(F.sum("_tasks").over(before), F.lit(0)).alias("_first")
    )
    share = F.pmod(F.xxhash64(*rows.columns) + F.spark_partition_id(), F.col("_tasks"))
    met = rows.join(broadcast_if_small(numbered), F.col("batch_date").eqNullSafe(F.col("_date")))
    spread = met.withColumn("_task", (F.col("_first") + share).cast("int"))
    write_table(
        spread.repartitionById(all_tasks, "_task").select(*rows.columns),
        fmt,
        target,
        mode or default,
        partition_by=["batch_date"],
        replace_partitions=load_type == "reprocess",
    )


def compact_folder(
    spark: SparkSession,
    fmt: str,
    source: str,
    target: str,
    files: int | None = None,
    target_bytes: int = TARGET_FILE_BYTES,
    schema: T.StructType | None = None,
) -> int:
    """Rewrite a folder of small files with files of about ``target_bytes``; returns how many.

    Tasks read as many bytes as a file should have, so nothing is shuffled. An
    exact number of ``files`` needs a shuffle.
    """
    if source.rstrip("/") == target.rstrip("/"):
        raise ValueError("cannot compact a folder onto itself")
    rows = read_table(packing_session(spark, target_bytes), fmt, source, schema=schema)
    write_table(rows.repartition(files) if files else rows, fmt, target, mode="overwrite")
    return list_files(spark, target, f"*.{fmt}").count()


def compact_version(
    spark: SparkSession, root: str, target_bytes: int = TARGET_FILE_BYTES, large_share: float = 0.75
) -> dict[str, int]:
    """Publish a version whose small files are merged to about ``target_bytes``; files large enough stay as they are.

    The small files are packed into bins by the scan, largest first, and a task
    writes each bin as one file: no shuffle, and no byte of a large file is
    read. The version is published if all rows of the small files have arrived.
    Nothing is published where merging would not lower the number of files.
    """
    version = current_version(spark, root)
    schema = version_schema(spark, root, version)
    files = version_files(spark, root, version)
    folders = sorted({name.split("/")[0] for name in names_of(files)})
    sizes = list_files(spark, [f"{root}/{folder}" for folder in folders], "*.parquet").select(
        F.regexp_extract("path", "(version_[^/]+/[^/]+)$", 1).alias("file"), "length"
    ) if folders else spark.createDataFrame([], "file string, length long")
    small = materialise(files.join(sizes, "file").where(F.col("length") < large_share * target_bytes), "small-files")
    facts = small.agg(F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"), F.sum("length").alias("bytes")).first()
    if facts["files"] < 2 or -(-facts["bytes"] // target_bytes) >= facts["files"]:
        return {"kept": files.count(), "merged": 0, "written": 0}
    folder = new_folder(spark, root, version + 1)
    read_files(packing_session(spark, target_bytes), root, names_of(small), schema).drop(FILE).write.parquet(f"{root}/{folder}")
    written = materialise(list_written(spark, root, folder, schema), "merged-files")
    after = written.agg(F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows")).first()
    if after["rows"] != facts["rows"]:
        raise ValueError(f"version {version + 1} of {root} has {after['rows']} rows in place of {facts['rows']} and was not published")
    carried = materialise(files.join(small, "file", "left_anti"), "kept-files")
    make_current(spark, root, version + 1, carried.unionByName(written))
    return {"kept": carried.count(), "merged": facts["files"], "written": after["files"]}


def packing_session(spark: SparkSession, target_bytes: int = TARGET_FILE_BYTES) -> SparkSession:
    """A session of the same application whose scans read ``target_bytes`` per task, small files together."""
    session = spark.newSession()
    for name, value in session_settings().items():
        if name.startswith("spark.sql."):
            session.conf.set(name, value)
    session.conf.set("spark.sql.files.maxPartitionBytes", str(target_bytes))
    session.conf.set("spark.sql.files.openCostInBytes", "0")
    session.conf.set("spark.sql.files.minPartitionNum", "1")
    return session

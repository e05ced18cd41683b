"""File sinks."""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgrain.contracts import AUDIT_SCHEMA
from loomgrain.session import MB, materialise
from loomgrain.sources.files import list_files
from loomgrain.sources.readers import check_format

TARGET_FILE_BYTES = 256 * MB
TASK_ROWS = 2_000_000
MODES = ("append", "overwrite", "error", "ignore")


def write_table(
    df: DataFrame,
    fmt: str,
    path: str,
    mode: str = "error",
    partition_by: list[str] | None = None,
    rows_per_file: int | None = None,
    replace_partitions: bool = False,
    **options,
) -> None:
    """Write csv, json or parquet.

    ``replace_partitions`` overwrites only the partitions present in ``df``;
    a plain overwrite of a partitioned folder would drop all the others.
    """
    if mode not in MODES:
        raise ValueError(f"unsupported mode: {mode}")
    writer = df.write.format(check_format(fmt)).mode(mode).options(**options)
    if fmt == "csv":
        writer = writer.option("header", options.get("header", True))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    if replace_partitions:
        if mode != "overwrite" or not partition_by:
            raise ValueError("replace_partitions needs mode=overwrite and partition columns")
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.save(path)


def planned_files(rows: int, rows_per_file: int, max_files: int, allow_more: bool = False) -> int:
    if rows_per_file <= 0:
        raise ValueError("rows_per_file must be greater than zero")
    files = ceil(rows / rows_per_file)
    if files > max_files and not allow_more:
        raise ValueError(f"{files} files planned, {max_files} allowed")
    return files


def write_layout(
    df: DataFrame,
    fmt: str,
    path: str,
    rows_per_file: int,
    number: str,
    max_files: int,
    allow_more: bool = False,
    drop_number: bool = False,
) -> int:
    """Write files of exactly ``rows_per_file`` rows (the last may be shorter).

    ``number`` holds 1..rows. The file count is checked before anything is
    written. Tasks take whole files: their borders fall on multiples of
    ``rows_per_file``, where maxRecordsPerFile then cuts.
    """
    rows = df.count()
    files = planned_files(rows, rows_per_file, max_files, allow_more)
    if not files:
        return 0
    cores = df.sparkSession.sparkContext.defaultParallelism
    tasks = min(files, max(4 * cores, ceil(rows / TASK_ROWS)))
    laid = (
        df.withColumn("_file", F.floor((F.col(number) - 1) / rows_per_file))
        .repartitionByRange(tasks, "_file")
        .sortWithinPartitions(number)
        .drop("_file", *([number] if drop_number else []))
    )
    write_table(laid, fmt, path, rows_per_file=rows_per_file)
    return files


def files_for_bytes(total_bytes: int, target_bytes: int = TARGET_FILE_BYTES) -> int:
    return max(1, ceil(total_bytes / target_bytes))


def folder_bytes(spark: SparkSession, path: str) -> int:
    return list_files(spark, path).agg(F.sum("length").alias("bytes")).first()["bytes"] or 0


def write_rejects(rejected: DataFrame, path: str) -> bool:
    """Append the reject record; nothing is created when there are no rejects."""
    # written once, so that the check and the append do not validate again
    staged = materialise(rejected.select("_source_file", "_error_reason", "_raw_payload", "_corrupt_record"), "rejects")
    if staged.isEmpty():
        return False
    staged.write.mode("append").parquet(path)
    return True


def write_audit(spark: SparkSession, path: str, record: dict[str, object], mode: str = "append") -> None:
    """Append one audit row, or make it the only one."""
    missing = set(AUDIT_SCHEMA.names) - set(record)
    if missing:
        raise ValueError(f"audit record lacks {', '.join(sorted(missing))}")
    row = tuple(record[name] for name in AUDIT_SCHEMA.names)
    spark.createDataFrame([row], AUDIT_SCHEMA).coalesce(1).write.mode(mode).parquet(path)

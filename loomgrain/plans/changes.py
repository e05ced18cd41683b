"""Change data from files applied to a versioned dataset, file by file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgrain.contracts import CHANGES
from loomgrain.operators.quality import REASON, split, validate_changes
from loomgrain.operators.skew import broadcast_if_small
from loomgrain.operators.updates import latest_changes, merge_changes
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
from loomgrain.session import materialise
from loomgrain.sinks.writers import write_rejects
from loomgrain.sources.readers import read_by_contract

KEY = ["transaction_id"]
CHANGED = ["amount", "transaction_ts"]


def apply_changes(spark: SparkSession, fmt: str, changes_path: str, root: str, reject_path: str) -> dict[str, int]:
    """Validate, quarantine, keep the newest change per key, publish the next version. Returns the counts of the run."""
    checked = materialise(checked_changes(read_by_contract(spark, fmt, changes_path, CHANGES)), "checked-changes")
    return apply_checked(checked, root, reject_path)


def checked_changes(raw: DataFrame, source_file=None) -> DataFrame:
    return validate_changes(raw, CHANGES, source_file)


def apply_checked(checked: DataFrame, root: str, reject_path: str) -> dict[str, int]:
    accepted, rejected = split(checked)
    totals = checked.agg(
        F.count_if(F.col(REASON).isNull()).alias("accepted"), F.count_if(F.col(REASON).isNotNull()).alias("rejected")
    ).first()
    if totals["rejected"]:
        write_rejects(rejected, reject_path)
    latest = materialise(latest_changes(accepted, KEY).select(*CHANGES.names), "latest-changes")
    counts = apply_latest(latest, root, KEY, CHANGED)
    return {
        "accepted_changes": totals["accepted"],
        "staged_latest_changes": counts["staged"],
        "rejected_changes": totals["rejected"],
        "updated_target_rows": counts["updated"],
        "deleted_target_rows": counts["deleted"],
        "unmatched_target_changes": counts["unmatched"],
    }


def matched_rows(base: DataFrame, latest: DataFrame, key: list[str], operation: str = "operation") -> DataFrame:
    """``key``, operation and file of the base rows that a change meets: the one join over all of the base.

    It reads the key columns only. The changes go to the base where they are few.
    """
    side = broadcast_if_small(latest.select(*key, F.col(operation).alias("operation")))
    return base.select(*key, FILE).join(side, key)


def apply_latest(
    latest: DataFrame, root: str, key: list[str], columns: list[str], operation: str = "operation", onto: int | None = None
) -> dict[str, int]:
    """Publish the next version with ``latest``, a stored table of one change per key, applied to the current one.

    ``onto`` names an earlier version to start from, as when changes are applied
    anew. The result counts the changes and names the version they led to.

    Only the files that hold a changed row are rewritten; the others belong to
    the new version as they are. It is published if each rewritten file's rows,
    less the deleted ones, have arrived.
    """
    spark = latest.sparkSession
    current = current_version(spark, root)
    version, following = current if onto is None else onto, current + 1
    schema = version_schema(spark, root, version)
    files = version_files(spark, root, version)
    base = read_files(spark, root, names_of(files), schema)
    hits = materialise(matched_rows(base, latest, key, operation), "matched-rows")
    per_file = materialise(
        hits.groupBy(F.col(FILE).alias("file")).agg(
            F.count_if(F.col("operation") == "U").alias("updated"), F.count_if(F.col("operation") == "D").alias("deleted")
        ),
        "matched-files",
    )
    counts = per_file.agg(
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in ("updated", "deleted")], F.count(F.lit(1)).alias("files")
    ).first()
    staged, met = latest.count(), hits.select(*key).distinct().count()
    found = {"staged": staged, "updated": counts["updated"], "deleted": counts["deleted"], "unmatched": staged - met}
    if not counts["files"]:
        return {**found, "rewritten_files": 0, "carried_files": files.count(), "version": version}
    touched = read_files(spark, root, names_of(per_file), schema).drop(FILE)
    folder = new_folder(spark, root, following)
    merge_changes(touched, latest, key, columns, operation).write.parquet(f"{root}/{folder}")
    written = materialise(list_written(spark, root, folder, schema), "written-files")
    before = files.join(per_file, "file").agg(F.sum(F.col("rows") - F.col("deleted")).alias("rows")).first()["rows"]
    after = written.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")).first()["rows"]
    if before != after:
        raise ValueError(f"version {following} of {root} has {after} rows in place of {before} and was not published")
    carried = materialise(files.join(per_file, "file", "left_anti"), "carried-files")
    make_current(spark, root, following, carried.unionByName(written))
    return {**found, "rewritten_files": counts["files"], "carried_files": carried.count(), "version": following}

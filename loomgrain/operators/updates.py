"""Updates and deletes by key on immutable files: join, overlay, write a new version."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgrain.operators.ranking import top_per_group
from loomgrain.operators.skew import broadcast_if_small

# with equal change_ts the remaining columns decide, so every run keeps the same change
CHANGE_ORDER = [
    ("change_ts", "desc"),
    ("operation", "desc"),
    ("amount", "desc"),
    ("transaction_ts", "desc"),
]


def overlay(
    base: DataFrame,
    updates: DataFrame,
    key: list[str],
    assignments: dict[str, str],
    nulls_clear: bool = False,
) -> DataFrame:
    """``base`` with ``assignments`` (column -> update column) applied by key.

    Keys without an update keep their row, updates without a base row are left
    out. A NULL new value keeps the old one unless ``nulls_clear`` is set.
    ``updates`` must hold one row per key, and should be a stored table.
    """
    named = {column: f"_new_{column}" for column in assignments}
    side = updates.select(
        *key, F.lit(True).alias("_found"), *[F.col(assignments[c]).alias(named[c]) for c in assignments]
    )
    joined = base.join(broadcast_if_small(side), key, "left")

    def result(column: str):
        if column not in named:
            return F.col(column)
        new, old = F.col(named[column]), F.col(column)
        value = F.when(F.col("_found"), new).otherwise(old) if nulls_clear else F.coalesce(new, old)
        return value.alias(column)

    return joined.select(*[result(c) for c in base.columns])


def latest_changes(changes: DataFrame, key: list[str], order=None) -> DataFrame:
    """The newest change of each key."""
    return top_per_group(changes, key, order or CHANGE_ORDER, 1)


def merge_changes(
    base: DataFrame, latest: DataFrame, key: list[str], columns: list[str], operation: str = "operation"
) -> DataFrame:
    """U sets ``columns`` on existing keys, D removes the row, other keys change nothing.

    ``latest`` should be a staged table: it is measured and then joined.
    """
    side = broadcast_if_small(
        latest.select(*key, F.col(operation).alias("_op"), *[F.col(c).alias(f"_new_{c}") for c in columns])
    )
    return (
        base.join(side, key, "left")
        .where(~F.col("_op").eqNullSafe("D"))
        .select(
            *[
                F.when(F.col("_op") == "U", F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
                for c in base.columns
            ]
        )
    )


def change_counts(base: DataFrame, latest: DataFrame, key: list[str], operation: str = "operation") -> DataFrame:
    """One row: staged, updated, deleted and unmatched changes."""
    hits = latest.select(*key, F.col(operation).alias("_op")).join(
        base.select(*key, F.lit(True).alias("_found")), key, "left"
    )
    return hits.agg(
        F.count(F.lit(1)).alias("staged"),
        F.count_if(F.col("_found") & (F.col("_op") == "U")).alias("updated"),
        F.count_if(F.col("_found") & (F.col("_op") == "D")).alias("deleted"),
        F.count_if(F.col("_found").isNull()).alias("unmatched"),
    )

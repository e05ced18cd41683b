"""Contract and rule checks, accept/reject split, reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomgrain.contracts import CORRUPT, Contract
from loomgrain.functions.values import try_convert

REASON = "_error_reason"
REJECT_COLUMNS = ("_source_file", REASON, "_raw_payload", CORRUPT)


def require_columns(df: DataFrame, contract: Contract) -> None:
    """A missing column is an error of the whole source, not of its rows."""
    missing = sorted(set(contract.names) - set(df.columns))
    if missing:
        raise ValueError(f"source for {contract.name} is missing columns: {', '.join(missing)}")


def project_to_contract(df: DataFrame, contract: Contract) -> DataFrame:
    """The contract's columns in its order; extra columns are left out."""
    require_columns(df, contract)
    return df.select(*contract.names)


def cast_to_contract(df: DataFrame, contract: Contract) -> DataFrame:
    """Declared types for the contract's columns; a bad value becomes NULL."""
    types = dict(contract.columns)
    return df.select(*[try_convert(F.col(c), types[c]).alias(c) if c in types else F.col(c) for c in df.columns])


def first_failure(rules: list[tuple[Column, str]]) -> Column:
    """Reason of the first rule that fires, NULL if none does."""
    reason = None
    for failed, name in rules:
        reason = F.when(failed, name) if reason is None else reason.when(failed, name)
    return F.lit(None).cast("string") if reason is None else reason


def with_payload(df: DataFrame, contract: Contract, source_file: Column | None = None) -> DataFrame:
    """Keep where a row came from and what it looked like before any conversion."""
    origin = F.col("_metadata.file_path") if source_file is None else source_file
    extra = [] if CORRUPT in df.columns else [F.lit(None).cast("string").alias(CORRUPT)]
    payload = F.to_json(F.struct(*contract.names))
    return df.select("*", *extra, origin.alias("_source_file"), payload.alias("_raw_payload"))


def validate_contract(df: DataFrame, contract: Contract, source_file: Column | None = None) -> DataFrame:
    """Cast to contract; ``_error_reason`` names the first failing check.

    Malformed records come first, then required columns in alphabetical order.
    """
    require_columns(df, contract)
    checked = cast_to_contract(with_payload(df, contract, source_file), contract)
    rules = [(F.col(CORRUPT).isNotNull(), "malformed_record")]
    rules += [(F.col(c).isNull(), f"invalid_or_missing_{c}") for c in contract.required]
    return checked.withColumn(REASON, first_failure(rules))


def validate_changes(df: DataFrame, contract: Contract, source_file: Column | None = None) -> DataFrame:
    """Check change records (operation U or D, key, times, values of an update)."""
    require_columns(df, contract)
    checked = cast_to_contract(
        with_payload(df, contract, source_file).withColumn("operation", F.upper(F.trim("operation"))), contract
    )
    operation = F.col("operation")
    return checked.withColumn(
        REASON,
        first_failure(
            [
                (F.col(CORRUPT).isNotNull(), "malformed_record"),
                (operation.isNull() | ~operation.isin("U", "D"), "invalid_operation"),
                (F.col("transaction_id").isNull(), "invalid_transaction_id"),
                (F.col("change_ts").isNull(), "invalid_change_ts"),
                (
                    (operation == "U") & (F.col("amount").isNull() | F.col("transaction_ts").isNull()),
                    "update_missing_values",
                ),
            ]
        ),
    )


def validate_io_rows(df: DataFrame) -> DataFrame:
    """Business rules over (record_id, product_id, amount, event_date)."""
    corrupt = F.col(CORRUPT).isNotNull() if CORRUPT in df.columns else F.lit(False)
    return df.withColumn("parsed_date", F.try_to_date("event_date", "yyyy-MM-dd")).withColumn(
        REASON,
        first_failure(
            [
                (corrupt, "malformed_record"),
                (F.col("record_id").isNull(), "missing_record_id"),
                (F.col("product_id").isNull(), "missing_product_id"),
                (F.col("amount").isNull(), "invalid_amount"),
                (F.col("amount") < 0, "negative_amount"),
                (F.col("parsed_date").isNull(), "invalid_event_date"),
            ]
        ),
    )


def split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected)."""
    return df.where(F.col(REASON).isNull()), df.where(F.col(REASON).isNotNull())


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


def schema_drift(actual: T.StructType, contract: Contract) -> list[tuple[str, str, str | None, str | None]]:
    """(column, added/missing/changed, expected type, actual type), empty when compatible."""
    expected = dict(contract.columns)
    found = {f.name: f.dataType.simpleString() for f in actual.fields if not f.name.startswith("_")}
    drift = [(c, "missing", t, None) for c, t in expected.items() if c not in found]
    drift += [(c, "added", None, t) for c, t in found.items() if c not in expected]
    drift += [(c, "changed", t, found[c]) for c, t in expected.items() if c in found and found[c] != t]
    return sorted(drift)


def reconcile(expected: DataFrame, observed: DataFrame, on: list[str]) -> DataFrame:
    """Expected rows against accepted + rejected and against what the target holds."""
    return expected.join(observed, on, "full").select(
        *on,
        "expected_rows",
        "accepted_rows",
        "rejected_rows",
        "target_rows",
        (
            F.col("expected_rows").eqNullSafe(F.col("accepted_rows") + F.col("rejected_rows"))
            & F.col("target_rows").eqNullSafe(F.col("accepted_rows"))
        ).alias("reconciled"),
    )


def same_rows(left: DataFrame, right: DataFrame) -> bool:
    """Whether both hold the same rows the same number of times.

    Copies are counted before the comparison, so a run of identical rows
    travels as one row.
    """
    columns = left.columns
    counted = [
        df.select(*columns).groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies")) for df in (left, right)
    ]
    sides = counted[0].withColumn("_side", F.lit(1)).unionByName(counted[1].withColumn("_side", F.lit(-1)))
    differing = sides.groupBy(*columns).agg(F.sum(F.col("_copies") * F.col("_side")).alias("_balance"))
    return differing.where(F.col("_balance") != 0).isEmpty()

"""Contract checks, reasons, drift and reconciliation on small fixtures."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from loomgrain.contracts import CHANGES, IO_ROWS, RETAIL
from loomgrain.operators import quality
from loomgrain.operators.updates import change_counts, latest_changes, merge_changes, overlay
from loomgrain.sources.readers import read_by_contract, read_table, read_tolerant_parquet

MALFORMED = """record_id,product_id,amount,event_date
1,1001,19.95,2026-01-01
2,1002,not_a_number,2026-01-02
3,1003,42.00
4,1004,18.25,2026-01-04,unexpected_column
broken,row
"""


@pytest.fixture()
def bad_csv(tmp_path):
    (tmp_path / "malformed.csv").write_text(MALFORMED)
    return str(tmp_path)


def reasons(df):
    return {r["_raw_payload"]: r["_error_reason"] for r in df.select("_raw_payload", "_error_reason").collect()}


def test_typed_scan_rejects_by_record(spark, bad_csv):
    checked = quality.validate_io_rows(read_by_contract(spark, "csv", bad_csv, IO_ROWS, typed=True))
    counted = {r["_error_reason"]: r["count"] for r in checked.groupBy("_error_reason").count().collect()}
    assert counted == {None: 1, "malformed_record": 4}


def test_text_scan_rejects_by_cast(spark, bad_csv):
    checked = quality.validate_contract(read_by_contract(spark, "csv", bad_csv, IO_ROWS), IO_ROWS)
    counted = {r["_error_reason"]: r["count"] for r in checked.groupBy("_error_reason").count().collect()}
    assert counted == {None: 1, "malformed_record": 3, "invalid_or_missing_amount": 1}
    files = {r[0].rsplit("/", 1)[-1] for r in checked.select("_source_file").distinct().collect()}
    assert files == {"malformed.csv"}


def test_rules_in_order(spark):
    data = [
        (1, 1001, 19.95, "2026-01-01"),
        (2, 1002, -5.0, "bad-date"),
        (3, None, 30.0, "2026-01-03"),
        (None, None, None, None),
        (5, 1005, None, "2026-01-03"),
        (6, 1006, 1.0, "2026-02-30"),
    ]
    checked = quality.validate_io_rows(spark.createDataFrame(data, IO_ROWS.schema))
    got = {(r["record_id"], r["_error_reason"]) for r in checked.collect()}
    assert got == {
        (1, None),
        (2, "negative_amount"),
        (3, "missing_product_id"),
        (None, "missing_record_id"),
        (5, "invalid_amount"),
        (6, "invalid_event_date"),
    }


def test_required_columns_are_checked_alphabetically(spark):
    contract = RETAIL["sales"]
    empty = spark.createDataFrame([tuple([None] * len(contract.names))], contract.schema)
    checked = quality.validate_contract(empty, contract, F.lit("memory"))
    assert checked.first()["_error_reason"] == "invalid_or_missing_customer_id"
    optional = RETAIL["customer"]
    row = spark.createDataFrame([(1, "a", None, None, None)], optional.schema)
    assert quality.validate_contract(row, optional, F.lit("m")).first()["_error_reason"] == "invalid_or_missing_created_at"


def test_missing_column_is_an_error(spark):
    with pytest.raises(ValueError, match="missing columns: dname, loc"):
        quality.validate_contract(spark.range(1).select(F.col("id").alias("deptno")), RETAIL["dept"])


def test_extra_columns_are_left_out(spark):
    dept = spark.createDataFrame([(10, "a", "b", "c")], "deptno bigint, extra string, dname string, loc string")
    assert quality.project_to_contract(dept, RETAIL["dept"]).columns == ["deptno", "dname", "loc"]


def test_change_reasons(spark):
    data = [
        ("U", "1", "5.00", "2026-01-01 00:00:00", "2026-02-01 00:00:00"),
        (" u ", "2", "5.00", "2026-01-01 00:00:00", "2026-02-01 00:00:00"),
        ("D", "3", None, None, "2026-02-01 00:00:00"),
        ("X", "4", None, None, "2026-02-01 00:00:00"),
        (None, "5", None, None, None),
        ("D", "x6", None, None, None),
        ("D", "7", None, None, None),
        ("U", "8", None, "2026-01-01 00:00:00", "2026-02-01 00:00:00"),
        ("U", "9", "5.00", "no time", "2026-02-01 00:00:00"),
    ]
    names = "operation string, transaction_id string, amount string, transaction_ts string, change_ts string"
    checked = quality.validate_changes(spark.createDataFrame(data, names), CHANGES, F.lit("memory"))
    assert [r["_error_reason"] for r in checked.orderBy("_raw_payload").collect()].count(None) == 3
    counted = {r["_error_reason"]: r["count"] for r in checked.groupBy("_error_reason").count().collect()}
    assert counted == {
        None: 3,
        "invalid_operation": 2,
        "invalid_transaction_id": 1,
        "invalid_change_ts": 1,
        "update_missing_values": 2,
    }


def test_latest_change_has_a_total_order(spark):
    data = [
        ("U", 1, "1.00", "2026-02-01 00:00:00"),
        ("U", 1, "2.00", "2026-02-02 00:00:00"),
        ("D", 2, None, "2026-02-01 00:00:00"),
        ("U", 2, "3.00", "2026-02-01 00:00:00"),
    ]
    changes = spark.createDataFrame(data, "operation string, transaction_id bigint, amount string, change_ts string")
    typed = changes.select(
        "operation",
        "transaction_id",
        F.col("amount").cast("decimal(16,2)").alias("amount"),
        F.lit(None).cast("timestamp").alias("transaction_ts"),
        F.col("change_ts").cast("timestamp").alias("change_ts"),
    )
    for parts in (1, 4):
        latest = latest_changes(typed.repartition(parts), ["transaction_id"])
        assert [(r[0], float(r[1])) for r in rows(latest, ["transaction_id", "amount"])] == [(1, 2.0), (2, 3.0)]


def test_merge_is_no_upsert(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k bigint, v string")
    latest = spark.createDataFrame([("U", 1, "z"), ("D", 2, None), ("U", 9, "q")], "operation string, k bigint, v string")
    assert rows(merge_changes(base, latest, ["k"], ["v"]), ["k", "v"]) == [(1, "z"), (3, "c")]
    counts = change_counts(base, latest, ["k"]).first()
    assert (counts["staged"], counts["updated"], counts["deleted"], counts["unmatched"]) == (3, 1, 1, 1)


def test_overlay_and_null_values(spark):
    base = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "k bigint, v string, x double")
    new = spark.createDataFrame([(1, None, 9.0), (7, "q", 7.0)], "k bigint, nv string, nx double")
    assert rows(overlay(base, new, ["k"], {"v": "nv", "x": "nx"}), ["k", "v", "x"]) == [(1, "a", 9.0), (2, "b", 2.0)]
    cleared = overlay(base, new, ["k"], {"v": "nv", "x": "nx"}, nulls_clear=True)
    assert rows(cleared, ["k", "v", "x"]) == [(1, None, 9.0), (2, "b", 2.0)]


def test_schema_drift():
    actual = T.StructType(
        [T.StructField("deptno", T.IntegerType()), T.StructField("dname", T.StringType()), T.StructField("x", T.DateType())]
    )
    assert quality.schema_drift(actual, RETAIL["dept"]) == [
        ("deptno", "changed", "bigint", "int"),
        ("loc", "missing", "string", None),
        ("x", "added", None, "date"),
    ]


def test_same_rows_counts_copies(spark):
    left = spark.createDataFrame([(1, None), (1, None), (2, "b")], "a int, b string")
    assert quality.same_rows(left, left.repartition(5))
    assert not quality.same_rows(left, left.distinct())


def test_reconcile_flags_differences(spark):
    expected = spark.createDataFrame([("a", 5), ("b", 5), ("c", 1)], "t string, expected_rows bigint")
    observed = spark.createDataFrame(
        [("a", 4, 1, 4), ("b", 4, 0, 4)], "t string, accepted_rows bigint, rejected_rows bigint, target_rows bigint"
    )
    flags = {r["t"]: r["reconciled"] for r in quality.reconcile(expected, observed, ["t"]).collect()}
    assert flags == {"a": True, "b": False, "c": False}


def test_tolerant_parquet_reports_skipped_files(spark, tmp_path):
    folder = str(tmp_path / "mixed files")
    spark.range(3).select(F.col("id").alias("record_id")).coalesce(1).write.parquet(folder)
    (tmp_path / "mixed files" / "corrupt_file.parquet").write_bytes(b"not a parquet file\n")
    whole = next((tmp_path / "mixed files").glob("part-*.parquet")).read_bytes()
    (tmp_path / "mixed files" / "cut_file.parquet").write_bytes(whole[:60] + whole[-8:])
    spark.range(0).select(F.col("id").alias("record_id")).coalesce(1).write.parquet(str(tmp_path / "none"))
    (tmp_path / "mixed files" / "empty_file.parquet").write_bytes(next((tmp_path / "none").glob("part-*.parquet")).read_bytes())
    schema = T.StructType([T.StructField("record_id", T.LongType())])
    read, files = read_tolerant_parquet(spark, folder, schema)
    assert read.count() == 3
    listed = {r["path"].rsplit("/", 1)[-1]: (r["was_read"], r["rows"]) for r in files.collect()}
    assert listed.pop("corrupt_file.parquet") == (False, 0)
    assert listed.pop("cut_file.parquet") == (False, 0)
    assert listed.pop("empty_file.parquet") == (True, 0)
    assert list(listed.values()) == [(True, 3)]
    with pytest.raises(Exception):
        spark.read.schema(schema).parquet(folder).collect()


def test_unknown_format(spark):
    with pytest.raises(ValueError):
        read_table(spark, "xml", "/nowhere")

"""The command line end to end: generate, load, change, batch, lake, compact."""

import pytest

from conftest import rows
from loomgrain.contracts import AUDIT_SCHEMA, RETAIL
from loomgrain.jobs import parser, run
from loomgrain.plans.datasets import write_course, write_io_lab, write_scenario
from loomgrain.plans.publish import publish, read_version
from loomgrain.sources import generators as gen
from loomgrain.sources.files import inventory, read_manifests


@pytest.fixture()
def job(spark):
    return lambda *words: run(spark, parser().parse_args([str(w) for w in words]))


def test_scenarios_match_their_manifests(spark, tmp_path, job):
    job("generate", "scenarios", "--target", tmp_path, "--scenarios", "2,5", "--format", "json")
    expected = read_manifests(spark, str(tmp_path / "_manifests" / "*"))
    assert {(r["table_name"], r["files"], r["rows"]) for r in expected.where("scenario = '02'").collect()} == {
        (t, 20, 200) for t in ("location", "product", "customer", "sales")
    }
    folder = tmp_path / "05_many_small_csv_multiple_tables" / "05_csv_small_multi" / "json"
    found = {r["table_name"]: r["files"] for r in inventory(spark, str(folder), "*.json").collect()}
    assert found == {"dept": 20, "projects": 20, "emp": 20, "emp_projects": 20}
    for table in found:
        stored = spark.read.schema(RETAIL[table].schema).json(str(folder / table))
        assert stored.count() == 200 and stored.select(*RETAIL[table].key).distinct().count() == 200


def test_load_to_a_folder(spark, tmp_path, job):
    write_scenario(spark, str(tmp_path), "01", "csv", 4, 25)
    source = tmp_path / "01_many_small_json_customer" / "01_json_small_customer" / "csv" / "customer"
    words = ["load", "--source", source, "--format", "csv", "--table", "customer", "--target", tmp_path / "t"]
    words += ["--rejects", tmp_path / "r", "--audit", tmp_path / "a"]
    assert job(*words) == {"table": "customer", "accepted_rows": 100, "rejected_rows": 0}
    audit = spark.read.schema(AUDIT_SCHEMA).parquet(str(tmp_path / "a")).first()
    assert (audit["source_files"], audit["accepted_rows"]) == (4, 100)
    with pytest.raises(ValueError):
        job(*words, "--jdbc-url", "jdbc:x")


def test_changes(spark, tmp_path, job):
    job("generate", "changes", "--target", tmp_path, "--updates", 100, "--deletes", 25, "--rows-per-file", 100)
    root = str(tmp_path / "tx")
    publish(gen.retail_sales_transaction(gen.row_numbers(spark, 110)), root, 1)
    source = tmp_path / "11_cdc_sales_transaction" / "csv" / "sales_transaction_changes"
    counts = job("changes", "--source", source, "--format", "csv", "--dataset", root, "--rejects", tmp_path / "rej")
    assert counts == {
        "accepted_changes": 125,
        "staged_latest_changes": 125,
        "rejected_changes": 0,
        "updated_target_rows": 100,
        "deleted_target_rows": 10,
        "unmatched_target_changes": 15,
    }
    assert read_version(spark, root).count() == 100


def test_banking_batches(spark, tmp_path, job):
    job("generate", "banking", "--target", tmp_path / "in", "--customers", 60, "--days", 2, "--format", "json")
    words = ["batch", "--source", tmp_path / "in", "--target", tmp_path / "out", "--source-format", "json"]
    job(*words, "--load-type", "bulk", "--tables", "customers", "loans")
    assert rows(spark.read.parquet(str(tmp_path / "out" / "customers")).groupBy("batch_date").count(), ["count"]) == [(60,), (60,)]
    job(*words, "--load-type", "reprocess", "--batch-date", "2026-01-02", "--tables", "loans")
    assert spark.read.parquet(str(tmp_path / "out" / "loans")).count() == 24
    with pytest.raises(ValueError):
        job(*words, "--load-type", "bulk", "--tables", "nothing")


def test_lake_and_compaction(spark, tmp_path, job):
    for number in ("07", "10"):
        write_scenario(spark, str(tmp_path), number, "csv", 3, 10)
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS jobs_bronze LOCATION '{tmp_path}/b'")
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS jobs_silver LOCATION '{tmp_path}/s'")
    words = ["lake", "--source", tmp_path, "--scenarios", "7,10", "--bronze", "jobs_bronze", "--silver", "jobs_silver"]
    assert job(*words) == ["sales_transaction"]
    assert spark.table("jobs_silver.sales_transaction").count() == 60
    source = tmp_path / "07_many_small_parquet_transaction" / "07_parquet_small_sales_transaction" / "csv" / "sales_transaction"
    assert job("compact", "--source", source, "--target", tmp_path / "c", "--format", "csv") == 1


def test_course_and_io_guards(spark, tmp_path):
    files = write_course(spark, str(tmp_path / "c"), "parquet", 10, 300, 4, 20, rows_per_file=100)
    assert files == {"dept": 1, "emp": 3, "projects": 1, "salgrade": 1, "emp_projects": 12}
    with pytest.raises(ValueError):
        write_course(spark, str(tmp_path / "d"), "parquet", rows_per_file=10)
    with pytest.raises(ValueError):
        write_io_lab(spark, str(tmp_path / "e"), tiny_files=5000)
    write_io_lab(spark, str(tmp_path / "f"), 100, ("orders",), 7, 3, 2, 50)
    found = {r["table_name"]: r["files"] for r in inventory(spark, str(tmp_path / "f" / "one_row_csv"), "*.csv").collect()}
    assert found == {"orders": 7, "products": 3}

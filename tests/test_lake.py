"""Batch loads, bronze and silver, compaction, validated loads, streaming ingestion."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from loomgrain.contracts import AUDIT_SCHEMA, RETAIL, contract
from loomgrain.operators.quality import same_rows
from loomgrain.plans.lake import (
    build_bronze_silver,
    clean,
    compact_folder,
    load_batches,
    packing_session,
    to_silver,
    union_by_name,
    with_lineage,
    write_dated,
)
from loomgrain.plans.layout import compare_layouts, timed_update
from loomgrain.plans.loads import in_load_order, load_many
from loomgrain.plans.publish import current_version, publish, read_version
from loomgrain.sources.gate import SchemaDrift
from loomgrain.sinks.writers import write_layout, write_table
from loomgrain.sources import generators as gen
from loomgrain.sources.files import list_files
from loomgrain.sources.readers import read_batch
from loomgrain.streaming.ingest import ingest_new_files, ingested

DEPOSIT = contract("deposits", {"id": "bigint", "amount": "double"}, "id")
DAYS = [f"2026-01-0{d}" for d in range(1, 8)]


@pytest.fixture(scope="module")
def feed(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("feed"))
    deposits = spark.range(700).select(
        "id",
        (F.col("id") * 1.5).alias("amount"),
        F.date_add(F.lit("2026-01-01").cast("date"), (F.col("id") % 7).cast("int")).alias("batch_date"),
    )
    write_table(deposits.repartition(4), "csv", f"{root}/deposits", partition_by=["batch_date"])
    return root


def run(spark, feed, target, load_type, date=None, **more):
    load_batches(spark, feed, target, ["deposits"], load_type, date, schemas={"deposits": DEPOSIT.schema}, **more)
    return spark.read.parquet(f"{target}/deposits") if load_type != "compact" else None


def test_bulk_equals_the_incremental_loads(spark, feed, tmp_path):
    bulk = run(spark, feed, str(tmp_path / "bulk"), "bulk")
    for day in DAYS:
        piecewise = run(spark, feed, str(tmp_path / "inc"), "incremental", day)
    assert dict(piecewise.dtypes)["batch_date"] == "date"
    assert same_rows(bulk, piecewise)


def test_reprocess_replaces_one_date(spark, feed, tmp_path):
    target = str(tmp_path / "t")
    run(spark, feed, target, "bulk")
    untouched = {r["path"] for r in list_files(spark, f"{target}/deposits").where("path NOT LIKE '%2026-01-03%'").collect()}
    after = run(spark, feed, target, "reprocess", "2026-01-03")
    kept = {r["path"] for r in list_files(spark, f"{target}/deposits").where("path NOT LIKE '%2026-01-03%'").collect()}
    assert kept == untouched and after.count() == 700


def test_rows_without_a_date_are_kept(spark, tmp_path):
    dated = spark.createDataFrame([(1, dt.date(2026, 1, 1)), (2, None), (3, None)], "id long, batch_date date")
    write_dated(dated, "parquet", str(tmp_path / "t"), "bulk")
    assert sorted(r["id"] for r in spark.read.parquet(str(tmp_path / "t")).collect()) == [1, 2, 3]


def test_reprocess_clears_an_emptied_date(spark, feed, tmp_path):
    target = str(tmp_path / "t")
    run(spark, feed, target, "bulk")
    extra = spark.createDataFrame([(9, 1.0, dt.date(2026, 2, 1))], "id long, amount double, batch_date date")
    write_dated(extra, "parquet", f"{target}/deposits", "incremental")
    assert spark.read.parquet(f"{target}/deposits").count() == 701
    # the source has no rows for that date
    assert run(spark, feed, target, "reprocess", "2026-02-01").count() == 700


def test_a_repeated_incremental_load_never_doubles(spark, feed, tmp_path):
    target = str(tmp_path / "t")
    run(spark, feed, target, "incremental", "2026-01-03")
    with pytest.raises(FileExistsError):
        run(spark, feed, target, "incremental", "2026-01-03")
    assert run(spark, feed, target, "incremental", "2026-01-03", repeated="replace").count() == 100


def test_tasks_of_a_date_are_even(spark, tmp_path):
    rows_ = spark.range(40_000).select("id", F.date_add(F.lit("2026-01-01").cast("date"), (F.col("id") % 4).cast("int")).alias("batch_date"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_dated(rows_, "parquet", str(tmp_path / "t"), "bulk", rows_per_file=1000)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    written = spark.read.parquet(str(tmp_path / "t")).groupBy(F.col("_metadata.file_path")).count().collect()
    assert len(written) == 40 and max(r["count"] for r in written) < 1300


def test_unlike_sources_are_refused_or_read_as_text(spark, tmp_path):
    for number, code in (("01", "10"), ("02", "A7")):
        (tmp_path / number).mkdir()
        (tmp_path / number / "x.csv").write_text(f"id,code\n1,{code}\n")
    sources = [(n, "plans", str(tmp_path / n)) for n in ("01", "02")]
    names = {"bronze": "gate_bronze", "silver": "gate_silver", "locations": {n: str(tmp_path / n) for n in ("gate_bronze", "gate_silver")}}
    with pytest.raises(SchemaDrift, match="code"):
        build_bronze_silver(spark, sources, "csv", **names)
    built = build_bronze_silver(spark, sources, "csv", **names, unlike="text")
    assert {r["code"] for r in built["plans"][0].collect()} == {"10", "A7"}


def test_compaction_needs_no_shuffle(spark, feed):
    packed = packing_session(spark).read.csv(f"{feed}/deposits", header=True)
    assert packed.rdd.getNumPartitions() == 1
    assert "Exchange" not in packed._jdf.queryExecution().executedPlan().toString()


def test_compact_keeps_rows_and_lowers_files(spark, feed, tmp_path):
    target = str(tmp_path / "t")
    run(spark, feed, target, "compact", "2026-01-03")
    folder = f"{target}_compacted/deposits"
    compacted = spark.read.parquet(folder)
    assert compacted.count() == 100 and list_files(spark, folder, "*.parquet").count() == 1
    assert compacted.select("batch_date").distinct().collect() == [(dt.date(2026, 1, 3),)]


def test_a_large_date_gets_several_tasks(spark, feed, tmp_path):
    target = str(tmp_path / "t")
    # adaptive execution would merge tasks this small
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        run(spark, feed, target, "bulk", rows_per_file=20)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    per_date = list_files(spark, f"{target}/deposits", "*.parquet").count() / 7
    assert per_date > 2


def test_empty_date_and_missing_date(spark, feed, tmp_path):
    (tmp_path / "deposits" / "batch_date=2026-02-01").mkdir(parents=True)
    assert read_batch(spark, "csv", str(tmp_path / "deposits"), "2026-02-01", DEPOSIT.schema).count() == 0
    assert read_batch(spark, "csv", f"{feed}/deposits", "2031-01-01", DEPOSIT.schema).count() == 0
    with pytest.raises(ValueError):
        run(spark, feed, str(tmp_path / "t"), "incremental")
    with pytest.raises(ValueError):
        run(spark, feed, str(tmp_path / "t"), "yearly")


def test_one_date_prunes_folders(spark, feed):
    one = read_batch(spark, "csv", f"{feed}/deposits", "2026-01-03", DEPOSIT.schema)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch_date" in plan
    assert len(one.inputFiles()) > 0


def test_bronze_and_silver(spark, tmp_path):
    people = spark.createDataFrame([(1, " Ann ", " ANN@X.org"), (1, "Ann", "ann@x.org "), (2, "Bo", None)], "id int, name string, email string")
    for number in ("01", "02"):
        people.write.parquet(str(tmp_path / number))
    sources = [(n, "people", str(tmp_path / n)) for n in ("01", "02")]
    places = {"t_bronze": str(tmp_path / "b"), "t_silver": str(tmp_path / "s")}
    for _ in range(2):
        bronze, silver = build_bronze_silver(spark, sources, "parquet", "t_bronze", "t_silver", locations=places)["people"]
    assert bronze.count() == 6
    # the scenario is part of a row, so each scenario keeps its copy
    assert rows(silver, ["source_scenario", "id", "name", "email"]) == [
        ("01", 1, "Ann", "ann@x.org"), ("01", 2, "Bo", None), ("02", 1, "Ann", "ann@x.org"), ("02", 2, "Bo", None),
    ]
    again = clean(silver.drop("silver_load_ts"))
    assert same_rows(again, silver.drop("silver_load_ts"))
    by_key = to_silver(bronze.drop("bronze_load_ts"), key=["id"])
    assert rows(by_key, ["id", "source_scenario"]) == [(1, "01"), (2, "01")]
    assert by_key.select("silver_load_ts").distinct().count() == 1


def test_union_fills_missing_columns(spark):
    frames = [with_lineage(spark.range(1), "01", "a", "csv"), spark.range(2).withColumn("x", F.lit("y"))]
    assert union_by_name(frames).where("x IS NULL").count() == 1


def test_validated_loads_in_order(spark, tmp_path):
    assert in_load_order(["sales", "customer", "location"]) == ["location", "customer", "sales"]
    with pytest.raises(ValueError):
        in_load_order(["unknown"])
    paths = {}
    for table in ("sales", "product", "location", "customer"):
        frame = gen.RETAIL_GENERATORS[table](gen.row_numbers(spark, 200))
        paths[table] = str(tmp_path / "src" / table)
        write_table(frame.repartition(5), "csv", paths[table])
    seen = []

    def target(accepted, table, writers):
        seen.append((table.name, writers))
        write_table(accepted.repartition(writers), "parquet", str(tmp_path / "target" / table.name), "overwrite")

    audit = str(tmp_path / "audit")
    outcomes = load_many(spark, "csv", paths, target, "s02", str(tmp_path / "rej"), audit)
    assert seen == [("location", 2), ("product", 2), ("customer", 2), ("sales", 4)]
    assert all((o.accepted_rows, o.rejected_rows, o.source_files) == (200, 0, 5) for o in outcomes.values())
    assert not (tmp_path / "rej").exists()
    records = spark.read.schema(AUDIT_SCHEMA).parquet(audit)
    assert records.count() == 4 and records.agg(F.sum("accepted_rows")).first()[0] == 800
    stored = spark.read.parquet(str(tmp_path / "target" / "sales"))
    orphans = stored.join(spark.read.parquet(str(tmp_path / "target" / "customer")), "customer_id", "left_anti")
    assert orphans.count() == 0


@pytest.mark.parametrize("rows_per_file, files", [(10, 21), (200, 2), (1000, 1)])
def test_layout_writes_exact_files(spark, tmp_path, rows_per_file, files):
    path = str(tmp_path / "t")
    frame = gen.io_rows(gen.row_numbers(spark, 203))
    assert write_layout(frame, "parquet", path, rows_per_file, "record_id", max_files=50) == files
    per_file = spark.read.parquet(path).groupBy("_metadata.file_path").count()
    sizes = sorted(r["count"] for r in per_file.collect())
    assert len(sizes) == files and sizes[-1] <= rows_per_file and sum(sizes) == 203


def test_layout_guard_fires_before_writing(spark, tmp_path):
    frame = gen.io_rows(gen.row_numbers(spark, 203))
    with pytest.raises(ValueError):
        write_layout(frame, "csv", str(tmp_path / "t"), 1, "record_id", max_files=50)
    assert not (tmp_path / "t").exists()


def test_compaction_of_a_folder(spark, tmp_path):
    source, target = str(tmp_path / "small"), str(tmp_path / "large")
    write_layout(gen.io_rows(gen.row_numbers(spark, 325)), "csv", source, 5, "record_id", max_files=500)
    from loomgrain.contracts import IO_ROWS

    assert compact_folder(spark, "csv", source, target, files=3, schema=IO_ROWS.schema) == 3
    read = lambda p: spark.read.schema(IO_ROWS.schema).csv(p, header=True)
    assert same_rows(read(source), read(target))
    with pytest.raises(ValueError):
        compact_folder(spark, "csv", source, source + "/")


def test_only_checked_versions_are_current(spark, tmp_path):
    root = str(tmp_path / "set")
    publish(spark.range(3), root, 1)
    with pytest.raises(ValueError):
        publish(spark.range(9), root, 2, lambda written: written.count() == 8)
    assert current_version(spark, root) == 1 and read_version(spark, root).count() == 3
    publish(spark.range(8), root, 3, lambda written: written.count() == 8)
    assert current_version(spark, root) == 3 and read_version(spark, root).count() == 8
    assert read_version(spark, root, 1).count() == 3


def test_layouts_give_equal_counts(spark, tmp_path):
    emp = gen.course_emp(gen.row_numbers(spark, 500))
    for name, size in (("tiny", 10), ("large", 500)):
        write_layout(emp.withColumn("n", F.col("empno") - 7000), "json", str(tmp_path / name), size, "n", 100, drop_number=True)
    dept = gen.course_dept(gen.row_numbers(spark, 100))
    layouts = {name: str(tmp_path / name) for name in ("tiny", "large")}
    assert [r.value for r in compare_layouts(spark, "json", layouts, dept, ["deptno"])] == [500, 500]
    updates = gen.emp_updates(gen.row_numbers(spark, 100), "small")
    run = timed_update("small", emp, updates, ["empno"], {"job": "new_job", "sal": "new_sal", "commission": "new_commission"})
    version = spark.read.parquet(run.value)
    assert version.count() == 500 and version.where("job LIKE 'senior_%'").count() == 100


def test_ingestion_takes_each_file_once(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / x) for x in ("in", "out", "cp"))
    dept = RETAIL["dept"]

    def arrive(first, last):
        gen.retail_dept(gen.row_numbers(spark, last).where(F.col("n") >= first)).coalesce(1).write.mode("append").csv(source, header=True)

    def run():
        ingest_new_files(spark, "csv", source, dept, target, checkpoint)
        return ingested(spark, dept, target).count()

    arrive(1, 10)
    assert run() == 10
    arrive(11, 15)
    assert run() == 15
    assert run() == 15
    (tmp_path / "in" / "late.csv").write_text("deptno,dname,loc\nx,bad,y\n9990,good,z\n")
    assert run() == 16
    rejected = spark.read.parquet(target).where("outcome = 'rejected'").collect()
    assert [r["_error_reason"] for r in rejected] == ["invalid_or_missing_deptno"]

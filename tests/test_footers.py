"""Footers of many files, the gates built on them, and loads that stop before they read."""

import pytest
from pyspark.sql import functions as F

from loomgrain.contracts import contract
from loomgrain.plans.lake import build_bronze_silver, load_batches
from loomgrain.plans.batches import ingest_batch
from loomgrain.plans.layout import scan_facts
from loomgrain.plans.loads import folder_target, load
from loomgrain.sources.footers import as_schema, footers, schema_groups
from loomgrain.sources.gate import SchemaDrift, drift_of_parts, unlike_files

ITEM = contract("item", {"id": "bigint", "name": "string"}, "id")


@pytest.fixture
def parts(spark, tmp_path):
    root = str(tmp_path / "my parts")
    rows = spark.range(10).select("id", F.lit("x").alias("name"), F.current_timestamp().alias("at"))
    rows.repartition(3).write.parquet(f"{root}/a")
    rows.drop("name").withColumn("id", F.col("id").cast("int")).coalesce(1).write.parquet(f"{root}/b")
    rows.limit(0).coalesce(1).write.parquet(f"{root}/c")
    return root


def test_facts_of_every_file(spark, parts, tmp_path):
    (tmp_path / "my parts" / "a" / "cut.parquet").write_bytes(next((tmp_path / "my parts" / "b").glob("part-*.parquet")).read_bytes()[:-40])
    (tmp_path / "my parts" / "a" / "none.parquet").write_bytes(b"PAR1")
    found = {r["path"].rsplit("/", 1)[-1]: r for r in footers(spark, parts, "*.parquet").collect()}
    assert len(found) == 7 and sum(r["rows"] or 0 for r in found.values()) == 20
    bad = {name: r["problem"] for name, r in found.items() if not r["readable"]}
    assert set(bad) == {"cut.parquet", "none.parquet"} and all(bad.values())
    groups = schema_groups(footers(spark, parts, "*.parquet")).orderBy("files").collect()
    assert [(g["files"], g["rows"]) for g in groups] == [(1, 10), (4, 10)]
    assert as_schema(groups[1]["columns"]).simpleString() == "struct<at:timestamp,id:bigint,name:string>"


def test_files_other_writers_made(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    pq.write_table(pa.table({"id": pa.array([1], pa.int64()), "name": ["x"]}), str(tmp_path / "one.parquet"))
    found = footers(spark, str(tmp_path)).first()
    assert as_schema(found["columns"]) == as_schema('[["id", "bigint"], ["name", "string"]]') and found["rows"] == 1


def test_drift_by_part_and_by_file(spark, parts):
    paths = [f"{parts}/{p}" for p in "abc"]
    found = [(path[-1], *line) for path, *line in drift_of_parts(spark, "parquet", paths, ITEM)]
    added = [(p, "at", "added", None, "timestamp") for p in "abc"]
    assert sorted(found, key=str) == sorted([*added, ("b", "id", "changed", "bigint", "int"), ("b", "name", "missing", "string", None)], key=str)
    unlike = unlike_files(spark, paths)
    assert [line[1:] for line in unlike] == [("id", "bigint", "int"), ("name", "string", None)] and "/b/" in unlike[0][0]
    assert unlike_files(spark, f"{parts}/a") == []


def test_loads_refuse_unlike_files(spark, parts, tmp_path):
    with pytest.raises(SchemaDrift):
        load(spark, "parquet", parts, ITEM, folder_target(str(tmp_path / "t")), "s", str(tmp_path / "r"), str(tmp_path / "audit"))
    with pytest.raises(SchemaDrift):
        ingest_batch(spark, "parquet", parts, ITEM, str(tmp_path / "lake"), "b1")
    with pytest.raises(SchemaDrift):
        build_bronze_silver(spark, [("01", "item", parts)], "parquet", "never_bronze", "never_silver")
    with pytest.raises(SchemaDrift):
        load_batches(spark, str(tmp_path), str(tmp_path / "dated"), ["my parts"], "bulk", source_format="parquet")


def test_empty_files_are_input_files(spark, parts):
    assert scan_facts(spark.read.parquet(f"{parts}/a", f"{parts}/c"))["input_files"] == 4

"""Archives, inventories, routing, JDBC options and the working folder."""

import subprocess
import sys
import zipfile

import pytest

from loomgrain.contracts import IO_ROWS, SCENARIOS
from loomgrain.session import object_store_settings, scratch_root
from loomgrain.sinks.jdbc import jdbc_write_options
from loomgrain.sinks.writers import files_for_bytes, planned_files
from loomgrain.sources.files import build_manifest, inventory, read_zip_csv, unsafe_members, unzip_lines
from loomgrain.sources.jdbc import Database, read_database_table
from loomgrain.sources.readers import read_parts
from loomgrain.sources.routing import pick_tables, route, select_scenarios, source_path


def test_zip_members(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "in.zip", "w") as archive:
        archive.writestr("incoming/large.csv", "record_id,product_id,amount,event_date\r\n1,1001,5.5,2026-01-02\r\n2,x,1,2026-01-03\n")
        archive.writestr("../evil.csv", "h\n1,1,1,x\n")
        archive.writestr("/abs.csv", "h\n1,1,1,x\n")
        archive.writestr("a/..b/ok.csv", "h\n3,1003,7.5,2026-01-04\n")
    with pytest.raises(Exception, match="unsafe member"):
        read_zip_csv(spark, str(tmp_path), IO_ROWS).collect()
    got = read_zip_csv(spark, str(tmp_path), IO_ROWS, unsafe="skip").collect()
    assert {(r["record_id"], r["amount"], r["_corrupt_record"]) for r in got} == {
        (1, 5.5, None), (2, 1.0, "2,x,1,2026-01-03"), (3, 7.5, None),
    }
    archives = spark.read.format("binaryFile").load(str(tmp_path))
    flagged = {r["member"] for r in unsafe_members(unzip_lines(archives, lines_per_batch=1)).collect()}
    assert len(flagged) == 2


def test_inventory_by_table_and_date(spark, tmp_path):
    # the root's name occurs again below it
    for table, date, files in (("feed", "2026-01-01", 2), ("feed", "2026-01-02", 1), ("loans", "2026-01-01", 3)):
        folder = tmp_path / "feed" / table / f"batch_date={date}"
        folder.mkdir(parents=True)
        for n in range(files):
            (folder / f"part_{n}.csv").write_text("a\n1\n")
    (tmp_path / "feed" / "plain").mkdir()
    (tmp_path / "feed" / "plain" / "x.csv").write_text("a\n")
    found = {(r["table_name"], r["batch_date"]): (r["files"], r["bytes"]) for r in inventory(spark, str(tmp_path / "feed"), "*.csv").collect()}
    assert found == {
        ("feed", "2026-01-01"): (2, 8), ("feed", "2026-01-02"): (1, 4), ("loans", "2026-01-01"): (3, 12), ("plain", None): (1, 2),
    }


def test_manifest_refuses_files_it_cannot_hash(spark, tmp_path):
    (tmp_path / "a.csv").write_text("abc")
    (tmp_path / "b.csv").write_text("x" * 100)
    listed = {r["path"].rsplit("/", 1)[-1]: r["checksum"] for r in build_manifest(spark, str(tmp_path)).collect()}
    assert listed["a.csv"] == "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad" and listed["b.csv"]
    with pytest.raises(ValueError, match="b.csv"):
        build_manifest(spark, str(tmp_path), checksum_bytes=50)


def test_routing():
    assert select_scenarios("all") == list(SCENARIOS)
    assert select_scenarios(" 1, 05,") == ["01", "05"]
    with pytest.raises(ValueError, match="77"):
        select_scenarios("1,77")
    assert source_path("s3a://lake/", "04", "csv", "emp") == "s3a://lake/04_many_small_csv_emp/04_csv_small_emp/csv/emp"
    assert [table for _, table, _ in route("r", "2", "json")] == ["location", "product", "customer", "sales"]
    with pytest.raises(ValueError):
        source_path("r", "04", "csv", "sales")
    assert pick_tables(["a", "b"], None) == ["a", "b"]
    with pytest.raises(ValueError):
        pick_tables(["a"], ["c"])


def test_no_parts(spark):
    with pytest.raises(FileNotFoundError):
        read_parts(spark, [])


def test_jdbc_options(spark):
    database = Database("jdbc:postgresql://host/db", "me", "secret", "org.postgresql.Driver")
    options = jdbc_write_options(database, "training.sales", 4, 5000, keep_table=True)
    assert options == {
        "url": "jdbc:postgresql://host/db", "user": "me", "password": "secret", "driver": "org.postgresql.Driver",
        "dbtable": "training.sales", "numPartitions": "4", "batchsize": "5000", "isolationLevel": "READ_COMMITTED",
        "truncate": "true",
    }
    assert "truncate" not in jdbc_write_options(Database("u"), "t", 1, 1, keep_table=False)
    with pytest.raises(ValueError):
        jdbc_write_options(database, "t", 0, 1, False)
    with pytest.raises(ValueError):
        read_database_table(spark, database, "t", partition_column="id")


def test_object_store_settings():
    assert object_store_settings("http://store:9000", "a", "b")["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"
    assert object_store_settings("https://store", "a", "b")["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "true"


def test_file_counts():
    assert files_for_bytes(0) == 1 and files_for_bytes(1000, 300) == 4
    assert planned_files(0, 10, 5) == 0
    with pytest.raises(ValueError):
        planned_files(10, 0, 5)


def test_cluster_needs_a_shared_folder(spark):
    class Context:
        applicationId = "app-cluster"
        master = "spark://host:7077"

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(name, default):
                return Session.shared if name == "spark.checkpoint.dir" else default

        shared = None

    with pytest.raises(RuntimeError):
        scratch_root(Session())
    Session.shared = "hdfs:///work/"
    assert scratch_root(Session()).startswith("hdfs:///work/loomgrain-app-cluster-")


def test_entry_imports_without_a_session():
    code = "import __spark_entry__ as e; q = e.queries(); assert set(e.oracle_sql()) <= set(q) and len(q) > 180"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=__file__.rsplit("/tests/", 1)[0])

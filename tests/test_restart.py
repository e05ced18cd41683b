"""A named load that died at any step and is run again leaves what one run leaves."""

import pytest

from loomgrain.contracts import AUDIT_SCHEMA, contract
from loomgrain.plans import loads
from loomgrain.plans.loads import folder_target, load
from loomgrain.sinks.writers import write_table

ITEM = contract("item", {"id": "bigint", "amount": "double"}, "id")


def once(spark, tmp_path, source, run_id):
    target = folder_target(str(tmp_path / "target"), run_id=run_id)
    return load(spark, "csv", source, ITEM, target, "daily", str(tmp_path / "rejects"), str(tmp_path / "audit"), run_id)


def left(spark, tmp_path):
    found = spark.read.parquet(str(tmp_path / "target" / "item")), spark.read.parquet(str(tmp_path / "rejects" / "daily" / "item"))
    audit = spark.read.schema(AUDIT_SCHEMA).parquet(str(tmp_path / "audit"))
    return (
        sorted((str(r["run_id"]), r["id"]) for r in found[0].collect()),
        sorted((str(r["run_id"]), r["_raw_payload"]) for r in found[1].collect()),
        sorted((r["scenario"], r["target_table"], r["accepted_rows"], r["rejected_rows"]) for r in audit.collect()),
    )


@pytest.mark.parametrize("step", ["write_rejects", "write_table", "write_audit"])
@pytest.mark.parametrize("when", ["before", "after"])
def test_a_load_that_died_is_run_again(spark, tmp_path, monkeypatch, step, when):
    source = str(tmp_path / "source")
    write_table(spark.createDataFrame([("1", "2"), ("2", "x"), ("3", "4")], "id string, amount string"), "csv", source)
    once(spark, tmp_path, source, "monday")
    original = getattr(loads, step)

    def dying(*args):
        if when == "after":
            original(*args)
        raise RuntimeError("killed")

    with monkeypatch.context() as patched:
        patched.setattr(loads, step, dying)
        with pytest.raises(RuntimeError):
            once(spark, tmp_path, source, "tuesday")
    for _ in range(2):
        once(spark, tmp_path, source, "tuesday")
    rows, rejects, audit = left(spark, tmp_path)
    assert rows == [(run, i) for run in ("monday", "tuesday") for i in (1, 3)]
    assert [run for run, _ in rejects] == ["monday", "tuesday"]
    assert audit == [("daily", "item", 2, 1)] * 2

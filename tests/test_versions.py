"""Versions as lists of files: what a change rewrites, what it carries over, and what a failed one leaves."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from loomgrain.contracts import contract
from loomgrain.operators.updates import change_counts, merge_changes
from loomgrain.plans import loads
from loomgrain.plans.changes import apply_latest, matched_rows
from loomgrain.plans.lake import compact_version
from loomgrain.plans.publish import NothingPublished, current_version, names_of, publish, read_version, version_files

KEY, CHANGED = ["id"], ["amount"]


def changes(spark, *lines):
    return spark.createDataFrame(list(lines), "operation string, id long, amount long")


@pytest.fixture
def root(spark, tmp_path):
    path = str(tmp_path / "data set")
    publish(spark.range(100).select("id", (F.col("id") * 10).alias("amount")).repartitionByRange(10, "id"), path, 1)
    return path


def test_only_files_with_changed_rows_are_rewritten(spark, root):
    before = names_of(version_files(spark, root))
    counts = apply_latest(changes(spark, ("U", 5, 7), ("D", 6, None), ("D", 99, None), ("U", 500, 1)), root, KEY, CHANGED)
    assert counts == {"staged": 4, "updated": 1, "deleted": 2, "unmatched": 1, "rewritten_files": 2, "carried_files": 8, "version": 2}
    after = names_of(version_files(spark, root))
    assert len(set(before) & set(after)) == 8
    assert version_files(spark, root).agg(F.sum("rows")).first()[0] == 98
    expected = {i: i * 10 for i in range(100)} | {5: 7}
    del expected[6], expected[99]
    assert dict(map(tuple, read_version(spark, root).collect())) == expected
    # the earlier version is what it was
    assert read_version(spark, root, 1).count() == 100


def test_several_rounds_equal_the_plain_merge(spark, root):
    plain = read_version(spark, root)
    for n in range(3):
        latest = changes(spark, *[("D" if i % 5 == 0 else "U", i, i + n) for i in range(n * 7, 100, 11)])
        expected = change_counts(plain, latest, KEY).first().asDict()
        plain = merge_changes(plain, latest, KEY, CHANGED)
        counts = apply_latest(latest, root, KEY, CHANGED)
        assert {k: counts[k] for k in expected} == expected
    assert rows(read_version(spark, root)) == rows(plain)


def test_changes_applied_anew_start_from_a_named_version(spark, root):
    apply_latest(changes(spark, ("D", 5, None)), root, KEY, CHANGED)
    again = apply_latest(changes(spark, ("U", 5, 1)), root, KEY, CHANGED, onto=1)
    assert again["version"] == 3 and read_version(spark, root).count() == 100
    assert read_version(spark, root, 2).count() == 99


def test_changes_that_meet_nothing_publish_nothing(spark, root):
    assert apply_latest(changes(spark, ("U", 1000, 1)), root, KEY, CHANGED)["rewritten_files"] == 0
    assert apply_latest(changes(spark).limit(0), root, KEY, CHANGED)["staged"] == 0
    assert current_version(spark, root) == 1


def test_all_rows_deleted_and_repeated_keys(spark, tmp_path):
    root = str(tmp_path / "twice")
    publish(spark.createDataFrame([(1, 1), (1, 2), (2, 3)], "id long, amount long").coalesce(1), root, 1)
    counts = apply_latest(changes(spark, ("U", 1, 9)), root, KEY, CHANGED)
    assert (counts["updated"], counts["unmatched"]) == (2, 0)
    apply_latest(changes(spark, ("D", 1, None), ("D", 2, None)), root, KEY, CHANGED)
    assert read_version(spark, root).count() == 0 and read_version(spark, root).columns == ["id", "amount"]


def test_a_run_that_died_before_publishing_is_run_again(spark, root, monkeypatch):
    from loomgrain.plans import changes as plan

    latest = changes(spark, ("U", 5, 7))
    with monkeypatch.context() as patched:
        patched.setattr(plan, "make_current", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            apply_latest(latest, root, KEY, CHANGED)
    assert current_version(spark, root) == 1 and read_version(spark, root).count() == 100
    apply_latest(latest, root, KEY, CHANGED)
    found = read_version(spark, root)
    assert found.count() == 100 and found.where("id = 5").first()["amount"] == 7


def test_the_base_is_joined_once_on_its_key_alone(spark, root, monkeypatch):
    from loomgrain.plans import changes as plan

    joined = []

    def keep(base, latest, key, operation="operation"):
        found = matched_rows(base, latest, key, operation)
        joined.append(found._jdf.queryExecution().executedPlan().toString())
        return found

    monkeypatch.setattr(plan, "matched_rows", keep)
    apply_latest(changes(spark, ("U", 5, 7)), root, KEY, CHANGED)
    assert len(joined) == 1 and "ReadSchema: struct<id:bigint>" in joined[0]


def test_nothing_published(spark, tmp_path):
    with pytest.raises(NothingPublished):
        read_version(spark, str(tmp_path / "none"))


def test_the_observation_gives_way_to_what_was_written(spark, tmp_path, monkeypatch):
    item = contract("item", {"id": "bigint"}, "id")
    for name in "ab":
        spark.range(3).select(F.col("id").cast("string")).coalesce(1).write.csv(str(tmp_path / "s" / name), header=True)
    path = [str(tmp_path / "s" / name) for name in "ab"]
    raw = loads.read_by_contract(spark, "csv", path, item)
    found = loads.stage(loads.validate_contract(raw, item), item)
    assert found.accepted_rows + found.rejected_rows == 6 and found.source_files == 2

    class Doubled(loads.Observation):
        @property
        def get(self):
            return {"rows": 12, "files": [1, 2, 3]}

    monkeypatch.setattr(loads, "Observation", Doubled)
    again = loads.stage(loads.validate_contract(raw, item), item)
    assert (again.accepted_rows, again.rejected_rows, again.source_files) == (found.accepted_rows, found.rejected_rows, 2)


def test_compaction_merges_small_files_only(spark, tmp_path):
    root = str(tmp_path / "bins")
    part = F.when(F.col("id") < 8000, 0).otherwise((F.col("id") - 8000) / 100 + 1).cast("int")
    publish(spark.range(9000).select("id", F.rand(3).alias("amount")).repartitionById(12, part), root, 1)
    before = {r["file"]: r["rows"] for r in version_files(spark, root).collect()}
    found = compact_version(spark, root, 60_000)
    assert found["kept"] == 1 and found["merged"] == 10 and found["written"] < 3
    after = {r["file"]: r["rows"] for r in version_files(spark, root).collect()}
    assert max(before, key=before.get) in after and len(after) == 1 + found["written"]
    assert rows(read_version(spark, root)) == rows(read_version(spark, root, 1))
    # nothing is left to merge, and changes go on from the compacted version
    assert compact_version(spark, root, 60_000)["merged"] == 0 and current_version(spark, root) == 2
    counts = apply_latest(spark.createDataFrame([("D", 8500, 0.0)], "operation string, id long, amount double"), root, KEY, CHANGED)
    assert counts["deleted"] == 1 and read_version(spark, root).count() == 8999

"""The log of attempts: a batch is whole or not there, whichever step a replay dies at."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from loomgrain.contracts import contract
from loomgrain.plans import batches
from loomgrain.plans.batches import RepeatedBatch, committed, current_attempts, ingest_batch, log, states, vacuum
from loomgrain.sinks.writers import write_table

ITEM = contract("item", {"id": "bigint", "amount": "double"}, "id")


def source(spark, path, rows):
    write_table(spark.createDataFrame(rows, "id string, amount string"), "csv", path, mode="overwrite")
    return path


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_a_batch_is_refused_twice_and_replayed_whole(spark, tmp_path):
    root, path = str(tmp_path / "lake"), source(spark, str(tmp_path / "s"), [("1", "2.5"), ("2", "x"), ("3", "1")])
    ingest_batch(spark, "csv", path, ITEM, root, "b1")
    with pytest.raises(RepeatedBatch):
        ingest_batch(spark, "csv", path, ITEM, root, "b1")
    source(spark, path, [("1", "2.5"), ("7", "8")])
    ingest_batch(spark, "csv", path, ITEM, root, "b1", replay=True)
    ingest_batch(spark, "csv", path, ITEM, root, "2026-01-03")
    assert ids(committed(spark, root)) == [1, 1, 7, 7]
    assert committed(spark, root, "rejects").count() == 0
    assert {r["batch_id"] for r in committed(spark, root, "metrics").collect()} == {"b1", "2026-01-03"}


@pytest.mark.parametrize("step", ["discovered", "validated", "rows", "rejects", "metrics", "staged", "committed"])
def test_a_replay_that_dies_at_any_step_changes_nothing(spark, tmp_path, monkeypatch, step):
    root, path = str(tmp_path / "lake"), source(spark, str(tmp_path / "s"), [("1", "2.5"), ("2", "x"), ("3", "1")])
    ingest_batch(spark, "csv", path, ITEM, root, "b1")
    source(spark, path, [("9", "9"), ("x", "")])
    reached, folder = batches.Attempt.reached, batches.Attempt.folder

    def dying(self, state, detail=None):
        if state == step:
            raise RuntimeError("killed")
        reached(self, state, detail)

    def unwritable(self, kind):
        if kind == step:
            raise RuntimeError("killed")
        return folder(self, kind)

    with monkeypatch.context() as patched:
        patched.setattr(batches.Attempt, "reached", dying)
        patched.setattr(batches.Attempt, "folder", unwritable)
        with pytest.raises(RuntimeError):
            ingest_batch(spark, "csv", path, ITEM, root, "b1", replay=True)
    assert ids(committed(spark, root)) == [1, 3] and committed(spark, root, "rejects").count() == 1
    assert committed(spark, root, "metrics").first()["accepted_rows"] == 2
    assert states(spark, root).first()["state"] == "failed"
    # the same replay again gives what one run gives
    ingest_batch(spark, "csv", path, ITEM, root, "b1", replay=True)
    assert ids(committed(spark, root)) == [9] and committed(spark, root, "rejects").count() == 1
    assert states(spark, root).first()["state"] == "committed"


def test_a_driver_that_dies_without_a_word(spark, tmp_path, monkeypatch):
    root, path = str(tmp_path / "lake"), source(spark, str(tmp_path / "s"), [("1", "2.5")])
    reached = batches.Attempt.reached

    def gone(self, state, detail=None):
        if state in ("staged", "failed"):
            raise KeyboardInterrupt
        reached(self, state, detail)

    with monkeypatch.context() as patched:
        patched.setattr(batches.Attempt, "reached", gone)
        with pytest.raises(KeyboardInterrupt):
            ingest_batch(spark, "csv", path, ITEM, root, "b1")
    with pytest.raises(FileNotFoundError):
        committed(spark, root)
    # never committed: no replay is needed to run it again
    ingest_batch(spark, "csv", path, ITEM, root, "b1")
    assert ids(committed(spark, root)) == [1]


def test_of_two_replays_at_once_one_is_current(spark, tmp_path):
    root = str(tmp_path / "lake")
    now = dt.datetime.now(dt.timezone.utc)
    for number, name, value in ((1, "a", 1), (2, "c", 2), (2, "b", 3)):
        attempt = batches.Attempt(spark, root, "b1", number, name)
        spark.createDataFrame([(value,)], "id long").write.parquet(attempt.folder("rows"))
        attempt.reached("committed")
    assert ids(committed(spark, root)) == [2]
    assert [r["attempt"] for r in current_attempts(spark, root).collect()] == ["c"]
    assert vacuum(spark, root, dt.timedelta(days=1)) == 0
    assert vacuum(spark, root, dt.timedelta(seconds=-5)) == 2
    assert ids(spark.read.parquet(f"{root}/rows")) == [2] and ids(committed(spark, root)) == [2]
    assert log(spark, root).where(F.col("at") >= now).count() == 3


def test_only_folders_of_current_attempts_are_read(spark, tmp_path):
    root, path = str(tmp_path / "lake"), source(spark, str(tmp_path / "s"), [("1", "2.5")])
    for n in range(3):
        ingest_batch(spark, "csv", path, ITEM, root, "b1", replay=n > 0)
    plan = committed(spark, root)._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()


def test_a_stream_commits_each_batch_once(spark, tmp_path, monkeypatch):
    from loomgrain.streaming.ingest import batch_sink, ingest_stream

    root, path = str(tmp_path / "lake"), str(tmp_path / "arriving")

    def arrive(*rows):
        write_table(spark.createDataFrame(list(rows), "id string, amount string"), "csv", path, mode="append")
        ingest_stream(spark, "csv", path, ITEM, root, str(tmp_path / "checkpoint"))

    arrive(("1", "2"), ("2", "x"))
    reached = batches.Attempt.reached
    with monkeypatch.context() as patched:
        # the batch's rows are written, but the driver dies before the commit
        patched.setattr(batches.Attempt, "reached", lambda self, state, detail=None: 1 / 0 if state == "committed" else reached(self, state, detail))
        with pytest.raises(Exception):
            arrive(("3", "4"))
    assert ids(committed(spark, root)) == [1]
    arrive(("5", "6"))
    assert ids(committed(spark, root)) == [1, 3, 5] and committed(spark, root, "rejects").count() == 1
    batch_sink(root, ITEM, "stream")(spark.range(1), 0)
    assert ids(committed(spark, root)) == [1, 3, 5]
    assert {r["batch_id"][:7] for r in committed(spark, root, "metrics").collect()} == {"stream-"}

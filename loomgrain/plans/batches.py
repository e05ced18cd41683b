"""Batches with an identity and a log of attempts: a replay never touches what an earlier attempt committed.

Each attempt writes rows, rejects and metrics to folders of its own. The log
holds a line per step of an attempt; the line ``committed`` makes the attempt
its batch's current one, in a single append, and readers follow the log. So an
attempt that fails or dies at any step leaves the batch as it was: without rows
if it never was committed, else with the rows of the last commit. What such
attempts left on disk is removed by ``vacuum``.

Attempts are numbered along the log. Two drivers that replay the same batch at
the same time write different folders; the later number is current, and of
equal numbers the one with the greater id, for every reader alike.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgrain.contracts import Contract
from loomgrain.operators.quality import validate_contract
from loomgrain.plans.loads import Outcome, stage
from loomgrain.session import delete_path, path_exists
from loomgrain.sources.files import list_files
from loomgrain.sources.gate import refuse_unlike_files
from loomgrain.sources.readers import read_by_contract

# The states of a batch, in the order in which it passes them.
STATES = ("discovered", "validated", "staged", "committed", "failed")
LOG_SCHEMA = "batch_id string, number long, attempt string, state string, detail string, at timestamp"
KINDS = ("rows", "rejects", "metrics")


class RepeatedBatch(ValueError):
    """The batch is committed already and no replay was asked for."""


@dataclass(frozen=True)
class Attempt:
    """One try at a batch: where it writes, and its lines in the log."""

    spark: SparkSession
    root: str
    batch_id: str
    number: int
    name: str

    def folder(self, kind: str) -> str:
        return f"{self.root}/{kind}/batch_id={self.batch_id}/attempt={self.name}"

    def reached(self, state: str, detail: str | None = None) -> None:
        if state not in STATES:
            raise ValueError(f"unknown state: {state}")
        line = (self.batch_id, self.number, self.name, state, detail, datetime.now(timezone.utc))
        # one row in one file: the append is there as a whole or not at all
        self.spark.createDataFrame([line], LOG_SCHEMA).coalesce(1).write.mode("append").parquet(f"{self.root}/_log")


def log(spark: SparkSession, root: str) -> DataFrame:
    """Every step of every attempt."""
    if not path_exists(spark, f"{root}/_log"):
        return spark.createDataFrame([], LOG_SCHEMA)
    return spark.read.schema(LOG_SCHEMA).parquet(f"{root}/_log")


def states(spark: SparkSession, root: str) -> DataFrame:
    """batch_id, attempt, state, detail, at: how far the last attempt of each batch came."""
    step = F.array_position(F.array(*[F.lit(s) for s in STATES]), F.col("state"))
    last = F.max_by(F.struct("attempt", "state", "detail", "at"), F.struct("number", "attempt", step))
    return log(spark, root).groupBy("batch_id").agg(last.alias("last")).select("batch_id", "last.*")


def current_attempts(spark: SparkSession, root: str) -> DataFrame:
    """batch_id, attempt, at: the attempt whose rows each batch has."""
    done = log(spark, root).where("state = 'committed'")
    last = F.max_by(F.struct("attempt", "at"), F.struct("number", "attempt"))
    return done.groupBy("batch_id").agg(last.alias("last")).select("batch_id", "last.*")


def start_attempt(spark: SparkSession, root: str, batch_id: str) -> Attempt:
    earlier = log(spark, root).where(F.col("batch_id") == batch_id).agg(F.max("number").alias("number")).first()["number"]
    return Attempt(spark, root, batch_id, (earlier or 0) + 1, uuid.uuid4().hex)


def is_committed(spark: SparkSession, root: str, batch_id: str) -> bool:
    return not current_attempts(spark, root).where(F.col("batch_id") == batch_id).isEmpty()


def ingest_batch(
    spark: SparkSession, fmt: str, path: str, contract: Contract, root: str, batch_id: str, replay: bool = False, **read_options
) -> Outcome:
    """Validate ``path`` and commit its rows, rejects and metrics as batch ``batch_id`` below ``root``.

    A batch that is committed is refused unless it is to be replayed. Until the
    replay commits, readers see what the earlier attempt committed.
    """
    if not replay and is_committed(spark, root, batch_id):
        raise RepeatedBatch(f"batch {batch_id} is committed")

    def validated(attempt: Attempt) -> tuple[DataFrame, dict]:
        # bytes and files are facts of the listing; a file without valid rows counts as well
        facts = list_files(spark, path).agg(
            F.count(F.lit(1)).alias("source_files"), F.coalesce(F.sum("length"), F.lit(0)).alias("source_bytes")
        )
        found = facts.first().asDict()
        attempt.reached("discovered", f"{found['source_files']} files")
        refuse_unlike_files(spark, fmt, path)
        return validate_contract(read_by_contract(spark, fmt, path, contract, **read_options), contract), found

    return run_attempt(start_attempt(spark, root, batch_id), contract, validated)


def ingest_rows(validated: DataFrame, contract: Contract, root: str, batch_id: str) -> Outcome | None:
    """Commit rows that are validated already as batch ``batch_id``, once: a batch that is committed adds nothing."""
    spark = validated.sparkSession
    if is_committed(spark, root, batch_id):
        return None
    return run_attempt(start_attempt(spark, root, batch_id), contract, lambda attempt: (validated, {}))


def run_attempt(attempt: Attempt, contract: Contract, validated: Callable[[Attempt], tuple[DataFrame, dict]]) -> Outcome:
    """Write rows, rejects and metrics of an attempt, then commit it; a failure is logged and raised."""
    spark = attempt.spark
    try:
        rows, facts = validated(attempt)
        outcome = stage(rows, contract)
        attempt.reached("validated", f"{outcome.accepted_rows} accepted, {outcome.rejected_rows} rejected")
        stamp = {"ingested_at": F.lit(datetime.now(timezone.utc))}
        for kind, part in (("rows", outcome.accepted), ("rejects", outcome.rejected)):
            part.withColumns(stamp).write.parquet(attempt.folder(kind))
        files = facts.get("source_files", outcome.source_files)
        metrics = {
            "source_files": files,
            "source_bytes": facts.get("source_bytes"),
            "read_files": outcome.source_files,
            # files of the listing no row came from
            "skipped_files": files - outcome.source_files,
            "accepted_rows": outcome.accepted_rows,
            "rejected_rows": outcome.rejected_rows,
            "written_files": list_files(spark, attempt.folder("rows"), "*.parquet").count(),
        }
        line = spark.range(1).select(*[F.lit(value).cast("long").alias(name) for name, value in metrics.items()])
        line.withColumns(stamp).write.parquet(attempt.folder("metrics"))
        attempt.reached("staged")
        attempt.reached("committed")
    except Exception as problem:
        attempt.reached("failed", str(problem)[:500])
        raise
    return outcome


def committed(spark: SparkSession, root: str, kind: str = "rows") -> DataFrame:
    """Rows, rejects or metrics of each batch's current attempt, with their ``batch_id``.

    The log is small and its keys are the folders, so folders of other attempts
    are pruned and never listed file by file for reading. Without any commit
    there is nothing to tell the columns from: that is an error.
    """
    if kind not in KINDS:
        raise ValueError(f"unknown kind: {kind}")
    current = current_attempts(spark, root).select(F.col("batch_id").alias("_batch"), F.col("attempt").alias("_attempt"))
    if current.isEmpty():
        raise FileNotFoundError(f"no batch of {root} is committed")
    found = spark.read.option("basePath", f"{root}/{kind}").parquet(f"{root}/{kind}")
    # the partition columns may have been read as numbers or dates
    keys = found.withColumns({name: F.col(name).cast("string") for name in ("batch_id", "attempt")})
    same = (F.col("batch_id") == F.col("_batch")) & (F.col("attempt") == F.col("_attempt"))
    return keys.join(F.broadcast(current), same, "left_semi").drop("attempt")


def vacuum(spark: SparkSession, root: str, older_than: timedelta = timedelta(days=7)) -> int:
    """Delete the folders of attempts that are not current and began before ``older_than``; how many there were.

    The grace must be longer than any attempt or reader runs.
    """
    began = log(spark, root).groupBy("batch_id", "attempt").agg(F.min("at").alias("began"))
    gone = began.join(current_attempts(spark, root).select("batch_id", "attempt"), ["batch_id", "attempt"], "left_anti")
    # one narrow row per attempt that was replayed or failed
    old = gone.where(F.col("began") < F.lit(datetime.now(timezone.utc) - older_than)).collect()
    for row in old:
        for kind in KINDS:
            delete_path(spark, Attempt(spark, root, row["batch_id"], 0, row["attempt"]).folder(kind))
    return len(old)

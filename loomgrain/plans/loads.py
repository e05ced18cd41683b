"""Validated loads: read by contract, split, quarantine, write, audit, reconcile."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone
from decimal import Decimal
from time import perf_counter

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from loomgrain.contracts import LOAD_ORDER, RETAIL, Contract
from loomgrain.operators.quality import REASON, REJECT_COLUMNS, validate_contract
from loomgrain.session import delete_path, fresh_path
from loomgrain.sinks.jdbc import write_database_table
from loomgrain.sinks.writers import write_audit, write_rejects, write_table
from loomgrain.sources.gate import refuse_unlike_files
from loomgrain.sources.jdbc import Database
from loomgrain.sources.readers import read_by_contract

FACT_WRITERS = 4
DIMENSION_WRITERS = 2

Target = Callable[[DataFrame, Contract, int], None]


@dataclass(frozen=True)
class Outcome:
    accepted: DataFrame
    rejected: DataFrame
    accepted_rows: int
    rejected_rows: int
    source_files: int


def stage(validated: DataFrame, contract: Contract) -> Outcome:
    """Write validated rows once, accepted and rejected apart, with the facts of the load.

    The source is read a single time and nothing is cached. Rows are counted
    from the footers of what was written. The files that rows came from are
    observed while writing, as hashes; a task that ran twice may show in the
    observation, so it counts only where it has seen as many rows as were
    written, else the files are counted in the staged copy.
    """
    spark = validated.sparkSession
    path = fresh_path(spark, f"stage-{contract.name}")
    outcome = F.when(F.col(REASON).isNull(), "accepted").otherwise("rejected")
    kept = [*contract.names, *REJECT_COLUMNS]
    staged = validated.select(*kept, outcome.alias("_outcome"))
    seen = Observation()
    watched = staged.observe(seen, F.count(F.lit(1)).alias("rows"), F.collect_set(F.xxhash64("_source_file")).alias("files"))
    watched.write.partitionBy("_outcome").parquet(path)
    rows = spark.read.schema(staged.schema).parquet(path)
    # the outcome is the folder's name: no column is read
    counts = {r["_outcome"]: r["count"] for r in rows.groupBy("_outcome").count().collect()}
    facts = seen.get
    if facts["rows"] == sum(counts.values()):
        files = len(facts["files"])
    else:
        files = rows.select("_source_file").distinct().count()
    return Outcome(
        accepted=rows.where(F.col("_outcome") == "accepted").select(*contract.names),
        rejected=rows.where(F.col("_outcome") == "rejected").select(*REJECT_COLUMNS),
        accepted_rows=counts.get("accepted", 0),
        rejected_rows=counts.get("rejected", 0),
        source_files=files,
    )


def seconds(started: float) -> Decimal:
    return Decimal(str(round(perf_counter() - started, 3)))


def load(
    spark: SparkSession,
    fmt: str,
    path: str,
    contract: Contract,
    target: Target,
    scenario: str,
    reject_root: str,
    audit_path: str,
    run_id: str | None = None,
    **read_options,
) -> Outcome:
    """One table: accepted rows to ``target``, rejects to quarantine, one audit row.

    Parquet files whose columns differ are refused before anything is read. A
    load with a ``run_id`` may be run again after it died at any step: rejects
    and audit have folders of the run's name, which are written whole, and so
    should the target (``folder_target`` with the same ``run_id``). Runs with
    and without a name do not share an audit path.
    """
    refuse_unlike_files(spark, fmt, path)
    started_at = datetime.now(timezone.utc).replace(tzinfo=None)
    clock = perf_counter()
    outcome = stage(validate_contract(read_by_contract(spark, fmt, path, contract, **read_options), contract), contract)
    read_seconds = seconds(clock)
    rejects = f"{reject_root}/{scenario}/{contract.name}"
    if run_id is not None:
        delete_path(spark, in_run(rejects, run_id))
    if outcome.rejected_rows:
        write_rejects(outcome.rejected, in_run(rejects, run_id))
    clock = perf_counter()
    target(outcome.accepted, contract, FACT_WRITERS if contract.is_fact else DIMENSION_WRITERS)
    write_audit(
        spark,
        in_run(audit_path, None if run_id is None else f"{run_id}/load={scenario}.{contract.name}"),
        {
            "scenario": scenario,
            "target_table": contract.name,
            "source_format": fmt,
            "source_path": path,
            "source_files": outcome.source_files,
            "accepted_rows": outcome.accepted_rows,
            "rejected_rows": outcome.rejected_rows,
            "read_seconds": read_seconds,
            "write_seconds": seconds(clock),
            "started_at": started_at,
            "completed_at": datetime.now(timezone.utc).replace(tzinfo=None),
        },
        "append" if run_id is None else "overwrite",
    )
    return outcome


def in_run(path: str, run_id: str | None) -> str:
    return path if run_id is None else f"{path}/run_id={run_id}"


def database_target(database: Database, schema: str, mode: str = "append", batch_rows: int = 10_000) -> Target:
    """Target that writes to the database table of the contract's name."""

    def write(accepted: DataFrame, contract: Contract, writers: int) -> None:
        write_database_table(
            accepted, database, f"{schema}.{contract.name}", contract.names, mode, writers, batch_rows
        )

    return write


def folder_target(root: str, fmt: str = "parquet", mode: str = "append", run_id: str | None = None) -> Target:
    """Target that writes to ``<root>/<table>``, or to the run's own folder there, whole; files need no bound on their writers."""
    if run_id is not None:
        return lambda accepted, contract, writers: write_table(accepted, fmt, in_run(f"{root}/{contract.name}", run_id), "overwrite")
    return lambda accepted, contract, writers: write_table(accepted, fmt, f"{root}/{contract.name}", mode)


def in_load_order(tables: Iterable[str], order: Sequence[str] = LOAD_ORDER) -> list[str]:
    """Referenced tables before the tables that point to them."""
    wanted = list(tables)
    unknown = sorted(set(wanted) - set(order))
    if unknown:
        raise ValueError(f"no load order for {', '.join(unknown)}")
    return sorted(wanted, key=list(order).index)


def load_many(
    spark: SparkSession,
    fmt: str,
    paths: dict[str, str],
    target: Target,
    scenario: str,
    reject_root: str,
    audit_path: str,
    contracts: dict[str, Contract] = RETAIL,
    order: Sequence[str] = LOAD_ORDER,
    run_id: str | None = None,
) -> dict[str, Outcome]:
    """Several tables in dependency order."""
    return {
        table: load(spark, fmt, paths[table], contracts[table], target, scenario, reject_root, audit_path, run_id)
        for table in in_load_order(paths, order)
    }

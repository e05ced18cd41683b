"""Writes over JDBC with a bounded number of connections."""

from __future__ import annotations

from pyspark.sql import DataFrame

from loomgrain.sources.jdbc import Database

ISOLATION = "READ_COMMITTED"


def jdbc_write_options(
    database: Database, table: str, writers: int, batch_rows: int, keep_table: bool
) -> dict[str, str]:
    if writers <= 0 or batch_rows <= 0:
        raise ValueError("writers and batch_rows must be greater than zero")
    options = database.options(
        dbtable=table, numPartitions=writers, batchsize=batch_rows, isolationLevel=ISOLATION
    )
    if keep_table:
        # empty the table and keep its definition, keys and grants
        options["truncate"] = "true"
    return options


def write_database_table(
    df: DataFrame,
    database: Database,
    table: str,
    columns: list[str],
    mode: str = "append",
    writers: int = 4,
    batch_rows: int = 10_000,
) -> None:
    """Write ``columns`` over ``writers`` connections, however many files the source had.

    Each task commits by itself, so a failed job can leave part of its rows:
    overwrite (or load a staging table) when a load must be repeatable.
    """
    options = jdbc_write_options(database, table, writers, batch_rows, mode == "overwrite")
    df.select(*columns).repartition(writers).write.format("jdbc").options(**options).mode(mode).save()

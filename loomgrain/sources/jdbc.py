"""Reads over JDBC."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Database:
    """Connection options; credentials come from the caller and have no default."""

    url: str
    user: str | None = None
    password: str | None = None
    driver: str | None = None

    def options(self, **more) -> dict[str, str]:
        given = {"url": self.url, "user": self.user, "password": self.password, "driver": self.driver, **more}
        return {name: str(value) for name, value in given.items() if value is not None}


def read_query(spark: SparkSession, database: Database, query: str) -> DataFrame:
    return spark.read.format("jdbc").options(**database.options(query=query)).load()


def read_database_table(
    spark: SparkSession,
    database: Database,
    table: str,
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    readers: int | None = None,
    fetch_rows: int = 10_000,
) -> DataFrame:
    """Read a table; with a partition column, over ``readers`` connections at once.

    Bounds only set the stride: rows outside them go to the first and last reader.
    """
    options = database.options(dbtable=table, fetchsize=fetch_rows)
    if partition_column:
        if not bounds or not readers:
            raise ValueError("a partitioned read needs bounds and readers")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(readers),
        }
    return spark.read.format("jdbc").options(**options).load()

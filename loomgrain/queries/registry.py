"""Named queries with the SQL that must give the same rows."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from loomgrain.session import fresh_path, scratch_root
from loomgrain.sinks.writers import write_table

Build = Callable[["Tables"], DataFrame]

_staged: dict[tuple, str] = {}


@dataclass(frozen=True)
class Query:
    key: str
    build: Build
    sql: str | None


QUERIES: dict[str, Query] = {}


def own_name(spark: SparkSession, label: str) -> str:
    """A catalogue name no other application uses, so that two runs never drop each other's tables."""
    return f"loomgrain_{label}_" + re.sub("[^a-z0-9]+", "_", spark.sparkContext.applicationId.lower())


class Tables:
    """The Parquet tables of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getitem__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def view(self, *names: str) -> None:
        for name in names:
            self[name].createOrReplaceTempView(name)

    def staged(self, label: str, write: Callable[[str], None]) -> str:
        """Path of a folder that ``write`` fills once per session and data folder."""
        slot = (scratch_root(self.spark), self.folder, label)
        if slot not in _staged:
            path = fresh_path(self.spark, label)
            write(path)
            _staged[slot] = path
        return _staged[slot]

    def copy(self, name: str, fmt: str) -> str:
        """The whole table written as csv, json or parquet."""
        return self.staged(f"{name}-{fmt}", lambda path: write_table(self[name], fmt, path))


def query(key: str, sql: str | None = None) -> Callable[[Build], Build]:
    def register(build: Build) -> Build:
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")
        QUERIES[key] = Query(key, build, sql)
        return build

    return register


def runner(build: Build) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: build(Tables(spark, folder))

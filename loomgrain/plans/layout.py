"""Timed comparison of file layouts and of small with large update rewrites."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from time import perf_counter
from typing import Generic, TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgrain.operators.skew import broadcast_if_small
from loomgrain.operators.updates import overlay
from loomgrain.session import fresh_path
from loomgrain.sinks.writers import write_table
from loomgrain.sources.readers import read_table

Value = TypeVar("Value")


@dataclass(frozen=True)
class Timed(Generic[Value]):
    label: str
    seconds: float
    value: Value


def timed(label: str, action: Callable[[], Value]) -> Timed[Value]:
    started = perf_counter()
    value = action()
    return Timed(label, perf_counter() - started, value)


def scan_facts(df: DataFrame) -> dict[str, int]:
    """Input files, empty ones too, from the listing, and scan partitions of a relation over files; no row is read."""
    return {"input_files": len(df._jdf.inputFiles()), "partitions": df.rdd.getNumPartitions()}


def timed_lookup_join(
    spark: SparkSession, label: str, fact: Callable[[], DataFrame], dimension: Callable[[], DataFrame], on: list[str]
) -> Timed[int]:
    """Rows of fact joined to dimension; both are read anew, and what the user has cached stays."""
    return timed(label, lambda: fact().join(broadcast_if_small(dimension()), on).count())


def compare_layouts(
    spark: SparkSession, fmt: str, layouts: dict[str, str], dimension: DataFrame, on: list[str], schema=None
) -> list[Timed[int]]:
    """The same lookup join over each layout; differing row counts are an error."""
    results = [
        timed_lookup_join(spark, name, lambda p=path: read_table(spark, fmt, p, schema=schema), lambda: dimension, on)
        for name, path in layouts.items()
    ]
    if len({r.value for r in results}) > 1:
        raise ValueError(f"layouts disagree: {[(r.label, r.value) for r in results]}")
    return results


def timed_update(
    label: str, base: DataFrame, updates: DataFrame, key: list[str], assignments: dict[str, str], fmt: str = "parquet"
) -> Timed[str]:
    """Overlay the updates and write a full new version; the value is its path."""
    path = fresh_path(base.sparkSession, f"version-{label}")

    def rewrite() -> str:
        write_table(overlay(base, updates, key, assignments), fmt, path)
        return path

    return timed(label, rewrite)

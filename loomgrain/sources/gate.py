"""Schemas are compared before parts are combined, so that no column is lost or cast in silence."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgrain.contracts import Contract
from loomgrain.operators.quality import schema_drift
from loomgrain.sources.footers import as_schema, footers, schema_groups
from loomgrain.sources.readers import decoded_path, read_table

Drift = tuple[str, str, str, str | None, str | None]


class SchemaDrift(ValueError):
    """Parts that do not fit their contract or each other."""


def drift_of_parts(spark: SparkSession, fmt: str, paths: Sequence[str], contract: Contract) -> list[Drift]:
    """(path, column, added/missing/changed, expected type, actual type) of every part; empty when all fit.

    A part is a source or folder. Parquet parts are compared by the footers of
    all their files, read in tasks: what comes back is a row per part and
    different schema, and a part whose files differ has a line for each way in
    which one of them drifts. Other formats are opened once per part.
    """
    if fmt != "parquet":
        return [(path, *line) for path in sorted(paths) for line in schema_drift(read_table(spark, fmt, path).schema, contract)]
    # the part a file belongs to: the longest one that its path begins with
    own = F.lit(None).cast("string")
    for path in sorted(paths, key=len):
        stem = decoded_path(F.lit(path.rstrip("/")))
        file = decoded_path("path")
        own = F.when((file == stem) | F.startswith(file, F.concat(stem, F.lit("/"))), F.lit(path)).otherwise(own)
    found = schema_groups(footers(spark, sorted(paths)).withColumn("part", own), ["part"]).select("part", "columns").collect()
    return sorted({(row["part"], *line) for row in found for line in schema_drift(as_schema(row["columns"]), contract)}, key=str)


def unlike_files(spark: SparkSession, path: str | Sequence[str]) -> list[tuple[str, str, str | None, str | None]]:
    """(example file, column, type in most files, type in that one) where the Parquet files below ``path`` differ.

    Spark takes the columns of one file for all: a column that others lack, or
    have besides, would be lost or NULL in silence.
    """
    groups = schema_groups(footers(spark, path if isinstance(path, str) else list(path), "*.parquet")).orderBy(F.desc("files"), "columns").collect()
    if len(groups) < 2:
        return []
    common, *others = ({f.name: f.dataType.simpleString() for f in as_schema(g["columns"])} for g in groups)
    return sorted(
        (group["example"], name, common.get(name), types.get(name))
        for group, types in zip(groups[1:], others)
        for name in {*common, *types}
        if common.get(name) != types.get(name)
    )


def refuse_unlike_files(spark: SparkSession, fmt: str, path: str | Sequence[str]) -> None:
    """Stops a load whose Parquet files do not all have the same columns, before a row is read."""
    if fmt == "parquet" and (unlike := unlike_files(spark, path)):
        raise SchemaDrift("; ".join(f"{file}: {column} is {got}, elsewhere {want}" for file, column, want, got in unlike))


def read_checked_parts(spark: SparkSession, fmt: str, paths: Sequence[str], contract: Contract) -> DataFrame:
    """One relation over all parts, refused if any of them drifted."""
    if not paths:
        raise FileNotFoundError("no parts to read")
    drift = drift_of_parts(spark, fmt, paths, contract)
    if drift:
        raise SchemaDrift("; ".join(f"{path}: {column} {kind} ({want} -> {got})" for path, column, kind, want, got in drift))
    return read_table(spark, fmt, sorted(paths)).select(*[F.col(f"`{c}`") for c in dict(contract.columns)])


def unlike_columns(frames: Mapping[str, DataFrame]) -> dict[str, dict[str, str]]:
    """Columns whose type differs between the named frames, with the type in each."""
    types: dict[str, dict[str, str]] = {}
    for name, frame in frames.items():
        for column, kind in frame.dtypes:
            types.setdefault(column, {})[name] = kind
    return {column: found for column, found in types.items() if len(set(found.values())) > 1}


def alike(frames: Mapping[str, DataFrame], unlike: str = "refuse") -> list[DataFrame]:
    """The frames, ready for a union by name. Columns of unlike types are refused, or with ``unlike`` "text" read as text."""
    if unlike not in {"refuse", "text"}:
        raise ValueError(f"unknown way to handle unlike columns: {unlike}")
    differing = unlike_columns(frames)
    if differing and unlike == "refuse":
        raise SchemaDrift("; ".join(f"{column}: {found}" for column, found in sorted(differing.items())))
    return [
        frame.withColumns({c: F.col(f"`{c}`").cast("string") for c in differing if c in frame.columns}) if differing else frame
        for frame in frames.values()
    ]

"""What lies in a folder: inventories, manifests and ZIP archives."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgrain.contracts import CORRUPT, Contract
from loomgrain.session import MB

# the largest value a binary column can hold, less a little
CHECKSUM_BYTES = 2047 * MB
ZIP_LINES_PER_BATCH = 20_000


def list_files(spark: SparkSession, root: str | list[str], glob: str | None = None) -> DataFrame:
    """path, modificationTime and length of every file below ``root``, one folder or several; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(root).select("path", "modificationTime", "length")


def inventory(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """Files and bytes per table and batch date below ``<root>/<table>/[batch_date=...]``."""
    stem = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//)?", "", root).rstrip("/") + "/"
    start = F.locate(stem, F.col("path")) + F.lit(len(stem))
    below = F.substr(F.col("path"), start)
    return (
        list_files(spark, root, glob)
        .withColumn("_below", below)
        .groupBy(
            F.substring_index("_below", "/", 1).alias("table_name"),
            F.nullif(F.regexp_extract("_below", r"batch_date=([^/]+)", 1), F.lit("")).alias("batch_date"),
        )
        .agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
    )


def build_manifest(
    spark: SparkSession, root: str, glob: str | None = None, checksum_bytes: int = CHECKSUM_BYTES
) -> DataFrame:
    """path, length, modificationTime and SHA-256 per file.

    A task holds one file at a time. Files above ``checksum_bytes`` cannot be
    loaded whole: they are refused before anything is read, never left without
    a checksum.
    """
    too_large = list_files(spark, root, glob).where(F.col("length") > checksum_bytes).orderBy("path").first()
    if too_large:
        raise ValueError(f"{too_large['path']} has more than {checksum_bytes} bytes")
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(root).select("path", "modificationTime", "length", F.sha2("content", 256).alias("checksum"))


MANIFEST_SCHEMA = "scenario string, tables array<struct<`table`:string,format:string,files:bigint,rows:bigint>>"


def read_manifests(spark: SparkSession, path: str) -> DataFrame:
    """Expected files and rows, one line per scenario and table."""
    return (
        spark.read.schema(MANIFEST_SCHEMA)
        .json(path, multiLine=True)
        .select("scenario", F.inline("tables").alias("table_name", "format", "files", "rows"))
    )


ZIP_LINES = "archive string, member string, unsafe boolean, line_no long, line string"


def _unzipper(lines_per_batch: int):
    """The task's work, nested so that it travels by value and executors need not have this package."""

    def is_unsafe(member):
        name = member.replace("\\", "/")
        parts = name.split("/")
        return name.startswith("/") or ":" in parts[0] or ".." in parts

    def unzip(batches):
        import io
        import zipfile

        import pandas as pd

        def frame(rows):
            return pd.DataFrame(rows, columns=["archive", "member", "unsafe", "line_no", "line"])

        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    for info in archive.infolist():
                        if info.is_dir():
                            continue
                        if is_unsafe(info.filename):
                            yield frame([(path, info.filename, True, None, None)])
                            continue
                        rows = []
                        with archive.open(info) as raw:
                            for number, line in enumerate(io.TextIOWrapper(raw, encoding="utf-8", newline=None)):
                                rows.append((path, info.filename, False, number, line.rstrip("\n")))
                                if len(rows) == lines_per_batch:
                                    yield frame(rows)
                                    rows = []
                        if rows:
                            yield frame(rows)

    return unzip


def unzip_lines(archives: DataFrame, lines_per_batch: int = ZIP_LINES_PER_BATCH) -> DataFrame:
    """Lines of every member of the archives in (path, content).

    Nothing is extracted to disk. Members whose name leaves the target folder
    come out as one line flagged ``unsafe``. One archive is one task's work and
    sits in its memory.
    """
    return archives.select("path", "content").mapInPandas(_unzipper(lines_per_batch), ZIP_LINES)


def unsafe_members(lines: DataFrame) -> DataFrame:
    """archive, member of what would leave the target folder: the quarantine of an archive load."""
    return lines.where("unsafe").select("archive", "member")


def parse_zip_csv(lines: DataFrame, contract: Contract, unsafe: str = "stop") -> DataFrame:
    """Typed rows of the CSV members, header lines left out, bad records kept.

    An unsafe member stops the load. With ``unsafe`` "skip" it is left out;
    ``unsafe_members`` then lists what was.
    """
    if unsafe not in {"stop", "skip"}:
        raise ValueError(f"unknown way to handle unsafe members: {unsafe}")
    safe = ~F.col("unsafe")
    if unsafe == "stop":
        message = F.concat(F.lit("unsafe member "), F.col("member"), F.lit(" in "), F.col("archive"))
        safe = F.when(F.col("unsafe"), F.raise_error(message).cast("boolean")).otherwise(True)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in contract.capture_schema)
    parsed = F.from_csv("line", ddl, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return (
        lines.where(safe)
        .where((F.col("line_no") > 0) & (F.col("line") != ""))
        .select("archive", "member", parsed.alias("row"))
        .select("archive", "member", "row.*")
    )


def read_zip_csv(spark: SparkSession, path: str, contract: Contract, unsafe: str = "stop") -> DataFrame:
    archives = spark.read.format("binaryFile").load(path).select("path", "content")
    return parse_zip_csv(unzip_lines(archives), contract, unsafe)

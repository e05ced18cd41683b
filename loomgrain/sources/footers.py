"""Parquet footers, read in tasks: rows and columns of every file without reading its rows.

A footer lies at the end of its file, its length in the bytes before the closing
mark, so a task reads some KB of each file through the store's file system. The
schemas of any number of files come back as one row per different schema.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomgrain.sources.files import list_files

FILES_PER_TASK = 256
LEAST_BYTES = 12  # both marks and a length
FOOTER = "path string, modificationTime timestamp, length long, readable boolean, problem string, rows long, row_groups long, columns string"


def _reader():
    """The task's work, nested so that it travels by value and executors need not have this package."""

    def columns_of(metadata, schema):
        import json as js

        from pyspark.sql.pandas.types import from_arrow_schema
        from pyspark.sql.types import StructType

        stored = (metadata.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata")
        if stored:
            # what Spark wrote names its own types
            fields = StructType.fromJson(js.loads(stored)).fields
        else:
            fields = from_arrow_schema(schema, prefer_timestamp_ntz=True).fields
        return js.dumps([[f.name, f.dataType.simpleString()] for f in sorted(fields, key=lambda f: f.name)])

    def opened(path):
        from urllib.parse import quote

        from pyarrow import fs

        if path.startswith("file:"):
            return fs.LocalFileSystem().open_input_file("/" + path.removeprefix("file:").lstrip("/"))
        system, inner = fs.FileSystem.from_uri(quote(path.replace("s3a://", "s3://", 1), safe=":/"))
        return system.open_input_file(inner)

    def read(batches):
        import pyarrow as pa
        import pyarrow.parquet as pq

        def facts(path, length):
            if length < least:
                return False, "shorter than a footer", None, None, None
            try:
                with opened(path) as file:
                    # the last bytes only: pyarrow seeks to the footer
                    metadata = pq.read_metadata(file)
                    return True, None, metadata.num_rows, metadata.num_row_groups, columns_of(metadata, metadata.schema.to_arrow_schema())
            except (pa.ArrowInvalid, pa.ArrowNotImplementedError) as problem:
                return False, str(problem)[:200], None, None, None

        for batch in batches:
            path, at, length = batch.columns
            found = [facts(p, n) for p, n in zip(path.to_pylist(), length.to_pylist())]
            readable, problem, rows, groups, columns = zip(*found) if found else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [
                    path, at, length, pa.array(readable, pa.bool_()), pa.array(problem, pa.string()), pa.array(rows, pa.int64()),
                    pa.array(groups, pa.int64()), pa.array(columns, pa.string()),
                ],
                names=["path", "modificationTime", "length", "readable", "problem", "rows", "row_groups", "columns"],
            )

    least = LEAST_BYTES
    return read


def footers(spark: SparkSession, root: str | list[str], glob: str | None = None) -> DataFrame:
    """FOOTER of every file below ``root`` that has a byte, those without rows and corrupt ones included.

    A file that is no Parquet is not ``readable`` and says why. A store that
    cannot be reached is an error, never a corrupt file.
    """
    listed = list_files(spark, root, glob)
    tasks = max(1, -(-listed.count() // FILES_PER_TASK))
    return listed.repartition(tasks).mapInArrow(_reader(), FOOTER)


def schema_groups(found: DataFrame, by: list[str] | None = None) -> DataFrame:
    """columns, files, rows, example: a row per different schema of the readable files, in each of ``by``."""
    return (
        found.where("readable")
        .groupBy(*(by or []), "columns")
        .agg(F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"), F.min("path").alias("example"))
    )


def as_schema(columns: str) -> T.StructType:
    """The schema a row of ``schema_groups`` names."""
    return T.StructType([T.StructField(name, T._parse_datatype_string(kind)) for name, kind in json.loads(columns)])

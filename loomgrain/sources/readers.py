"""File scans by format: inferred, by schema, and by contract with bad records kept."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomgrain.contracts import CORRUPT, Contract
from loomgrain.session import materialise
from loomgrain.sources.footers import footers

FORMATS = ("csv", "json", "parquet")


def check_format(fmt: str) -> str:
    if fmt not in FORMATS:
        raise ValueError(f"unsupported format: {fmt}")
    return fmt


def read_table(
    spark: SparkSession,
    fmt: str,
    path: str | Sequence[str],
    schema: T.StructType | str | None = None,
    **options,
) -> DataFrame:
    """Read csv, json or parquet from a path, a glob or a list of paths.

    Without a schema, CSV and JSON are scanned once more to infer one.
    """
    reader = spark.read.format(check_format(fmt)).options(**options)
    if fmt == "csv":
        reader = reader.option("header", options.get("header", True))
        if schema is None:
            reader = reader.option("inferSchema", True)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path if isinstance(path, str) else list(path))


def read_parts(spark: SparkSession, paths: Iterable[str]) -> DataFrame:
    """One relation over a list of Parquet parts; no parts is an error."""
    ordered = sorted(paths)
    if not ordered:
        raise FileNotFoundError("no parquet parts to read")
    return spark.read.parquet(*ordered)


def read_by_contract(
    spark: SparkSession, fmt: str, path: str | Sequence[str], contract: Contract, typed: bool = False, **options
) -> DataFrame:
    """Scan by contract; records that cannot be parsed are kept in ``_corrupt_record``.

    By default every column is read as text, so a bad number survives until the
    cast and gets its own reason. With ``typed`` the parser itself rejects it,
    but only in columns the query uses. Parquet carries its own types and has
    no unparsable rows.
    """
    if check_format(fmt) == "parquet":
        return read_table(spark, fmt, path, **options).withColumn(CORRUPT, F.lit(None).cast("string"))
    return read_table(
        spark,
        fmt,
        path,
        schema=contract.capture_schema if typed else contract.text_schema,
        mode="PERMISSIVE",
        columnNameOfCorruptRecord=CORRUPT,
        # a pruned CSV parser skips fields and would miss short and long records
        **({"columnPruning": False} if fmt == "csv" else {}),
        **options,
    )


def with_source_file(df: DataFrame, name: str = "_source_file") -> DataFrame:
    """Add the path of the file each row came from."""
    return df.withColumn(name, F.col("_metadata.file_path"))


def read_batch(
    spark: SparkSession,
    fmt: str,
    root: str,
    batch_date: str | None = None,
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """A ``batch_date=`` partitioned root, whole or one date of it.

    The date is a filter on the root, so it prunes folders, ``batch_date`` is
    always a DATE, and a date without files gives no rows.
    """
    if schema is not None:
        fields = T.StructType.fromDDL(schema).fields if isinstance(schema, str) else schema.fields
        kept = [f for f in fields if f.name != "batch_date"]
        schema = T.StructType([*kept, T.StructField("batch_date", T.DateType())])
    df = read_table(spark, fmt, root, schema=schema)
    if dict(df.dtypes).get("batch_date") != "date":
        df = df.withColumn("batch_date", F.col("batch_date").cast("date"))
    return df if batch_date is None else df.where(F.col("batch_date") == F.lit(batch_date).cast("date"))


def read_tolerant_parquet(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType
) -> tuple[DataFrame, DataFrame]:
    """Rows of the readable Parquet files, and a line per file with ``was_read``.

    Skipping corrupt files silently loses data, so the second result compares
    the rows that came from each file with those its footer names: an empty
    file counts as read, one that breaks off before its end does not.
    """
    paths = [path] if isinstance(path, str) else list(path)
    rows = spark.read.schema(schema).option("ignoreCorruptFiles", "true").parquet(*paths)
    found = footers(spark, paths).select(decoded_path("path").alias("path"), "length", "readable", F.col("rows").alias("named"))
    read = rows.groupBy(decoded_path("_metadata.file_path").alias("path")).agg(F.count(F.lit(1)).alias("rows"))
    met = found.join(read, "path", "left").withColumn("rows", F.coalesce("rows", F.lit(0)))
    files = met.select("path", "length", (F.col("readable") & (F.col("rows") == F.coalesce("named", F.lit(-1)))).alias("was_read"), "rows")
    return rows, materialise(files, "parquet-files")


def decoded_path(column: str | Column) -> Column:
    """Path without scheme variants and URL escapes, for comparing two listings."""
    path = F.col(column) if isinstance(column, str) else column
    return F.regexp_replace(F.url_decode(F.regexp_replace(path, r"\+", "%2B")), r"^file:/+", "/")

"""Versions of a dataset on plain files: write, check, then make current.

Readers follow a small table of published versions, so a version that failed
its check, or a job that died while writing, is never seen. A version lists its
files with their rows. It may take files of earlier versions over by reference,
so a change to a few keys writes a few files; the list, not the folder, is what
a version is.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomgrain.session import fresh_path, path_exists

POINTER = "version bigint, rows bigint, published_at timestamp"
FILES = "file string, rows bigint"
FILE = "_version_file"


class NothingPublished(ValueError):
    """The dataset has no version yet."""


def _pointer(root: str) -> str:
    return f"{root}/published"


def _published(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(POINTER).parquet(_pointer(root))


def file_below_root() -> F.Column:
    """``version_<n>/<file>`` of the file a row was read from: names without anything to escape."""
    return F.regexp_extract(F.col("_metadata.file_path"), "(version_[^/]+/[^/]+)$", 1)


def new_folder(spark: SparkSession, root: str, version: int) -> str:
    """Where version ``version`` writes; a try that died leaves a folder nobody lists."""
    return f"version_{version}" + ("-again-" + fresh_path(spark, "v").rsplit("/", 1)[1] if path_exists(spark, f"{root}/version_{version}") else "")


def list_written(spark: SparkSession, root: str, folder: str, schema: T.StructType) -> DataFrame:
    """file, rows of what was written to a folder; the rows come from the footers."""
    written = spark.read.schema(schema).parquet(f"{root}/{folder}")
    return written.groupBy(file_below_root().alias("file")).agg(F.count(F.lit(1)).alias("rows"))


def make_current(spark: SparkSession, root: str, version: int, files: DataFrame) -> None:
    """Store the list of files, then append the line that readers follow."""
    path = f"{root}/files/version_{version}"
    files.select("file", "rows").coalesce(1).write.mode("overwrite").parquet(path)
    total = spark.read.schema(FILES).parquet(path).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))
    line = total.select(F.lit(version).cast("bigint").alias("version"), "rows", F.current_timestamp().alias("published_at"))
    line.coalesce(1).write.mode("append").parquet(_pointer(root))


def publish(
    df: DataFrame, root: str, version: int, check: Callable[[DataFrame], bool] = lambda written: True
) -> DataFrame:
    """Write version ``version`` whole and make it current if ``check`` accepts what was written."""
    spark = df.sparkSession
    folder = new_folder(spark, root, version)
    df.write.parquet(f"{root}/{folder}")
    written = spark.read.schema(df.schema).parquet(f"{root}/{folder}")
    if not check(written):
        raise ValueError(f"version {version} of {root} failed its check and was not published")
    make_current(spark, root, version, list_written(spark, root, folder, df.schema))
    return written


def current_version(spark: SparkSession, root: str) -> int:
    if not path_exists(spark, _pointer(root)):
        raise NothingPublished(f"{root} has no published version")
    return _published(spark, root).agg(F.max("version").alias("version")).first()["version"]


def version_files(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """file, rows: what the current version, or a given one, consists of."""
    number = current_version(spark, root) if version is None else version
    return spark.read.schema(FILES).parquet(f"{root}/files/version_{number}")


def read_files(spark: SparkSession, root: str, names: list[str], schema: T.StructType | None = None) -> DataFrame:
    """Rows of the named files, each with ``FILE``. A scan's list of files is the driver's in any case."""
    if not names:
        if schema is None:
            raise NothingPublished(f"no files of {root} to read")
        return spark.createDataFrame([], schema).withColumn(FILE, F.lit(None).cast("string"))
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*[f"{root}/{name}" for name in names]).withColumn(FILE, file_below_root())


def names_of(files: DataFrame) -> list[str]:
    return sorted(r["file"] for r in files.select("file").collect())


def version_schema(spark: SparkSession, root: str, version: int) -> T.StructType:
    """Columns of a version; one without files has those of the folder it wrote."""
    names = names_of(version_files(spark, root, version))
    return spark.read.parquet(f"{root}/{names[0]}" if names else f"{root}/version_{version}").schema


def read_version(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The current version, or a given one."""
    number = current_version(spark, root) if version is None else version
    names = names_of(version_files(spark, root, number))
    return read_files(spark, root, names, version_schema(spark, root, number)).drop(FILE)

"""Named tables and views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def create_namespace(spark: SparkSession, name: str, location: str | None = None) -> None:
    clause = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {name}{clause}")


def replace_table(spark: SparkSession, name: str, df: DataFrame, using: str = "parquet") -> DataFrame:
    """Drop and create a table in any catalog; ``using`` names its format."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    df.writeTo(name).using(using).create()
    return spark.table(name)


def register_views(frames: dict[str, DataFrame]) -> None:
    for name, df in frames.items():
        df.createOrReplaceTempView(name)

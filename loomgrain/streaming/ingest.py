"""Incremental ingestion of arriving files.

The stream's checkpoint is the record of processed files: each run takes what
has arrived since the last one and stops.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomgrain.contracts import CORRUPT, Contract
from loomgrain.operators.quality import REASON, REJECT_COLUMNS, validate_contract
from loomgrain.plans.batches import ingest_rows
from loomgrain.sources.readers import check_format


def file_stream(
    spark: SparkSession, fmt: str, path: str, schema: T.StructType, files_per_batch: int = 1000, **options
) -> DataFrame:
    reader = spark.readStream.format(check_format(fmt)).schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if fmt == "csv":
        reader = reader.option("header", options.pop("header", True))
    return reader.options(**options).load(path)


def arriving(spark: SparkSession, fmt: str, source: str, contract: Contract, files_per_batch: int = 1000, **options) -> DataFrame:
    """Validated rows of the files that arrive; text formats are read as text, so a bad value gets its reason."""
    if fmt == "parquet":
        rows = file_stream(spark, fmt, source, contract.schema, files_per_batch, **options)
    else:
        rows = file_stream(
            spark,
            fmt,
            source,
            contract.text_schema,
            files_per_batch,
            mode="PERMISSIVE",
            columnNameOfCorruptRecord=CORRUPT,
            **options,
        )
    return validate_contract(rows, contract)


def batch_sink(root: str, contract: Contract, name: str):
    """A sink for ``foreachBatch``: the stream's batch number names the batch, and a batch that is committed adds nothing."""

    def sink(rows: DataFrame, number: int) -> None:
        ingest_rows(rows, contract, root, f"{name}-{number:09d}")

    return sink


def ingest_stream(
    spark: SparkSession,
    fmt: str,
    source: str,
    contract: Contract,
    root: str,
    checkpoint: str,
    name: str = "stream",
    files_per_batch: int = 1000,
    **options,
) -> None:
    """Commit the files that arrived since the last run as batches of ``root``, with rejects and metrics of each.

    The checkpoint may hand a batch over again after a failure; the log of
    attempts tells what is committed, so no row is added twice. ``name`` must
    stay with the checkpoint: a new checkpoint counts from zero again.
    """
    query = (
        arriving(spark, fmt, source, contract, files_per_batch, **options)
        .writeStream.foreachBatch(batch_sink(root, contract, name))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def ingest_new_files(
    spark: SparkSession,
    fmt: str,
    source: str,
    contract: Contract,
    target: str,
    checkpoint: str,
    files_per_batch: int = 1000,
    **options,
) -> None:
    """Validate the files that arrived since the last run and add them to ``target``.

    Accepted and rejected rows land in ``outcome=`` folders of the target. The
    file sink commits each batch once, so a repeated batch adds no rows.
    """
    checked = arriving(spark, fmt, source, contract, files_per_batch, **options)
    outcome = F.when(F.col(REASON).isNull(), "accepted").otherwise("rejected")
    query = (
        checked.select(*contract.names, *REJECT_COLUMNS, outcome.alias("outcome"))
        .writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .partitionBy("outcome")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def ingested(spark: SparkSession, contract: Contract, target: str) -> DataFrame:
    """Rows accepted so far."""
    schema = T.StructType(
        [*contract.schema.fields, *[T.StructField(c, T.StringType()) for c in (*REJECT_COLUMNS, "outcome")]]
    )
    return spark.read.schema(schema).parquet(target).where(F.col("outcome") == "accepted").select(*contract.names)

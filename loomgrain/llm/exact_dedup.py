"""Exact deduplication against a persistent digest index.

The index is a table bucketed and sorted by digest. A batch of documents is
reduced to one winner per digest, the winners the index does not know yet are
found by an anti-join that moves only the batch, and these are appended. Main
path: DataFrame functions only.

Defined results: a NULL text counts as empty, and all empty texts are equal; a
NULL doc_id loses every tie; rows that repeat a doc_id with the same text are
one document (``decisions`` lists each of them, ``deduplicate`` returns one);
an empty table gives an empty result. Input columns other than the id and the
text are never looked at, whatever their names.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgrain.llm.common import private_name, shuffle_partitions, text_or_empty, written
from loomgrain.session import delete_path, fresh_path

INDEX_SCHEMA = "digest binary, keep_id long, keep_chars long, batch string"


def text_digest(column: str = "text"):
    """SHA-256 of the text without its blanks."""
    return F.unhex(F.sha2(F.regexp_replace(text_or_empty(column), "[ \\t-\\r]+", ""), 256))


class DigestIndex:
    """Digests seen so far, each with the document that was kept for it."""

    def __init__(self, spark: SparkSession, name: str, path: str, buckets: int | None = None):
        self.spark = spark
        self.name = name
        self.path = path
        # at least as many buckets as shuffle partitions, else Spark would move the index as well
        self.buckets = buckets or shuffle_partitions(spark)
        if not spark.catalog.tableExists(name):
            self._write(spark.createDataFrame([], INDEX_SCHEMA))

    def rows(self) -> DataFrame:
        return self.spark.read.table(self.name)

    def append(self, fresh: DataFrame, batch: str) -> None:
        """Add digests that are not in the index, as brought by ``batch``; one file per bucket and call."""
        self._write(fresh.withColumn("batch", F.lit(batch)).repartition(self.buckets, "digest"))

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        delete_path(self.spark, self.path)

    def _write(self, rows: DataFrame) -> None:
        (
            rows.select("digest", "keep_id", "keep_chars", "batch")
            .write.mode("append")
            .format("parquet")
            .option("path", self.path)
            .bucketBy(self.buckets, "digest")
            .sortBy("digest")
            .saveAsTable(self.name)
        )


def scratch_index(spark: SparkSession) -> DigestIndex:
    """An empty index in this application's shared working folder."""
    path = fresh_path(spark, "digest-index")
    return DigestIndex(spark, f"llm_digest_index_{private_name('t')[3:]}", path)


def document_digests(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id"), F.length(text_or_empty()).cast("long").alias("chars"), text_digest().alias("digest")
    )


def decisions(docs: DataFrame, index: DigestIndex, batch: str | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, chars, digest, keep_id, group_size, kept. New digests go into the index.

    A digest that another batch brought keeps the id it has in the index and
    none of the new rows; otherwise the longest text, then the smallest id, is
    kept. A digest belongs to the batch that brought it: a batch that is run
    again under its name, because the first run died at whatever step, keeps
    what one run keeps. Batches of one index run one after the other.
    """
    batch = batch or uuid.uuid4().hex
    digests = written(document_digests(docs), "digests")
    # copies meet in the partial aggregate first, so a digest shared by a third of all rows is no hot key
    best = F.min(F.struct((-F.col("chars")).alias("chars"), F.col("doc_id").isNull().alias("no_id"), "doc_id"))
    winners = written(
        digests.groupBy("digest")
        .agg(best.alias("best"), F.count(F.lit(1)).alias("group_size"))
        .select("digest", F.col("best.doc_id").alias("keep_id"), (-F.col("best.chars")).alias("keep_chars"), "group_size"),
        "digest-winners",
    )
    fresh = written(winners.join(index.rows().hint("merge"), "digest", "left_anti"), "digest-fresh")
    index.append(fresh, batch)
    brought = index.rows().hint("merge").select("digest", F.col("keep_id").alias("old_id"), (F.col("batch") == batch).alias("new"))
    settled = winners.join(brought, "digest").select(
        "digest",
        F.when(F.col("new"), F.col("keep_id")).otherwise(F.col("old_id")).alias("keep_id"),
        "keep_chars",
        "group_size",
        "new",
    )
    # adaptive execution splits the rows of a hot digest: the other side has one row per digest
    return digests.join(settled, "digest").select(
        "doc_id",
        "chars",
        "digest",
        "keep_id",
        "group_size",
        (
            F.col("new") & F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("chars") == F.col("keep_chars"))
        ).alias("kept"),
    )


def deduplicate(docs: DataFrame, index: DigestIndex | None = None, batch: str | None = None) -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they came. Without an index, one for this call."""
    own = index or scratch_index(docs.sparkSession)
    kept = written(
        decisions(docs, own, batch).where("kept").groupBy("doc_id", "digest").agg(F.count(F.lit(1)).alias("copies")),
        "digest-kept",
    )
    if index is None:
        own.drop()
    id_, digest, key_id, key_digest, copies = (private_name(x) for x in ("i", "d", "ki", "kd", "c"))
    keys = kept.select(
        F.col("doc_id").alias(key_id), F.col("digest").alias(key_digest), F.col("copies").alias(copies)
    )
    stay = (
        docs.withColumns({id_: F.col("doc_id"), digest: text_digest()})
        .join(keys, F.col(id_).eqNullSafe(F.col(key_id)) & (F.col(digest) == F.col(key_digest)))
    )
    if kept.where("copies > 1").isEmpty():
        return stay.select(*[F.col(f"`{c}`") for c in docs.columns])
    once = stay.where(F.col(copies) == 1)
    repeated = stay.where(F.col(copies) > 1).dropDuplicates([id_, digest])
    return once.unionAll(repeated).select(*[F.col(f"`{c}`") for c in docs.columns])

"""The corpus pipeline: stages over ``documents``, each written and read again by the next one.

Documents the quality classifier rejects go, then all but one of equal texts,
then all but one of each group of near copies; what is left is mixed to the
target weights, repeats included, and packed into sequences of tokens. All
stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loomgrain.llm import exact_dedup, mixing, near_dedup, packing, quality
from loomgrain.llm.common import documents, table
from loomgrain.llm.queries import tokenizer_path
from loomgrain.session import materialise


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def one_per_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(docs)


def one_per_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.keep_one_each(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, tokenizer_path(), plain_specials=False)


STAGES = [
    ("quality", good),
    ("exact_dedup", one_per_text),
    ("near_dedup", one_per_group),
    ("mixing", mixed),
    ("packing", packed),
]

# the classifier and the packing cannot be said in SQL; the stages are tested against brute-force versions
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

"""What the operators of this folder share."""

from __future__ import annotations

import hashlib
import sys
import types
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgrain.session import materialise

# The characters that separate words, also as the operators' contracts write them.
BLANKS = " \t\n\x0b\x0c\r"

WORD = "[^\\x20\\x09-\\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(f"`{column}`"), F.lit(""))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared working folder.

    Its files follow the tasks that compute it: what comes out of a shuffle is
    merged by adaptive execution, what does not has a file per input split.
    """
    return materialise(df, label)


def crc_remainder(divisor: int, column: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``divisor``; a missing id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(divisor))


def private_name(label: str) -> str:
    """A column name no input table has."""
    return f"_{label}_{uuid.uuid4().hex[:8]}"


def worker_cache(name: str) -> dict:
    """A dictionary that lasts as long as the Python worker, for what is dear to load or compute again."""
    holder = sys.modules.setdefault("_loomgrain_worker", types.ModuleType("_loomgrain_worker"))
    return holder.__dict__.setdefault(name, {})


def joined_spans(spans) -> str:
    """kind:start:end of each span, comma-joined, in the order given."""
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def sha256_hex(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()

"""Mix sources to target weights by systematic sampling.

Within a source every document expects the same number of copies, the target
over the source's size. The documents are put in order of size, their expected
copies summed, one random offset per source added, and a document is emitted
once per integer its interval crosses. Ordered by size, what a source
contributes differs from its target by less than one document of the largest
size. Main path: DataFrame functions only.

Defined results: a NULL text has size 0; a NULL source is a source of its own,
last in order; a source without words has target 0 and nothing is taken from
it; a NULL doc_id comes first among equal sizes; rows that repeat a doc_id are
documents of their own; an empty table gives an empty result. Other columns are
carried along whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomgrain.llm.common import WORD, private_name, shuffle_partitions, text_or_empty, written

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
SEED = "mix-1"


def word_count(column: str = "text"):
    return F.regexp_count(text_or_empty(column), F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, most_copies: int = MOST_COPIES) -> DataFrame:
    """source, source_size, target: one row per source.

    Water filling: every source gets ``level * weight`` or stops at
    ``most_copies`` times its size, and the level is where all targets add up
    to all sizes. Sources in order of the level at which they stop: the first
    one that the level of the rest does not reach settles it. One narrow row
    per source goes through the two windows.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (place + 1).cast("int"))
    limit = F.col("source_size") * F.lit(most_copies)
    weighed = per_source.withColumn("weight", weight).withColumn("stops", limit / F.col("weight"))
    by_stop = Window.orderBy("stops", F.col("source").asc_nulls_last())
    before = by_stop.rowsBetween(Window.unboundedPreceding, -1)
    after = by_stop.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = by_stop.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    capped = F.coalesce(F.sum(limit).over(before), F.lit(0))
    total = F.sum("source_size").over(everything)
    levels = weighed.withColumn("level", (total - capped) / F.sum("weight").over(after))
    reached = F.when(F.col("level") <= F.col("stops"), F.col("level"))
    settled = levels.withColumn("settled", F.first(reached, ignorenulls=True).over(everything))
    return settled.select(
        "source",
        "source_size",
        F.least(F.col("weight") * F.col("settled"), limit.cast("double")).alias("target"),
    )


def offset(seed: str = SEED):
    """The source's random offset in [0, 1)."""
    text = F.concat(F.lit(f"{seed}|"), F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def ranked(sizes: DataFrame) -> DataFrame:
    """``sizes`` with the row's place within its source by size and id, from 1.

    Rows are range-partitioned on (source, size, id), so a source that owns a
    third of all rows spreads over many tasks; a part then counts its own rows,
    and the counts of the parts before it are added.
    """
    spark = sizes.sparkSession
    order = ["source", "size", "doc_id"]
    parted = written(
        sizes.repartitionByRange(shuffle_partitions(spark), *order).withColumn("part", F.spark_partition_id()), "mix-parts"
    )
    counts = parted.groupBy("source", "part").agg(F.count(F.lit(1)).alias("rows"))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("source", "part", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("start"))
    within = F.row_number().over(Window.partitionBy("part", "source").orderBy("size", "doc_id"))
    a, b = parted.withColumn("within", within).alias("a"), starts.alias("b")
    return a.join(b, F.expr("a.part = b.part AND a.source <=> b.source")).select(
        "a.*", (F.col("b.start") + F.col("a.within")).alias("place")
    ).drop("part", "within")


def copies(docs: DataFrame, weights=WEIGHTS, most_copies: int = MOST_COPIES, seed: str = SEED) -> DataFrame:
    """doc_id, source, size, source_size, target, copies: one row per row of ``docs``."""
    sizes = written(docs.select("doc_id", "source", word_count().alias("size")), "mix-sizes")
    targets = source_targets(sizes, weights, most_copies)
    a, b = ranked(sizes).alias("a"), targets.alias("b")
    joined = a.join(b, F.expr("a.source <=> b.source")).select("a.*", "b.source_size", "b.target")
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    upto = F.floor(F.col("place") * each + offset(seed))
    before = F.floor((F.col("place") - 1) * each + offset(seed))
    return joined.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        # the quotient of two doubles may pass the limit by its last bit
        F.least(upto - before, F.lit(most_copies)).cast("long").alias("copies"),
    )


def mix(docs: DataFrame, weights=WEIGHTS, most_copies: int = MOST_COPIES, seed: str = SEED) -> DataFrame:
    """``docs`` as the mix holds them: each row as often as it is taken.

    Rows that repeat a doc_id within a source share their copies: the row's
    place among its repeats picks its own count.
    """
    wanted = copies(docs, weights, most_copies, seed).where("copies > 0")
    key = ["doc_id", "source", "size"]
    plan = written(
        wanted.groupBy(*key).agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("rows")), "mix-plan"
    )
    names = {k: private_name(k) for k in (*key, "copies", "rows", "n")}
    keyed = plan.select(*[F.col(k).alias(names[k]) for k in (*key, "copies", "rows")])
    own = docs.withColumn(names["n"], word_count())
    same = (
        F.col("doc_id").eqNullSafe(F.col(names["doc_id"]))
        & F.col("source").eqNullSafe(F.col(names["source"]))
        & (F.col(names["n"]) == F.col(names["size"]))
    )
    # a plan row per document: the same join at every size, and one that survives any
    met = own.join(keyed.hint("merge"), same)
    if plan.where("rows > 1").isEmpty():
        times = F.col(names["copies"])
    else:
        repeat = Window.partitionBy(*[names[k] for k in key]).orderBy(F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]))
        met = met.withColumn(names["n"], F.row_number().over(repeat))
        # all copies of the repeats, dealt out one after another
        times = F.floor((F.col(names["copies"]) + F.col(names["rows"]) - F.col(names["n"])) / F.col(names["rows"]))
    emitted = met.where(times > 0).withColumn(names["n"], F.explode(F.sequence(F.lit(1), times.cast("int"))))
    return emitted.select(*[F.col(f"`{c}`") for c in docs.columns])

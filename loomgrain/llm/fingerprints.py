"""Document fingerprints by consistent weighted sampling.

A text is a set of terms, its words in lower case, weighted by how often they
occur. For each of ``SAMPLES`` samples every term draws, from a hash of the
term and the number of the sample, r and c from Gamma(2, 1) and b from the
uniform distribution. With weight S,

    t = floor(ln S / r + b),  ln y = r (t - b),  ln a = ln c - ln y - r,

and the sample is the pair (term, t) of the least a. Two texts agree in a
sample with the probability of their generalised Jaccard similarity, the sum of
the smaller over the sum of the larger weights. A fingerprint keeps 16 bits of
each pair, which adds at most 1 in 65,536 to the agreement of unlike texts.

The draws of a term serve a text and its edited text at once. Texts are moved
once to find their neighbour and their first halves a second time; all
counting and sampling then runs where a document is. Main path: DataFrame
functions only.

Defined results: a NULL text counts as empty; a text without words has the
empty fingerprint, which is like another empty one only; documents are in order
of doc_id (NULL first), those that share an id in order of a hash of the text;
rows with the same id and text are one document and each get its result; a
single document is its own next one; no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomgrain.llm.common import shuffle_partitions, text_or_empty, written

SAMPLES = 64
AT_ONCE = 4  # samples computed per row of a term: a generated method is compiled only while it is short
LANES = 4  # 16-bit samples per stored long
PARTS = 4  # parts of the sampling per shuffle partition
BLANK_RUN = "[\\x20\\x09-\\x0D]+"

BITS_21, BITS_22, BITS_32 = (1 << 21) - 1, (1 << 22) - 1, (1 << 32) - 1
KEY = ["a", "b"]


def identified(docs: DataFrame) -> DataFrame:
    """doc_id, a, b, text: (a, b) names a document; rows of one id and text share it."""
    text = text_or_empty()
    return docs.select(
        F.col("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(text, F.lit(1))).alias("a"),
        F.xxhash64(text, F.col("doc_id").isNull()).alias("b"),
        text.alias("text"),
    )


def in_order(rows: DataFrame) -> DataFrame:
    """doc_id, a, b, n_chars, copies, next_a, next_b, next_chars of narrow rows, one per document.

    The ids are range-partitioned; a part's last document is followed by the
    first one of the next part that has any, and the last of all by the first.
    """
    spark = rows.sparkSession
    one_each = rows.groupBy("doc_id", *KEY).agg(F.first("n_chars").alias("n_chars"), F.count(F.lit(1)).alias("copies"))
    parts = written(
        one_each.repartitionByRange(shuffle_partitions(spark), F.col("doc_id").asc_nulls_first(), "b")
        .withColumn("part", F.spark_partition_id()),
        "fp-order",
    )
    place = [F.col("doc_id").asc_nulls_first(), F.col("b"), F.col("a")]
    within = Window.partitionBy("part").orderBy(*place)
    own = F.struct(*KEY, "n_chars")
    follows = parts.withColumn("next", F.lead(own).over(within))
    # one row per part
    order = F.struct(F.col("doc_id").isNotNull(), "doc_id", "b", "a")
    firsts = written(parts.groupBy("part").agg(F.min_by(own, order).alias("head")), "fp-heads")
    around = Window.orderBy("part")
    wrapped = F.first("head").over(around.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    edges = firsts.select("part", F.coalesce(F.lead("head").over(around), wrapped).alias("edge"))
    following = F.coalesce("next", "edge")
    return follows.join(edges, "part").select(
        "doc_id", *KEY, "n_chars", "copies",
        *[following[x].alias(f"next_{y}") for x, y in (("a", "a"), ("b", "b"), ("n_chars", "chars"))],
    )


def with_edited(docs: DataFrame, order: DataFrame) -> DataFrame:
    """a, b, text, edited: one row per document of ``order``."""
    # what follows counts the words of both texts where they meet: parts small enough that no count spills.
    # Texts are dealt to these parts at once, so that they need not move again to meet the heads
    parts = PARTS * shuffle_partitions(docs.sparkSession)
    texts = identified(docs).select(*KEY, "text").repartition(parts, *KEY)
    if not order.where("copies > 1").isEmpty():
        texts = texts.dropDuplicates(KEY)
    before = order.select(
        F.col("next_a").alias("a"), F.col("next_b").alias("b"),
        F.col("a").alias("to_a"), F.col("b").alias("to_b"), F.floor(F.col("n_chars") / 2).cast("int").alias("room"),
    )
    placed = texts.join(before.repartition(parts, *KEY), KEY)
    heads = placed.select(
        F.col("to_a").alias("a"), F.col("to_b").alias("b"), F.substring("text", F.lit(1), F.col("room")).alias("head"), "room"
    ).repartition(parts, *KEY)
    kept = F.substring("text", F.lit(1), F.length("text") - F.col("room"))
    # each document is the next one of just one
    return texts.join(heads, KEY).select(*KEY, "text", F.concat(kept, F.col("head")).alias("edited"))


def bits(value: Column, shift: int, mask: int) -> Column:
    """Uniform in (0, 1) from some bits of a hash."""
    return (F.shiftrightunsigned(value, shift).bitwiseAND(F.lit(mask)) + F.lit(0.5)) / F.lit(float(mask + 1))


def draws(term: Column, number: Column) -> tuple[Column, Column, Column]:
    """r, b and ln c of a term in a sample."""
    one = F.xxhash64(term, number)
    two = F.xxhash64(one, number)
    r = -F.ln(bits(one, 43, BITS_21) * bits(one, 22, BITS_21))
    log_c = F.ln(-F.ln(bits(two, 32, BITS_32) * bits(two, 0, BITS_32)))
    return r, bits(one, 0, BITS_22), log_c


def candidate(term: Column, r: Column, log_c: Column, t: Column, b: Column) -> Column:
    """A long whose minimum over a text's terms is the sample: a's order above 16 bits of (term, t).

    ln a lies between -74 and 4: r is below 31 and c above 2^-32.
    """
    log_a = log_c - r * (t - b + F.lit(1.0))
    place = ((log_a + F.lit(128.0)) * F.lit(float(1 << 38))).cast("long")
    return F.shiftleft(place, 16).bitwiseOR(term.bitwiseXOR(t).bitwiseAND(F.lit(0xFFFF)))


def term_weights(texts: DataFrame) -> DataFrame:
    """a, b, term, w0, w1: logarithms of how often a term occurs in the text and in the edited text, NULL for never."""
    both = [F.struct(F.lit(side).alias("side"), F.col(name).alias("text")) for side, name in enumerate(("text", "edited"))]
    sides = texts.select(*KEY, F.explode(F.array(*both)).alias("x"))
    words = sides.select(*KEY, F.col("x.side").alias("side"), F.explode(F.split(F.lower("x.text"), BLANK_RUN)).alias("word"))
    # a hash of the word stands for it: equal words have equal hashes, unlike ones but for 1 in 2^64
    counted = (
        words.where("word != ''")
        .groupBy(*KEY, F.xxhash64("word").alias("term"))
        .agg(F.count(F.when(F.col("side") == 0, 1)).alias("n0"), F.count(F.when(F.col("side") == 1, 1)).alias("n1"))
    )
    return counted.select(*KEY, "term", *[F.when(F.col(n) > 0, F.ln(n)).alias(w) for n, w in (("n0", "w0"), ("n1", "w1"))])


def sampled(weights: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """a, b, f0, f1: both fingerprints as longs of LANES samples, NULL where a text has no words."""
    rounds = samples // AT_ONCE
    spread = weights.withColumn("round", F.explode(F.array(*[F.lit(i) for i in range(rounds)])))
    drawn = {}
    for i in range(AT_ONCE):
        drawn |= dict(zip((f"r{i}", f"b{i}", f"c{i}"), draws(F.col("term"), F.col("round") * AT_ONCE + i)))
    # a weight that is NULL gives t and the candidate NULL, which no minimum takes; each step's columns are computed once
    steps = {f"t{s}_{i}": F.floor(F.col(f"w{s}") / F.col(f"r{i}") + F.col(f"b{i}")) for s in (0, 1) for i in range(AT_ONCE)}
    least = [
        F.min(candidate(F.col("term"), *[F.col(x) for x in (f"r{i}", f"c{i}", f"t{s}_{i}", f"b{i}")])).alias(f"m{s}_{i}")
        for s in (0, 1)
        for i in range(AT_ONCE)
    ]
    found = spread.withColumns(drawn).withColumns(steps).groupBy(*KEY, "round").agg(*least)

    def packed(side: int, group: int) -> Column:
        lanes = [
            F.shiftleft(F.col(f"m{side}_{group * LANES + j}").bitwiseAND(F.lit(0xFFFF)), 16 * (LANES - 1 - j)) for j in range(LANES)
        ]
        whole = lanes[0]
        for lane in lanes[1:]:
            whole = whole.bitwiseOR(lane)
        return whole

    groups = AT_ONCE // LANES
    narrow = found.select(*KEY, "round", *[packed(s, g).alias(f"p{s}_{g}") for s in (0, 1) for g in range(groups)])
    # one long of each round: there is just one row per document and round
    return narrow.groupBy(*KEY).agg(
        *[
            F.array(*[F.max(F.when(F.col("round") == i, F.col(f"p{s}_{g}"))) for i in range(rounds) for g in range(groups)]).alias(f"f{s}")
            for s in (0, 1)
        ]
    )


def likeness(x: Column, y: Column, samples: int = SAMPLES) -> Column:
    """Share of equal samples; two fingerprints without words are alike, one of them is like nothing else."""
    same = F.lit(0)
    for i in range(samples // LANES):
        apart = x[i].bitwiseXOR(y[i])
        for j in range(LANES):
            lane = F.shiftrightunsigned(apart, 16 * j).bitwiseAND(F.lit(0xFFFF)) == F.lit(0)
            same = same + lane.cast("int")
    return F.when(x[0].isNull() & y[0].isNull(), F.lit(1.0)).otherwise(F.coalesce(same / F.lit(float(samples)), F.lit(0.0)))


def as_text(x: Column, samples: int = SAMPLES) -> Column:
    """Lower-case hex, four digits per sample."""
    return F.when(x[0].isNull(), F.lit("")).otherwise(
        F.lower(F.concat(*[F.lpad(F.hex(x[i]), 16, "0") for i in range(samples // LANES)]))
    )


def fingerprint(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next: a row per row of ``docs``."""
    narrow = identified(docs).select("doc_id", *KEY, F.length("text").cast("long").alias("n_chars"))
    order = written(in_order(narrow), "fp-next")
    texts = with_edited(docs, order)
    hashed = texts.select(*KEY, F.sha2("edited", 256).alias("edited_sha256"))
    prints = written(sampled(term_weights(texts), samples).join(hashed, KEY, "right"), "fp-prints")
    a, b = prints.alias("a"), prints.select(F.col("a").alias("next_a"), F.col("b").alias("next_b"), F.col("f0").alias("next_f0"))
    met = order.join(a, KEY).join(b, ["next_a", "next_b"])
    found = met.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text(F.col("f0"), samples).alias("fingerprint"),
        as_text(F.col("f1"), samples).alias("edited_fingerprint"),
        likeness(F.col("f0"), F.col("f1"), samples).alias("near_edited"),
        likeness(F.col("f0"), F.col("next_f0"), samples).alias("near_next"),
        "copies",
    )
    return found.withColumn("copies", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).drop("copies")

"""Near-duplicate documents by MinHash with tensored banding.

Every document has two small collections of keys; a key combines a few minhash
values. The table keys are all pairs of a key of one collection and a key of
the other, so ``tables`` squared tables need only ``2 * tables`` keys, and the
minhash work is about the square root of what independent tables need.

1. Documents with equal shingle sets become one class, by a digest of the set.
   Buckets with the same members are one bucket.
2. A few rounds of stars: each bucket compares its members with a centre, unless
   both are in one component by now. The centre is the member whose keys are the
   most common, and one that was none in the rounds before: of edited copies,
   those with few edits. Pairs whose signatures agree too little are left out
   before any shingle set is moved, the rest is settled on full shingle sets. So
   a large group of near copies costs at most a pair per member, bucket and round.
3. Only buckets with members of several components can still hide links. Their
   members are joined on the rarest shingles of their sets: two sets that are
   similar enough share one of the first (1 - percent) of their shingles in
   whatever order all sets follow, and with the rare ones first a text that
   resembles a group without being linked has shingles there that the group has
   not. Sizes and places of the shared shingle rule out most of the rest; what
   is left is settled on full sets. A shingle's first node in each component
   goes first, and only nodes of different components after that meet the rest.
   That is exact, however large the bucket.

Texts and sets are wide, and most are not asked for. Which ones are is marked in
a bitmap of fixed size, so the others stay where they are at every size of the
corpus; a few unasked ones that share a bit come along and meet nobody in the
joins that follow.

Recall: a pair with similarity J meets in a table with probability
(1 - (1 - J^rows)^tables)^2. With rows = 2 and tables = 9 that is above 0.9997
at J = 0.8 and above 0.99999 at 0.9. ``rows`` should grow with the corpus, so
that unlike documents stay rare in buckets. The signature filter lets J = 0.8
pass but for about 3 in 10^6 (four and a half deviations).

Defined results: a NULL text counts as empty; a document without words has no
shingles, is linked with nothing and is kept; with fewer words than a shingle
takes, the whole sequence is one shingle; rows that repeat an id are one
document and linked; a row without an id is linked with nothing and kept, its
component is NULL. Only the id and the text are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgrain.llm import common
from loomgrain.llm.arrow import ROWS_AT_ONCE, map_texts, small_batches
from loomgrain.llm.components import components

SHINGLE = 5
TABLES = 9
ROWS = 2
PERCENT = 80
# share of agreeing minhash values below which a pair cannot be at 0.8 but with negligible probability
LEAST_SHARE = 0.5
STARS = 3
# keys of so many classes are counted in one task: a class has tables * tables of them, and most are its own
CLASSES_AT_ONCE = 4000
# how often shingles occur is counted in so many cells by their hash: a fixed size that all tasks are sent
CELLS = 1 << 20
# which nodes are asked for is marked in 2 ** MARKS bits by their hash: again a fixed size that all tasks are sent
MARKS = 25
SEED = 20260101
GONE = "_near_duplicate_id"


def written(df: DataFrame, label: str) -> DataFrame:
    with small_batches(df.sparkSession):
        return common.written(df, label)


def shingle_hashes(text: str | None, size: int):
    """The set of shingles as sorted 64-bit hashes."""
    import numpy as np
    import xxhash

    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < size:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.get(w) or known.setdefault(w, xxhash.xxh64_intdigest(w) | 1) for w in words), np.uint64, len(words))
    mixed = np.zeros(len(words) - size + 1, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(size):
            # order matters: each word's hash is mixed in after a multiplication and a shift
            mixed = (mixed ^ ids[i : i + len(mixed)]) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def minhash_constants(count: int):
    import numpy as np

    draws = np.random.Generator(np.random.PCG64(SEED)).integers(0, 2**64, size=(2, count), dtype=np.uint64)
    return draws[0] | np.uint64(1), draws[1]


def signer(count: int):
    """The function from a set of shingles to ``count`` minhash values."""
    import numpy as np

    odd, shift = minhash_constants(count)

    def sign(shingles):
        least = np.full(count, 2**64 - 1, np.uint64)
        with np.errstate(over="ignore"):
            for first in range(0, len(shingles), 2048):
                part = shingles[first : first + 2048]
                least = np.minimum(least, (part[:, None] * odd + shift).min(axis=0))
        # the high half decides the minimum; 32 bits of it name the value
        return (least >> np.uint64(32)).astype(np.uint32).astype(np.int32).tolist()

    return sign


def signatures(docs: DataFrame, size: int, tables: int, rows: int) -> DataFrame:
    """doc_id, n_shingles, digest of the set, signature: 2 * tables * rows minhash values; without shingles both are NULL."""
    count = 2 * tables * rows
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def start():
        import xxhash

        sign = signer(count)

        def each(key, text):
            shingles = shingle_hashes(text, size)
            if not len(shingles):
                return (key, 0, None, None)
            return (key, len(shingles), xxhash.xxh3_128_digest(shingles.tobytes()), sign(shingles))

        return each

    schema = f"doc_id {id_type}, n_shingles long, digest binary, signature array<int>"
    return map_texts(docs.select("doc_id", "text"), schema, start)


def places(nodes):
    """The word of the bitmap and the bit in it that stand for each node."""
    import numpy as np

    cell = (nodes.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - MARKS)
    return (cell >> np.uint64(6)).astype(np.int64), np.uint64(1) << (cell & np.uint64(63))


def marks(nodes: DataFrame):
    """The bitmap of ``nodes``; at most a row per word of it comes to the driver."""
    import numpy as np

    words = 1 << MARKS - 6

    def work(batches):
        import pyarrow as pa

        bits = np.zeros(words, np.uint64)
        for batch in batches:
            word, bit = places(batch.column(0).to_numpy())
            np.bitwise_or.at(bits, word, bit)
        word = np.flatnonzero(bits)
        yield pa.RecordBatch.from_arrays([pa.array(word, pa.int64()), pa.array(bits[word].view(np.int64))], names=["word", "bits"])

    found = nodes.select("node").mapInArrow(work, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    bits = np.zeros(words, np.uint64)
    bits[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return bits


def asked_for(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """The ``rows`` whose node is one of ``nodes``, and the few whose node shares a bit with one; nothing is shuffled."""
    shared = rows.sparkSession.sparkContext.broadcast(marks(nodes))
    rows = rows.where("node IS NOT NULL")
    place = rows.columns.index("node")

    def work(batches):
        import pyarrow as pa

        bits = shared.value
        for batch in batches:
            # rows are wide: a few at a time are copied
            for first in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(first, ROWS_AT_ONCE)
                word, bit = places(part.column(place).to_numpy())
                yield part.filter(pa.array((bits[word] & bit) != 0))

    return rows.mapInArrow(work, rows.schema)


def shingle_sets(docs: DataFrame, nodes: DataFrame, size: int, tables: int, rows: int) -> DataFrame:
    """node, n, shingles and signature of the classes in ``nodes`` and of a few others, read from their representatives' texts."""

    count = 2 * tables * rows

    def start():
        sign = signer(count)

        def each(key, text):
            shingles = shingle_hashes(text, size)
            return key, len(shingles), sign(shingles), shingles.view("int64").tolist()

        return each

    # an id with several texts has several classes
    texts = asked_for(docs.select(F.col("doc_id").cast("long").alias("node"), "text"), nodes)
    found = map_texts(texts, "node long, n long, signature array<int>, shingles array<long>", start)
    return found.where("n > 0")


def table_keys(classes: DataFrame, tables: int, rows: int) -> DataFrame:
    """key, node: the pairs of the two collections' keys, one row per table and class."""
    spans = [[F.xxhash64(*[F.col("signature")[c * tables * rows + t * rows + r] for r in range(rows)]) for t in range(tables)] for c in (0, 1)]
    first, second = (F.array(*keys) for keys in spans)
    pairs = F.flatten(F.transform(first, lambda a, i: F.transform(second, lambda b, j: F.xxhash64(a, b, i, j))))
    return classes.select("node", F.explode(pairs).alias("key"))


def agreement(a, b):
    """Share of equal minhash values."""
    same = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    return same / F.size(a)


def sides(sets: DataFrame, *columns: str) -> tuple[DataFrame, DataFrame]:
    """``columns`` of ``sets`` for the first and for the second node of a pair."""
    return tuple(sets.select(F.col("node").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in columns]) for side in "ab")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar enough.

    Sizes and signatures are looked at before the sets are moved: the smaller
    set cannot hold more than all of itself.
    """
    x, y = sides(sets, "n", "signature")
    likely = (F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent) & (
        agreement(F.col("signature_a"), F.col("signature_b")) >= LEAST_SHARE
    )
    pairs = written(pairs.select("a", "b").join(x, "a").join(y, "b").where(likely).select("a", "b").distinct(), "near-likely")
    nodes = pairs.select(F.col("a").alias("node")).unionAll(pairs.select(F.col("b").alias("node")))
    x, y = sides(asked_for(sets.select("node", "n", "shingles"), nodes), "n", "shingles")
    met = pairs.join(x, "a").join(y, "b").select(
        "a", "b", (F.col("n_a") + F.col("n_b")).alias("sizes"), F.size(F.array_intersect("shingles_a", "shingles_b")).alias("both")
    )
    return written(met.where(F.col("both") * 100 >= percent * (F.col("sizes") - F.col("both"))).select("a", "b").distinct(), "near-links")


def bucket_members(classes: DataFrame, tables: int, rows: int) -> DataFrame:
    """key, n, node of the buckets with several classes, n of them; buckets with the same members are kept once."""
    keys = table_keys(classes, tables, rows)
    # copies of a key meet in the partial aggregate, so a key of a third of all classes is no hot key here
    members = [F.bit_xor(F.xxhash64("node", F.lit(i))).alias(f"members_{i}") for i in (0, 1)]
    dealt = classes.repartition(max(1, -(-classes.count() // CLASSES_AT_ONCE)), "node")
    counted = table_keys(dealt, tables, rows).groupBy("key").agg(F.count(F.lit(1)).alias("n"), *members).where("n > 1")
    once = written(counted.groupBy("n", "members_0", "members_1").agg(F.min("key").alias("key")).select("key", "n"), "near-buckets")
    # one row per key on the right: a hot key's rows can be split
    return written(keys.join(once, "key"), "near-members")


def star_pairs(members: DataFrame, common: DataFrame, belongs: DataFrame | None, used: DataFrame | None, draw: int) -> DataFrame:
    """a, b, a_leads, b_leads: each bucket's centre in this draw with the members of other components, and which of both is a centre.

    The centre is the member with the most ``common`` keys of those that were
    none yet: among edited copies that is one with few edits, which is linked
    with most of the others.
    """
    nodes = common.withColumn("component", F.col("node")) if belongs is None else in_components(common, belongs)
    if used is None:
        nodes = nodes.withColumn("used", F.lit(False))
    else:
        nodes = nodes.join(used.withColumn("used", F.lit(True)), "node", "left").withColumn("used", F.coalesce("used", F.lit(False)))
    placed = members.select("key", "node").join(nodes, "node")
    order = ["used", (-F.col("common")).alias("rare"), F.xxhash64("node", F.lit(draw)), F.col("node").alias("centre"), F.col("component").alias("own")]
    centres = (
        placed.groupBy("key")
        .agg(F.min(F.struct(*order)).alias("c"), F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low < high")
        .select("key", "c.centre", "c.own")
    )
    met = placed.join(centres, "key").where("component != own").select("centre", F.least("centre", "node").alias("a"), F.greatest("centre", "node").alias("b"))
    leads = [F.bool_or(F.col("centre") == F.col(side)).alias(f"{side}_leads") for side in "ab"]
    return met.groupBy("a", "b").agg(*leads)


def in_components(rows: DataFrame, belongs: DataFrame) -> DataFrame:
    """``rows`` with the component of their node, which is the node itself where nothing is linked with it."""
    return rows.join(belongs, "node", "left").withColumn("component", F.coalesce("component", "node"))


def cell_counts(sets: DataFrame, cells: int):
    """How many of ``sets`` have a shingle of each cell; at most ``cells`` narrow rows come to the driver."""
    import numpy as np

    def work(batches):
        import pyarrow as pa

        counts = np.zeros(cells, np.int64)
        for batch in batches:
            flat = batch.column(0).flatten().to_numpy()
            counts += np.bincount(flat & (cells - 1), minlength=cells)
        cell = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int64()), pa.array(counts[cell], pa.int64())], names=["cell", "n"])

    with small_batches(sets.sparkSession):
        found = sets.select("shingles").mapInArrow(work, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(cells, np.int64)
    counts[found["cell"].to_numpy()] = found["n"].to_numpy()
    return counts


def rarest(sets: DataFrame, percent: int, cells: int) -> DataFrame:
    """node, n, shingle, place: the shingles of each set of which a similar set must have one, rarest first."""
    shared = sets.sparkSession.sparkContext.broadcast(cell_counts(sets, cells))

    def work(batches):
        import numpy as np
        import pyarrow as pa

        counts = shared.value
        for batch in batches:
            for first in range(0, batch.num_rows, 64):
                part = batch.slice(first, 64)
                nodes, sizes, shingles, places = [], [], [], []
                for node, values in zip(part.column(0).to_pylist(), part.column(1)):
                    values = values.values.to_numpy()
                    n = len(values)
                    least = -(-n * percent // 100)  # of this set in any that is similar enough
                    order = np.lexsort((values, counts[values & (cells - 1)]))[: n - least + 1]
                    nodes.append(np.full(len(order), node))
                    sizes.append(np.full(len(order), n))
                    shingles.append(values[order])
                    places.append(np.arange(len(order)))
                if nodes:
                    columns = [pa.array(np.concatenate(c), pa.int64()) for c in (nodes, sizes, shingles, places)]
                    yield pa.RecordBatch.from_arrays(columns, names=["node", "n", "shingle", "place"])

    return sets.select("node", "shingles").mapInArrow(work, "node long, n long, shingle long, place long")


def mixed_shingles(members: DataFrame, belongs: DataFrame, sets: DataFrame, percent: int, cells: int) -> DataFrame | None:
    """node, n, shingle, place, component: the rarest shingles of the members of buckets with several components."""
    placed = in_components(members.select("key", "node"), belongs)
    mixed = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("key")
    nodes = written(placed.join(mixed, "key", "left_semi").select("node", "component").distinct(), "near-mixed")
    if nodes.isEmpty():
        return None
    own = written(asked_for(sets.select("node", "shingles"), nodes), "near-mixed-sets")
    return in_several(written(rarest(own, percent, cells).join(nodes, "node"), "near-rarest"))


def in_several(spread: DataFrame) -> DataFrame:
    """The rows of ``spread`` whose shingle occurs in several components."""
    several = spread.groupBy("shingle").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("shingle")
    return written(spread.join(several, "shingle", "left_semi"), "near-shared")


def meetings(spread: DataFrame, percent: int) -> DataFrame:
    """a, b: the nodes of ``spread`` of different components that share a shingle and may be linked."""
    x, y = spread.alias("x"), spread.alias("y")
    # as many shingles as both must share, and as many as are left from the shared one on
    needed = F.ceil((F.col("x.n") + F.col("y.n")) * percent / F.lit(100 + percent) - F.lit(1e-6))
    left = F.least(F.col("x.n") - F.col("x.place"), F.col("y.n") - F.col("y.place"))
    return x.join(
        y,
        (F.col("x.shingle") == F.col("y.shingle"))
        & (F.col("x.node") < F.col("y.node"))
        & (F.col("x.component") != F.col("y.component"))
        & (F.least("x.n", "y.n") * 100 >= F.greatest("x.n", "y.n") * percent)
        & (left >= needed),
    ).select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()


def component_heads(spread: DataFrame) -> DataFrame:
    """``spread`` with one node for each shingle and component: where it comes first, as in copies with few edits."""
    head = F.min(F.struct("place", "node", "n")).alias("h")
    return spread.groupBy("shingle", "component").agg(head).select("h.node", "h.n", "shingle", "h.place", "component")


def links(docs: DataFrame, classes: DataFrame, size: int, tables: int, rows: int, percent: int, stars: int = STARS, cells: int = CELLS) -> DataFrame:
    """a, b: enough links between classes to give every component."""
    members = bucket_members(classes, tables, rows)
    common = written(members.groupBy("node").agg(F.sum("n").alias("common")), "near-common")
    sets = written(shingle_sets(docs, members, size, tables, rows), "near-sets")
    linked, belongs, seen, used = None, None, None, None
    for draw in range(stars):
        pairs = star_pairs(members, common, belongs, used, draw)
        if seen is not None:
            pairs = pairs.join(seen, ["a", "b"], "left_anti")
        pairs = written(pairs, "near-star")
        led = pairs.where("a_leads").select(F.col("a").alias("node")).unionAll(pairs.where("b_leads").select(F.col("b").alias("node")))
        used = led.distinct() if used is None else used.unionAll(led).distinct()
        pairs = pairs.select("a", "b")
        seen = pairs if seen is None else seen.unionAll(pairs)
        found = verified(pairs, sets, percent)
        linked = found if linked is None else linked.unionAll(found)
        belongs = components(linked)
    spread = mixed_shingles(members, belongs, sets, percent, cells)
    if spread is None:
        return linked
    # a node that is linked with a head of a large component need not meet the others
    heads = written(component_heads(spread), "near-heads")
    first = written(meetings(heads, percent).join(seen, ["a", "b"], "left_anti"), "near-first")
    found = verified(first, sets, percent)
    if not found.isEmpty():
        linked, seen = linked.unionAll(found), seen.unionAll(first)
        spread = in_several(in_components(spread.drop("component"), components(linked)))
    again = written(meetings(spread, percent).join(seen, ["a", "b"], "left_anti"), "near-again")
    return linked.unionAll(verified(again, sets, percent))


def near_duplicates(
    docs: DataFrame, size: int = SHINGLE, tables: int = TABLES, rows: int = ROWS, percent: int = PERCENT
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per row of ``docs``."""
    signed = written(signatures(docs, size, tables, rows), "near-signatures")
    usable = signed.where(F.col("digest").isNotNull() & F.col("doc_id").isNotNull())
    classes = written(
        usable.groupBy("digest").agg(F.min("doc_id").cast("long").alias("node"), F.first("signature").alias("signature")),
        "near-classes",
    )
    members = written(
        usable.select("doc_id", "digest").join(classes.select("digest", "node"), "digest").select("doc_id", "node"), "near-of-class"
    )
    # an id that occurs with several texts links their classes
    several = members.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a < b").select("doc_id", "a")
    by_id = members.join(several, "doc_id").where("node > a").select("a", F.col("node").alias("b"))
    found = components(links(docs, classes, size, tables, rows, percent).unionAll(by_id))
    whole = members.join(found, "node", "left").select(
        F.col("doc_id").alias("id"), F.coalesce("component", "node").alias("component_id")
    )
    # a document is listed once here; its class's smallest id is the component's when no link leads lower
    whole = whole.groupBy("id").agg(F.min("component_id").alias("component_id"))
    return (
        signed.join(whole, F.col("doc_id") == F.col("id"), "left")
        .select("doc_id", "n_shingles", F.coalesce("component_id", F.col("doc_id").cast("long")).alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def keep_one_each(docs: DataFrame, size: int = SHINGLE, tables: int = TABLES, rows: int = ROWS, percent: int = PERCENT) -> DataFrame:
    """``docs`` without the documents that are not their component's first; columns as they came."""
    found = near_duplicates(docs, size, tables, rows, percent)
    gone = written(found.where("NOT kept").select(F.col("doc_id").alias(GONE)).distinct(), "near-gone")
    return docs.join(gone, F.col("doc_id") == F.col(GONE), "left_anti")

"""Phrase collocations mined by partitioning: local mining, union, one exact count.

1. The documents are dealt to ``SHARDS`` logical shards, each mined completely
   by as many tasks as it has input. A phrase that occurs ``support`` times in
   all occurs at least ``support / SHARDS`` times in one of them, so phrases
   below that in every shard cannot be frequent.
2. The locally frequent phrases of all shards are united, as hashes. Equal
   hashes of unlike phrases only add candidates.
3. A second pass counts the candidates, and these alone, exactly and by their
   words. What is left of false candidates falls to the support.

The support is an absolute count, so the number of shards is fixed: with more
than ``support`` of them one occurrence would be locally frequent and nothing
would be left out. Tasks combine their occurrences over some MB of text before
anything is shuffled, so the commonest phrase sends a row per such block, and
Spark combines these per task once more.

The second pass knows the candidates by a bit table of fixed size
(``FILTER_BITS``), which is sent to all tasks. With more candidates than it
tells apart well they are joined by their hash instead. Which way is taken
decides the cost and never the result.

Defined results: a NULL text counts as empty, a NULL language as ``und``; rows
that repeat an id count each; a language without a candidate has no rows; no
rows give no rows. Only id, language and text are read, and the id only to deal
documents to shards. Score ties go to the higher count, then to the phrase's
bytes.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomgrain.llm.common import shuffle_partitions, written
from loomgrain.operators.ranking import top_per_group
from loomgrain.operators.skew import skew_join

SUPPORT = 10
LONGEST = 3
SHARDS = 4
FIRST = 2000
INSIDE_PERCENT = 50
SCALE = 1_000_000
UNKNOWN = "und"

BLOCK_BYTES = 4 << 20
PART_BYTES = 16 << 20  # text whose phrases are counted in one part
FILTER_BITS = 1 << 26
BITS_PER_KEY = 8
PROBES = 4
BROADCAST = 32 << 20

# all marks that end a piece become one, and tabs blanks; only blanks are left to split at
MARK = b"."
SAME = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t", MARK * 10 + b" ")
MIX = np.uint64(0x9E3779B97F4A7C15)
NONE = np.zeros(0, np.uint64)
LOW_BITS, LOW_HALF = np.uint64(32), np.uint64(0xFFFFFFFF)
MOST_CODES = 1 << 62


def words_of(texts: list[bytes]) -> list[bytes]:
    """The words of all texts in turn, with MARK between pieces."""
    return MARK.join(texts).lower().translate(SAME).replace(MARK, b" . ").split()


class Phrases:
    """The phrases of a block of texts.

    Words have numbers, and the code of a phrase is that of the phrase without
    its last word, times the number of words, plus the last one: exact. Codes
    that would grow too large are numbered anew first.
    """

    def __init__(self, texts: list[bytes]):
        words = words_of(texts)
        numbers = {MARK: 0}
        for word in dict.fromkeys(words):
            numbers.setdefault(word, len(numbers))
        self.vocabulary = list(numbers)
        self.size = len(self.vocabulary)
        self.ids = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
        self.words = int((self.ids != 0).sum())
        self.renamed = {}

    def levels(self, longest: int):
        """The codes of the phrases of 1, 2, ... words, each with its count."""
        codes, most, whole = self.ids, self.size, self.ids != 0
        for length in range(1, longest + 1):
            if length > 1:
                if most * self.size >= MOST_CODES:
                    self.renamed[length - 1], codes = np.unique(codes, return_inverse=True)
                    most = len(self.renamed[length - 1])
                whole = whole[:-1] & (self.ids[length - 1 :] != 0)
                codes = codes[:-1] * self.size + self.ids[length - 1 :]
                most *= self.size
            yield np.unique(codes[whole], return_counts=True)

    def members(self, length: int, codes) -> list:
        """The words' numbers, one array per place in the phrase."""
        if length == 1:
            return [codes]
        left, last = np.divmod(codes, self.size)
        if length - 1 in self.renamed:
            left = self.renamed[length - 1][left]
        return [*self.members(length - 1, left), last]

    def hash_words(self):
        import xxhash

        self.word_hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, self.vocabulary), np.uint64, self.size)

    def hashes(self, members, seed: int):
        """A hash per phrase that depends on the words, their order and the seed."""
        state = np.full(len(members[0]), seed, np.uint64)
        for numbers in members:
            state = with_word(state, self.word_hashes[numbers])
        return state

    def all_hashes(self, longest: int, seed: int):
        """The hash of every occurrence of every phrase."""
        here, whole = self.word_hashes[self.ids], self.ids != 0
        state, found = np.full(len(here), seed, np.uint64), []
        for length in range(1, min(longest, len(here)) + 1):
            if length > 1:
                whole, state = whole[:-1] & (self.ids[length - 1 :] != 0), state[:-1]
            state = with_word(state, here[length - 1 :])
            found.append(state[whole])
        return found

    def texts(self, members) -> list[bytes]:
        look = self.vocabulary.__getitem__
        return list(map(b" ".join, zip(*[map(look, numbers.tolist()) for numbers in members])))


def with_word(state, word_hashes):
    with np.errstate(over="ignore"):
        state = (state ^ word_hashes) * MIX
    return state ^ (state >> np.uint64(31))


def keys_of(hashes, parts: int):
    """The part a phrase is counted in above the 32 bits that name it there: there are as many parts as the input needs."""
    return ((hashes >> LOW_BITS) % np.uint64(parts)) << LOW_BITS | hashes & LOW_HALF


def runs(values):
    """Where each run of equal values begins."""
    return np.flatnonzero(np.concatenate([np.ones(min(1, len(values)), bool), values[1:] != values[:-1]]))


def seed_of(lang: str) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(lang.encode("utf-8"))


def blocks(batches):
    """Blocks of about BLOCK_BYTES, each the texts of its keys; rows are (text, *key)."""
    held, size = {}, 0
    for batch in batches:
        for first in range(0, batch.num_rows, 256):
            columns = [c.to_pylist() for c in batch.slice(first, 256).columns]
            for text, *key in zip(*columns):
                data = (text or "").encode("utf-8")
                held.setdefault(tuple(key), []).append(data)
                size += len(data)
                if size >= BLOCK_BYTES:
                    yield held
                    held, size = {}, 0
    if held:
        yield held


def language(name: str = "lang") -> Column:
    return F.coalesce(F.col(name), F.lit(UNKNOWN)).alias("lang")


def parts_for(docs: DataFrame) -> int:
    """Parts in which the phrases are counted, by the bytes of all texts."""
    size = docs.agg(F.sum(F.octet_length("text").cast("long")).alias("size")).first()["size"] or 0
    return max(shuffle_partitions(docs.sparkSession), -(-size // PART_BYTES))


def locally_frequent(docs: DataFrame, support: int, longest: int, shards: int, parts: int) -> DataFrame:
    """key: phrases that reach their share of the support in some shard.

    What moves is a row per block of text, shard and part, with the phrases'
    keys and counts as packed numbers, not a row per phrase. A part holds the
    phrases of about PART_BYTES of text, whatever the input's size.
    """
    least = -(-support // shards)

    def packed(batches):
        import pyarrow as pa

        for block in blocks(batches):
            by_shard = {}
            for (lang, shard), texts in block.items():
                found = Phrases(texts)
                found.hash_words()
                by_shard.setdefault(shard, []).extend(found.all_hashes(longest, seed_of(lang)))
            rows = []
            for shard, hashes in by_shard.items():
                keys, counts = np.unique(keys_of(np.concatenate([NONE, *hashes]), parts), return_counts=True)
                of_part = keys >> LOW_BITS
                starts = runs(of_part)
                small, counts = keys.astype(np.uint32), counts.astype(np.uint32)
                for first, last in zip(starts.tolist(), [*starts[1:].tolist(), len(keys)]):
                    rows.append((shard, int(of_part[first]), small[first:last].tobytes(), counts[first:last].tobytes()))
            if rows:
                columns = zip(zip(*rows), (pa.int32(), pa.int64(), pa.binary(), pa.binary()))
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in columns], names=["shard", "part", "keys", "counts"])

    def frequent(group):
        import pyarrow as pa

        part, shard = group["part"][0].as_py(), group["shard"].to_numpy()
        united = NONE
        for each in np.unique(shard):
            own = group.filter(pa.array(shard == each))
            keys, counts = (np.frombuffer(b"".join(own[name].to_pylist()), np.uint32).astype(np.uint64) for name in ("keys", "counts"))
            both = np.sort(keys << LOW_BITS | counts)
            starts = runs(both >> LOW_BITS)
            sums = np.add.reduceat(both & LOW_HALF, starts)
            united = np.union1d(united, (both >> LOW_BITS)[starts[sums >= least]])
        return pa.table({"key": (united | np.uint64(part) << LOW_BITS).view(np.int64)})

    dealt = docs.select("text", language(), F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int").alias("shard"))
    blobs = dealt.mapInArrow(packed, "shard int, part long, keys binary, counts binary")
    return blobs.groupBy("part").applyInArrow(frequent, "key long")


def spots(keys, bits: int):
    """The PROBES places of each key in a table of ``bits`` bits."""
    with np.errstate(over="ignore"):
        mixed = (keys ^ (keys >> np.uint64(29))) * MIX
    start, step = mixed >> LOW_BITS, (mixed & LOW_HALF) | np.uint64(1)
    return [(start + step * np.uint64(i)) & np.uint64(bits - 1) for i in range(PROBES)]


def bit_table(candidates: DataFrame, bits: int):
    """The candidates as uint64 words; at most ``bits`` / 64 rows come to the driver."""

    def placed(batches):
        import pyarrow as pa

        for batch in batches:
            places = np.unique(np.concatenate([NONE, *spots(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64), bits)]))
            if len(places):
                words = places >> np.uint64(6)
                starts = runs(words)
                masks = np.bitwise_or.reduceat(np.uint64(1) << (places & np.uint64(63)), starts)
                yield pa.RecordBatch.from_arrays([pa.array(words[starts].view(np.int64)), pa.array(masks.view(np.int64))], names=["word", "bits"])

    rows = candidates.select("key").mapInArrow(placed, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    table = np.zeros(bits // 64, np.uint64)
    table[rows["word"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return table


def maybe_in(table, keys):
    """Which of ``keys`` may be in the table: all that are, and few others."""
    found = np.ones(len(keys), bool)
    for spot in spots(keys, len(table) * 64):
        found &= (table[spot >> np.uint64(6)] >> (spot & np.uint64(63))) & np.uint64(1) == 1
    return found


def exact_counts(docs: DataFrame, candidates: DataFrame, support: int, longest: int, parts: int, filter_bits: int) -> DataFrame:
    """lang, words, phrase, f of the frequent phrases, and a row per language with words 0 and its number of words."""
    spark = docs.sparkSession
    told_apart = candidates.count() * BITS_PER_KEY <= filter_bits
    shared = spark.sparkContext.broadcast(bit_table(candidates, filter_bits)) if told_apart else None
    schema = "lang string, words int, phrase string, n long" + ("" if told_apart else ", key long")

    def work(batches):
        import pyarrow as pa

        def rows(lang, words, phrases, counts, keys):
            columns = [pa.array([lang] * len(counts), pa.string()), pa.array(np.full(len(counts), words, np.int32))]
            columns += [pa.array(phrases, pa.binary()).view(pa.string()), pa.array(counts, pa.int64())]
            names = ["lang", "words", "phrase", "n"]
            if not told_apart:
                columns.append(pa.array(keys, pa.int64()))
                names.append("key")
            return pa.RecordBatch.from_arrays(columns, names=names)

        for (lang,), texts in (item for block in blocks(batches) for item in block.items()):
            found = Phrases(texts)
            found.hash_words()
            yield rows(lang, 0, [b""], [found.words], [None])
            seed = seed_of(lang)
            for length, (codes, counts) in enumerate(found.levels(longest), 1):
                members = found.members(length, codes)
                keys = keys_of(found.hashes(members, seed), parts)
                if told_apart:
                    kept = np.flatnonzero(maybe_in(shared.value, keys))
                    members, counts, keys = [m[kept] for m in members], counts[kept], keys[kept]
                if len(counts):
                    yield rows(lang, length, found.texts(members), counts, keys.view(np.int64))

    counted = docs.select("text", language()).mapInArrow(work, schema)
    if not told_apart:
        totals = counted.where("words = 0").drop("key")
        # a common phrase has a row per block: its rows can be split, as the other side has one
        counted = counted.where("words > 0").join(candidates, "key", "left_semi").drop("key").unionAll(totals)
    summed = counted.groupBy("lang", "words", "phrase").agg(F.sum("n").alias("f"))
    return summed.where((F.col("f") >= support) | (F.col("words") == 0))


def strength(a: Column, left: Column, right: Column, scale: int = SCALE) -> Column:
    """floor(scale * a * a / (left * right)), exact: up to 38 digits."""
    a, left, right = (x.cast("decimal(18,0)") for x in (a, left, right))
    whole, parts = F.lit(scale).cast("decimal(7,0)") * (a * a), left * right
    return F.call_function("div", whole, parts)


def scored(counts: DataFrame, scale: int = SCALE) -> DataFrame:
    """lang, phrase, words, a, l, r, score of every candidate: its weakest cut, the first of equal ones."""
    single = counts.where("words > 0").select("lang", "phrase", "f")
    cuts = (
        counts.where("words > 1")
        .select("lang", "phrase", "words", F.col("f").alias("a"), F.explode(F.expr("sequence(1, words - 1)")).alias("k"))
        .withColumn("parts", F.split("phrase", " "))
        .select(
            "lang", "phrase", "words", "a", "k",
            F.array_join(F.expr("slice(parts, 1, k)"), " ").alias("first"),
            F.array_join(F.expr("slice(parts, k + 1, words - k)"), " ").alias("rest"),
        )
    )
    # each part occurs at least as often as the whole, so it is among the counts: a row per cut before and after;
    # keys are counted on the cuts as they are, as counting them on the first join would compute it again
    joined = cuts
    for part, name in (("first", "l"), ("rest", "r")):
        counted = single.select("lang", F.col("phrase").alias(part), F.col("f").alias(name))
        joined = skew_join(joined, counted, ["lang", part], broadcast_bytes=BROADCAST, count_on=cuts)
    weakest = F.min(F.struct(strength(F.col("a"), F.col("l"), F.col("r"), scale).alias("score"), "k", "l", "r"))
    return joined.groupBy("lang", "phrase", "words", "a").agg(weakest.alias("cut")).select(
        "lang", "phrase", "words", "a", "cut.l", "cut.r", "cut.score"
    )


def inside_longer(counts: DataFrame) -> DataFrame:
    """lang, phrase, longer: the count of the commonest candidate that a shorter one's words lie in."""
    spans = F.expr("flatten(transform(sequence(2, words - 1), n -> transform(sequence(1, words - n + 1), i -> array_join(slice(parts, i, n), ' '))))")
    longer = counts.where("words > 2").withColumn("parts", F.split("phrase", " "))
    return longer.select("lang", F.explode(spans).alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("longer"))


def collocations(
    docs: DataFrame,
    support: int = SUPPORT,
    longest: int = LONGEST,
    first: int = FIRST,
    shards: int = SHARDS,
    inside_percent: int = INSIDE_PERCENT,
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``first`` strongest phrases of 2 to ``longest`` words."""
    parts = parts_for(docs)
    candidates = written(locally_frequent(docs, support, longest, shards, parts), "phrase-candidates")
    counts = written(exact_counts(docs, candidates, support, longest, parts, filter_bits), "phrase-counts")
    found = scored(counts).join(inside_longer(counts), ["lang", "phrase"], "left")
    kept = found.where(F.coalesce(F.col("longer") * 100 < F.col("a") * inside_percent, F.lit(True))).drop("longer", "words")
    order = [("score", "desc"), ("a", "desc"), ("phrase", "asc")]
    best = top_per_group(kept, ["lang"], order, first)
    place = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    sizes = counts.where("words = 0").select("lang", F.col("f").alias("n"))
    return (
        best.withColumn("rank", F.row_number().over(place).cast("long"))
        .join(sizes, "lang")
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )

"""Near duplicates, packing and the pipeline: brute force, round trips, odd tables."""

import collections
import random
import zlib

import numpy as np
import pytest
from cases import clashing, empty, odd, odd_rows, prose

import corpus_pipeline
from loomgrain.llm import exact_dedup, mixing, near_dedup, packing, quality
from loomgrain.llm.queries import QUERIES, tokenizer_path


def shingles(text, size):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def classes_by_hand(rows, size):
    """Component of each id by comparing all pairs of sets."""
    sets = {i: shingles(t, size) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for x in ids:
        for y in ids:
            if x < y and sets[x] and sets[y]:
                both = len(sets[x] & sets[y])
                if 100 * both >= 80 * (len(sets[x]) + len(sets[y]) - both):
                    a, b = root(x), root(y)
                    parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), root(i)) for i in ids}


def edited_copies(count, words, edits, seed):
    draw = random.Random(seed)
    base = prose(seed, words).split()
    for n in range(count):
        copy = list(base)
        for _ in range(draw.randint(0, edits)):
            copy[draw.randrange(len(copy))] = f"w{draw.randrange(10**6)}"
        yield " ".join(copy)


@pytest.mark.parametrize("size", [2, 5])
def test_components_equal_comparing_all_pairs(spark, size):
    texts = [prose(100 + i, 20 + i % 50) for i in range(80)]
    # groups whose members are linked with some of the others only
    for seed in range(6):
        texts += edited_copies(15, 45 * size, 7, seed)
    texts += ["", "  ", "a", "a", "a b", "A  B"]
    rows = list(enumerate(texts))
    random.Random(1).shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dedup.near_duplicates(docs, size=size).collect()}
    assert found == classes_by_hand(rows, size)
    assert len({c for _, c in found.values()}) < len(rows) - 30


def test_query_against_comparing_all_pairs(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in QUERIES["op5_near_dedup"](spark, folder).collect()}
    assert found == {i: (n, c, c == i) for i, (n, c) in classes_by_hand(rows, 2).items()}


def test_near_dedup_of_odd_rows(spark):
    docs = clashing(odd(spark))
    found = near_dedup.near_duplicates(docs).collect()
    assert sorted(str(r["doc_id"]) for r in found) == sorted(str(r[0]) for r in odd_rows())
    assert {r["component_id"] for r in found if r["doc_id"] in (1, 2)} == {1}
    assert all(r["component_id"] == r["doc_id"] for r in found if r["doc_id"] in (3, 4, 5, 7))
    kept = near_dedup.keep_one_each(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.select("doc_id").collect()} == {1, 3, 4, 5, 6, 7, 8, 9, None}
    assert near_dedup.near_duplicates(empty(spark)).count() == 0


@pytest.mark.parametrize("lengths", [[], [1], [5000, 3, 4096, 10_000, 1], [random.Random(2).randint(1, 9000) for _ in range(200)], [1] * 300])
def test_pack_uses_each_token_once_without_padding(lengths):
    sequences = packing.pack(lengths)
    used = collections.Counter()
    for sequence in sequences:
        total = sum(n for _, _, n in sequence)
        assert 0 < total <= packing.WINDOW and total & (total - 1) == 0
        for document, start, n in sequence:
            assert n > 0
            used.update((document, at) for at in range(start, start + n))
    assert used == collections.Counter((d, at) for d, n in enumerate(lengths) for at in range(n))


def test_step_groups_have_like_costs():
    sequences = packing.pack([random.Random(3).randint(1, 5000) for _ in range(400)])
    groups = packing.step_groups(sequences)
    costs = collections.Counter()
    for sequence, group in zip(sequences, groups):
        costs[group] += sum(n * n for _, _, n in sequence)
    assert max(costs.values()) < 1.5 * min(costs.values())


def pieces_are_whole(found, texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    by_document, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in found:
        by_document[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, text in texts.items():
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], np.uint32)
        at = 0
        for r in sorted(by_document[i], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    for placed in by_sequence.values():
        end = 0
        for offset, length in sorted(placed):
            assert offset == end
            end += length
        assert end <= packing.WINDOW and end & (end - 1) == 0


def test_packing_query_is_a_round_trip(spark, folder):
    texts = dict(map(tuple, spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()))
    pieces_are_whole(QUERIES["op10_packing"](spark, folder).collect(), texts)


def test_packing_of_odd_rows(spark):
    docs = clashing(odd(spark).where("doc_id NOT IN (1, 9) OR doc_id IS NULL").dropDuplicates(["doc_id", "text"]))
    docs = docs.where("doc_id IS NOT NULL")
    pieces_are_whole(packing.pack_documents(docs, tokenizer_path()).collect(), {r[0]: r[1] for r in docs.select("doc_id", "text").collect()})
    strange = ["don't STOP İstanbul ΑΣ", "x<|endoftext|>y <|startoftext|>", "\x85a\x1cb c\x00d", "１２ ﬁ ÿŸ", "café a b", "word.'s hello,there foo;;;"]
    rows = spark.createDataFrame(list(enumerate(strange)), "doc_id long, text string")
    pieces_are_whole(packing.pack_documents(rows, tokenizer_path()).collect(), dict(enumerate(strange)))
    whole = packing.pack_documents(odd(spark), tokenizer_path()).where("start = 0")
    assert whole.count() == len(odd_rows())
    assert packing.pack_documents(empty(spark), tokenizer_path()).count() == 0


def test_stages_take_effect(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["quality", "exact_dedup", "near_dedup", "mixing", "packing"]
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    scores = {r["doc_id"]: r["score"] for r in quality.score(docs, quality.fit(docs, labels)).collect()}
    good = steps["quality"](spark, docs, folder)
    ids = lambda df: sorted(r["doc_id"] for r in df.select("doc_id").collect())
    assert good.columns == docs.columns and ids(good) == sorted(i for i, s in scores.items() if s >= quality.ACCEPT)
    texts = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    single = steps["exact_dedup"](spark, docs, folder)
    kept = {r["keep_id"] for r in exact_dedup.decisions(docs, exact_dedup.scratch_index(spark)).collect()}
    assert single.columns == docs.columns and ids(single) == sorted(kept)
    near = steps["near_dedup"](spark, docs, folder)
    assert near.columns == docs.columns and ids(near) == sorted(i for i, (_, c) in classes_by_hand(texts.items(), 5).items() if c == i)
    mixed = steps["mixing"](spark, docs, folder)
    assert mixed.columns == docs.columns
    assert collections.Counter(ids(mixed)) == {r["doc_id"]: r["copies"] for r in mixing.copies(docs).collect() if r["copies"]}


def test_pipeline_end_to_end_and_odd_rows(spark, folder):
    found = corpus_pipeline.run(spark, folder)
    assert found.count() > 0 and {"doc_id", "sequence_id", "offset"} <= set(found.columns)
    for docs in (odd(spark), empty(spark)):
        for name, stage in corpus_pipeline.STAGES:
            docs_out = stage(spark, docs, folder)
            assert name == "packing" or docs_out.columns == docs.columns
            docs_out.count()

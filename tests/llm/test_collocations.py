"""Phrase mining against plain Python: shards, filters, renamed codes, exact scores, odd rows."""

import collections
import random
import re

import pytest
from cases import as_tuples, clashing, empty, odd, odd_rows
from pyspark.sql import functions as F

from loomgrain.llm import collocations as mined


def by_hand(rows, support=10, longest=3, first=2000, inside=50):
    """rows: (text, lang)."""
    counts, sizes = collections.defaultdict(collections.Counter), collections.Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lower):
            words = [w for w in re.split("[ \t]+", piece) if w]
            sizes[lang] += len(words)
            for k in range(1, longest + 1):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    found = []
    for lang, f in counts.items():
        frequent = {p: a for p, a in f.items() if len(p) > 1 and a >= support}
        longer = collections.Counter()
        for p, a in frequent.items():
            for n in range(2, len(p)):
                for i in range(len(p) - n + 1):
                    longer[p[i : i + n]] = max(longer[p[i : i + n]], a)
        kept = []
        for p, a in frequent.items():
            if 100 * longer[p] >= inside * a:
                continue
            score, _, l, r = min((1000000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(kept)[:first], 1):
            found.append((lang, rank, phrase.decode(), -a, l, r, sizes[lang], -score))
    return sorted(found, key=lambda r: tuple((v is not None, str(v)) for v in r))


def corpus(seed=5, count=400):
    draw = random.Random(seed)
    vocabulary = ["alpha", "Beta", "gamma", "é", "É", "𝔘x", "new", "york", "city", "a", "b"]
    rows = []
    for i in range(count):
        words = [draw.choice(vocabulary) for _ in range(draw.randint(0, 30))]
        if i % 3 == 0:
            words += ["New", "York", "City", "hall"]
        text = "".join(w + draw.choice([" ", " ", "  ", "\t", ", ", ".\n", "\x0b", "\xa0"]) for w in words)
        rows.append((i, text, draw.choice(["en", "en", None, "fr"])))
    return rows


@pytest.mark.parametrize("options", [{}, {"support": 3, "longest": 4, "shards": 3}, {"support": 25, "first": 7, "inside_percent": 90}, {"shards": 1}, {"shards": 40}])
def test_whole_result_against_plain_counting(spark, options):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(6)
    found = mined.collocations(docs, **options)
    plain = {k: v for k, v in options.items() if k not in ("shards", "inside_percent")}
    assert as_tuples(found) == by_hand([r[1:] for r in rows], **plain, inside=options.get("inside_percent", 50))


def test_blocks_and_the_way_without_a_filter(spark, monkeypatch):
    rows = corpus(6, 150)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    expected = by_hand([r[1:] for r in rows], support=4)
    assert as_tuples(mined.collocations(docs, support=4, filter_bits=64)) == expected
    monkeypatch.setattr(mined, "BLOCK_BYTES", 500)
    monkeypatch.setattr(mined, "MOST_CODES", 200)
    assert as_tuples(mined.collocations(docs, support=4)) == expected
    # a filter that lets most through changes nothing
    monkeypatch.setattr(mined, "BITS_PER_KEY", 0)
    assert as_tuples(mined.collocations(docs, support=4, filter_bits=64)) == expected


def test_locally_frequent_phrases_hold_all_frequent_ones(spark):
    rows = [(i, "rare pair", "en") for i in range(10)] + [(100 + i, f"single w{i}", "en") for i in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    keys = {r["key"] for r in mined.locally_frequent(docs, 10, 2, 4, 3).collect()}
    block = mined.Phrases([b"rare pair"])
    block.hash_words()
    for length, (codes, _) in enumerate(block.levels(2), 1):
        found = mined.keys_of(block.hashes(block.members(length, codes), mined.seed_of("en")), 3).view("int64")
        assert set(found.tolist()) <= keys
    assert len(keys) < 9


def test_joins_of_cuts_are_not_computed_to_count_keys(spark, monkeypatch):
    rows = [("en", 1, "a", 40), ("en", 1, "b", 30), ("en", 1, "c", 20), ("en", 2, "a b", 12), ("en", 2, "b c", 11), ("en", 3, "a b c", 10)]
    counts = spark.createDataFrame(rows, "lang string, words int, phrase string, f long")
    expected = as_tuples(mined.scored(counts))
    plans, join = [], mined.skew_join

    def spied(*sides, **options):
        plans.append(options["count_on"]._jdf.queryExecution().optimizedPlan().toString())
        return join(*sides, **options)

    monkeypatch.setattr(mined, "skew_join", spied)
    monkeypatch.setattr(mined, "BROADCAST", 0)
    assert as_tuples(mined.scored(counts)) == expected
    assert len(plans) == 2 and not any("Join" in plan for plan in plans)


def test_scores_pass_64_bits(spark):
    rows = [(10**12 + 7, 10**12 + 9, 10**12 + 11), (10, 3_000_000_001, 10), (10**9, 10**9, 10**9), (12345678901, 98765432109876, 12345678901)]
    found = spark.createDataFrame(rows, "a long, l long, r long").select("a", "l", "r", mined.strength(F.col("a"), F.col("l"), F.col("r")).alias("s"))
    assert {tuple(r) for r in found.collect()} == {(a, l, r, 1000000 * a * a // (l * r)) for a, l, r in rows}


def test_odd_rows(spark):
    docs = clashing(odd(spark))
    found = mined.collocations(docs, support=2, first=10**6)
    assert as_tuples(found) == by_hand([(r[1], r[2]) for r in odd_rows()], support=2, first=10**6)
    assert mined.collocations(empty(spark)).count() == 0
    same = spark.createDataFrame([(1, "x y " * 12, None)] * 3, "doc_id long, text string, lang string")
    assert as_tuples(mined.collocations(same)) == by_hand([("x y " * 12, None)] * 3)

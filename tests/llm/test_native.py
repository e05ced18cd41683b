"""Exact dedup, mixing and fingerprints: SQL, plain Python, odd tables, plans."""

import collections
import hashlib
import math
import re

import duckdb
import pytest
from cases import BLANK, as_tuples, clashing, empty, odd, odd_rows, prose

from loomgrain.llm import exact_dedup, fingerprints, mixing
from loomgrain.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_same_rows_as_sql(key, spark, folder):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    cursor = connection.execute(ORACLES[key])
    names = sorted(d[0] for d in cursor.description)
    found = QUERIES[key](spark, folder)
    assert sorted(found.columns) == names
    order = [[d[0] for d in cursor.description].index(n) for n in names]
    assert as_tuples(found, *names) == sorted(
        (tuple(r[i] for i in order) for r in cursor.fetchall()), key=lambda r: tuple((v is not None, str(v)) for v in r)
    )


@pytest.mark.parametrize("key", ["op4_exact_dedup", "op7_mixing", "op8_fingerprints"])
def test_no_python_and_no_cross_join(key, spark, folder):
    plan = QUERIES[key](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


def test_dedup_keeps_the_longest_then_the_smallest_id(spark):
    rows = [(1, "a b"), (2, "ab"), (3, " a b "), (4, "a  b  "), (5, "c"), (6, None), (7, " ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r for r in exact_dedup.decisions(docs, exact_dedup.scratch_index(spark)).collect()}
    assert {i: r["keep_id"] for i, r in found.items()} == {1: 4, 2: 4, 3: 4, 4: 4, 5: 5, 6: 7, 7: 7}
    assert [i for i, r in found.items() if r["kept"]] == [i for i in found if i in (4, 5, 7)]
    assert found[1]["group_size"] == 4


def test_dedup_against_what_the_index_knows(spark):
    index = exact_dedup.scratch_index(spark)
    first = spark.createDataFrame([(1, "x"), (2, "y")], "doc_id long, text string")
    second = spark.createDataFrame([(3, "x  "), (4, "z")], "doc_id long, text string")
    assert as_tuples(exact_dedup.deduplicate(first, index), "doc_id") == [(1,), (2,)]
    assert as_tuples(exact_dedup.deduplicate(second, index), "doc_id") == [(4,)]
    assert index.rows().count() == 3


def test_a_batch_that_died_keeps_the_same_when_run_again(spark, monkeypatch):
    index = exact_dedup.scratch_index(spark)
    old = spark.createDataFrame([(9, "known")], "doc_id long, text string")
    docs = spark.createDataFrame([(1, "x"), (2, "x "), (3, "y"), (4, "k nown")], "doc_id long, text string")
    exact_dedup.deduplicate(old, index, "first").count()
    expected = [(2,), (3,)]
    append = exact_dedup.DigestIndex.append
    for step in ("before", "after"):

        def dying(self, fresh, batch):
            if step == "after":
                append(self, fresh, batch)
            raise RuntimeError("killed")

        with monkeypatch.context() as patched:
            patched.setattr(exact_dedup.DigestIndex, "append", dying)
            with pytest.raises(RuntimeError):
                exact_dedup.deduplicate(docs, index, "second")
    for _ in range(2):
        assert as_tuples(exact_dedup.deduplicate(docs, index, "second"), "doc_id") == expected
    assert exact_dedup.deduplicate(docs, index, "third").count() == 0
    assert index.rows().count() == 3


def test_dedup_of_extreme_ids(spark):
    low, high = -(2**63), 2**63 - 1
    docs = spark.createDataFrame([(low, "a"), (high, "a"), (None, "a"), (high, "b"), (None, "c")], "doc_id long, text string")
    assert as_tuples(exact_dedup.deduplicate(docs), "doc_id", "text") == [(None, "c"), (low, "a"), (high, "b")]


def test_dedup_of_odd_rows(spark):
    kept = exact_dedup.deduplicate(clashing(odd(spark)))
    assert kept.columns == clashing(odd(spark)).columns
    found = as_tuples(kept, "doc_id", "text")
    texts = [BLANK.sub("", t or "") for _, t in found]
    assert len(set(texts)) == len(texts) == len({BLANK.sub("", r[1] or "") for r in odd_rows()})
    assert exact_dedup.deduplicate(empty(spark)).count() == 0


def taken_words(found):
    return {s: sum(r["size"] * r["copies"] for r in found if r["source"] == s) for s in {r["source"] for r in found}}


def test_mix_comes_near_its_targets(spark):
    rows = [(i, prose(i, 1 + i % 40), f"s{min(i % 7, 3)}") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mixing.copies(docs).collect()
    assert len(found) == 900
    targets = {r["source"]: r["target"] for r in found}
    assert math.isclose(sum(targets.values()), sum(r["size"] for r in found), rel_tol=1e-9)
    for source, taken in taken_words(found).items():
        assert abs(taken - targets[source]) <= 41
    assert max(r["copies"] for r in found) <= 3
    assert as_tuples(mixing.copies(docs)) == as_tuples(mixing.copies(docs.repartition(5)))
    emitted = collections.Counter(r["doc_id"] for r in mixing.mix(docs).collect())
    assert emitted == {r["doc_id"]: r["copies"] for r in found if r["copies"]}


def test_mix_of_odd_rows(spark):
    docs = clashing(odd(spark))
    found = mixing.copies(docs).collect()
    assert len(found) == len(odd_rows())
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r["copies"] for r in found)
    assert mixing.copies(empty(spark)).count() == 0 and mixing.mix(empty(spark)).count() == 0


def edited(text, following):
    n = len(text)
    return text[: n - n // 2] + following[: n // 2]


def similarity(x, y):
    x, y = (collections.Counter(w for w in BLANK.split(t.lower()) if w) for t in (x, y))
    return sum((x & y).values()) / max(1, sum((x | y).values()))


def test_fingerprints_against_plain_python(spark):
    rows = [(i * 3, prose(i, 60) if i % 4 else prose(0, 200)) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    found = {r["doc_id"]: r for r in fingerprints.fingerprint(docs).collect()}
    error, texts = [], dict(rows)
    for at, (i, text) in enumerate(rows):
        following = rows[(at + 1) % len(rows)][1]
        after = edited(text, following)
        assert found[i]["n_chars"] == len(text)
        assert found[i]["edited_sha256"] == hashlib.sha256(after.encode()).hexdigest()
        error += [found[i]["near_edited"] - similarity(text, after), found[i]["near_next"] - similarity(text, following)]
    # the deviation of one likeness is at most 0.0625; of the mean of 80 far less
    assert max(map(abs, error)) < 0.3 and abs(sum(error) / len(error)) < 0.04
    assert len({found[i]["fingerprint"] for i in texts if texts[i] == prose(0, 200)}) == 1


def test_more_samples_come_closer_to_generalised_jaccard(spark):
    x, y = "a a a b b c d e f g", "a b b b c c d h i j"
    docs = spark.createDataFrame([(1, x), (2, y)], "doc_id long, text string")
    near = fingerprints.fingerprint(docs, samples=512).where("doc_id = 1").first()["near_next"]
    assert abs(near - similarity(x, y)) < 0.1


def test_fingerprints_of_odd_rows(spark):
    found = fingerprints.fingerprint(clashing(odd(spark))).collect()
    assert sorted(str(r["doc_id"]) for r in found) == sorted(str(r[0]) for r in odd_rows())
    blank = [r for r in found if r["doc_id"] in (3, 4, 5)]
    assert {r["fingerprint"] for r in blank} == {""}
    assert len({r["fingerprint"] for r in found if r["doc_id"] in (1, 2)}) == 1
    assert all(0 <= r[c] <= 1 for r in found for c in ("near_edited", "near_next"))
    assert fingerprints.fingerprint(empty(spark)).count() == 0
    alone = fingerprints.fingerprint(odd(spark).where("doc_id = 7")).first()
    assert alone["near_next"] == 1.0 and alone["edited_sha256"] == hashlib.sha256(b"ono").hexdigest()


@pytest.mark.parametrize("ids", [range(20), [*range(20), 3, 3, None]])
def test_texts_are_dealt_once_to_meet_their_heads(spark, ids):
    docs = spark.createDataFrame([(i, f"one {i} two") for i in ids], "doc_id long, text string")
    narrow = fingerprints.identified(docs).selectExpr("doc_id", "a", "b", "cast(length(text) as long) as n_chars")
    order = fingerprints.written(fingerprints.in_order(narrow), "fp-test")
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        plan = fingerprints.with_edited(docs, order)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(threshold, before)
    # the texts, for either of two joins the same, the neighbours and the heads
    assert plan.count("Exchange hashpartitioning") == 4

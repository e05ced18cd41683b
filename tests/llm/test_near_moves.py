"""Near duplicates move texts and shingle sets only of documents that are asked for."""

import contextlib
import io

import pytest

from loomgrain.llm import near_dedup


def plan_of(df):
    said = io.StringIO()
    with contextlib.redirect_stdout(said):
        df.explain()
    return said.getvalue()


@pytest.fixture
def shuffled_joins(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def signed_sets(spark, texts):
    rows = []
    for node, text in texts:
        shingles = near_dedup.shingle_hashes(text, 2)
        signature = near_dedup.signer(36)(shingles)
        rows.append((node, len(shingles), signature, shingles.view("int64").tolist()))
    return spark.createDataFrame(rows, "node long, n long, signature array<int>, shingles array<long>")


def test_asked_for_keeps_every_row_of_the_nodes(spark):
    ids = [0, 1, -1, 7, 2**63 - 1, -(2**63), 10**12]
    rows = spark.createDataFrame([(i, "x") for i in [*ids, *ids, *range(100, 5000)]] + [(None, "n")], "node long, text string")
    found = [r["node"] for r in near_dedup.asked_for(rows, spark.createDataFrame([(i,) for i in ids], "node long")).collect()]
    assert sorted(i for i in found if i in ids) == sorted([*ids, *ids])
    assert len(found) <= 2 * len(ids) + 5
    assert near_dedup.asked_for(rows, spark.createDataFrame([], "node long")).count() == 0


def test_texts_are_read_where_they_are(spark, shuffled_joins):
    docs = spark.range(200).selectExpr("id AS doc_id", "concat('a b c ', id) AS text")
    docs = docs.unionAll(spark.createDataFrame([(3, "other words here"), (None, "a b")], "doc_id long, text string"))
    nodes = spark.createDataFrame([(3,), (150,), (3,)], "node long")
    sets = near_dedup.shingle_sets(docs, nodes, 2, 9, 2)
    assert "Exchange" not in plan_of(sets)
    assert sorted(r["node"] for r in sets.collect() if r["node"] in (3, 150)) == [3, 3, 150]


def test_sets_of_unlike_pairs_are_not_moved(spark, shuffled_joins, monkeypatch):
    base = [f"w{i}" for i in range(60)]
    texts = [(0, " ".join(base)), (1, " ".join([*base, "end"]))] + [(n, " ".join(f"x{n}y{i}" for i in range(60))) for n in range(2, 40)]
    pairs = spark.createDataFrame([(0, n) for n in range(1, 40)], "a long, b long")
    moved, asked_for = [], near_dedup.asked_for
    monkeypatch.setattr(near_dedup, "asked_for", lambda rows, nodes: moved.append(asked_for(rows, nodes)) or moved[-1])
    found = near_dedup.verified(pairs, signed_sets(spark, texts), 80).collect()
    assert [tuple(r) for r in found] == [(0, 1)]
    assert {r["node"] for r in moved[0].collect()} == {0, 1}

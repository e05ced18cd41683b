"""Keys are counted in tasks of bounded size; large groups of near copies are compared in few pairs."""

from cases import prose

from loomgrain.llm import near_dedup


def test_keys_are_counted_a_few_classes_at_a_time(spark, monkeypatch):
    docs = spark.createDataFrame([(i, prose(i, 30)) for i in range(95)], "doc_id long, text string").coalesce(1)
    signed = near_dedup.signatures(docs, 2, 9, 2)
    classes = signed.selectExpr("doc_id AS node", "signature")
    parts, table_keys = [], near_dedup.table_keys
    monkeypatch.setattr(near_dedup, "CLASSES_AT_ONCE", 10)
    monkeypatch.setattr(near_dedup, "table_keys", lambda rows, *more: parts.append(rows.rdd.getNumPartitions()) or table_keys(rows, *more))
    near_dedup.bucket_members(classes, 9, 2)
    assert 10 in parts


def test_the_centre_is_the_member_with_the_most_common_keys(spark):
    buckets = {10: [1, 2, 3, 4], 11: [3, 5], 12: [3, 4, 6], 13: [7, 8]}
    members = spark.createDataFrame([(k, len(v), n) for k, v in buckets.items() for n in v], "key long, n long, node long")
    common = members.groupBy("node").sum("n").toDF("node", "common")
    first = near_dedup.star_pairs(members, common, None, None, 0)
    assert {(r["a"], r["b"]) for r in first.collect()} == {(1, 3), (2, 3), (3, 4), (3, 5), (3, 6), (7, 8)}
    belongs = spark.createDataFrame([(n, 1) for n in (1, 3, 5, 6)], "node long, component long")
    used = spark.createDataFrame([(3,), (7,)], "node long")
    second = near_dedup.star_pairs(members, common, belongs, used, 1)
    assert {(r["a"], r["b"]) for r in second.collect()} == {(1, 4), (2, 4), (3, 4), (4, 6), (7, 8)}


def test_one_node_of_a_component_stands_for_its_shingles(spark):
    rows = [(n, 10, 99, n % 3, 0) for n in range(30)] + [(50, 10, 99, 1, 50), (0, 10, 98, 4, 0)]
    spread = spark.createDataFrame(rows, "node long, n long, shingle long, place long, component long")
    heads = near_dedup.component_heads(spread)
    assert sorted((r["node"], r["shingle"]) for r in heads.collect()) == [(0, 98), (0, 99), (50, 99)]
    assert [tuple(r) for r in near_dedup.meetings(heads, 80).collect()] == [(0, 50)]

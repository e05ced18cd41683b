"""Skew-aware joins against plain ones, with hot keys, copies and missing keys."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from loomgrain.operators.bands import band_join
from loomgrain.operators import skew
from loomgrain.operators.ranking import top_per_group
from loomgrain.operators.skew import broadcast_if_small, fits_broadcast, hot_keys, hot_limit, key_counts, skew_join


@pytest.fixture(scope="module")
def sides(spark):
    # a third of the left rows are identical copies of key 1, a tenth has no key
    left = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 1)
        .when(F.col("id") % 10 == 1, None)
        .otherwise(F.col("id") % 50)
        .alias("k"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("v"),
    )
    right = spark.range(60).select(
        F.when(F.col("id") < 40, F.col("id")).when(F.col("id") < 50, 1).alias("k"), (F.col("id") * 10).alias("w")
    )
    return left.repartition(6), right


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("hot_rows", [10, 40, 500, 10**9])
def test_equals_plain_join(sides, how, hot_rows):
    left, right = sides
    assert rows(skew_join(left, right, ["k"], how, hot_rows, broadcast_bytes=0)) == rows(left.join(right, "k", how))


def test_two_key_columns(spark):
    left = spark.range(900).select((F.col("id") % 2).alias("a"), (F.col("id") % 3).alias("b"), F.col("id").alias("v"))
    right = spark.range(6).select((F.col("id") % 2).alias("a"), (F.col("id") % 3).alias("b"), F.col("id").alias("w"))
    assert rows(skew_join(left, right, ["a", "b"], "inner", 20, broadcast_bytes=0)) == rows(left.join(right, ["a", "b"]))


def test_copies_of_one_row_spread_over_tasks(sides):
    left, right = sides
    left = left.where("k = 1 AND v = 7")
    joined = skew_join(left, right.groupBy("k").agg(F.max("w").alias("w")), ["k"], "inner", 100, broadcast_bytes=0)
    text = joined._jdf.queryExecution().toString()
    assert "_share" in text
    assert joined.count() == left.count()


def test_hot_keys_are_bounded(sides):
    left, _ = sides
    hot = {r["k"]: r["_shares"] for r in hot_keys(left, ["k"], 500).collect()}
    assert set(hot) == {1}
    assert hot[1] == 2


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_small_right_side_is_broadcast(sides, how):
    left, right = sides
    joined = skew_join(left, right, ["k"], how)
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()
    assert rows(joined) == rows(left.join(right, "k", how))


def test_counting_keys_elsewhere_changes_no_row(sides):
    left, right = sides
    other = left.where("v < 100")
    assert rows(skew_join(left, right, ["k"], "inner", 5, 0, count_on=other)) == rows(left.join(right, "k"))


def test_left_is_not_computed_to_plan_the_join(sides):
    left, right = sides
    # every row of it fails as soon as it is computed
    costly = left.withColumn("x", F.raise_error(F.lit("computed")).cast("string"))
    joined = skew_join(costly, right, ["k"], "inner", 10**9, 0, count_on=left)
    assert rows(joined.drop("x")) == rows(left.join(right, "k"))


def test_large_limits_count_on_a_sample(spark):
    many = spark.range(300_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    counted = key_counts(many, ["k"], 20_000)
    assert "Sample" in counted._jdf.queryExecution().toString()
    hot = {r["k"]: r["_shares"] for r in hot_keys(many, ["k"], 20_000).collect()}
    assert set(hot) == {0} and 4 <= hot[0] <= 6
    names = spark.range(300_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    joined = skew_join(many, names, ["k"], "inner", 20_000, broadcast_bytes=0)
    assert joined.agg(F.count("*"), F.sum("w"), F.sum("id")).first() == many.join(names, "k").agg(
        F.count("*"), F.sum("w"), F.sum("id")
    ).first()


def test_only_the_hottest_keys_are_kept_when_there_are_too_many(spark, monkeypatch):
    monkeypatch.setattr(skew, "fits_broadcast", lambda df: df.count() <= 2)
    hot = spark.createDataFrame([(i, i + 2) for i in range(9)], "k bigint, _shares int")
    assert sorted(r["k"] for r in skew._hottest(hot).collect()) == [7, 8]


def test_unsupported_kind(sides):
    with pytest.raises(ValueError):
        skew_join(*sides, ["k"], "full")


def test_broadcast_needs_a_measured_size(spark):
    small = spark.range(10).select("id", F.lit("x").alias("s"))
    assert fits_broadcast(small)
    assert not fits_broadcast(small, max_rows=9)
    assert not fits_broadcast(small, max_bytes=100)
    wide = spark.range(10).select(F.repeat(F.lit("x"), 1000).alias("s"))
    assert not fits_broadcast(wide, max_bytes=5000)
    hinted = spark.range(100).join(broadcast_if_small(small, max_rows=9), "id")._jdf.queryExecution().toString()
    assert "ResolvedHint (strategy=broadcast)" not in hinted


BANDS = [(1, 0.0, 10.0), (2, 10.0, 10.0), (3, 5.0, 1000.0), (4, 700.0, 749.0), (5, -30.0, 0.5), (6, 9.0, 3.0), (7, 1e-7, 2e-7)]


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("hot_rows", [5, 10**9])
def test_band_join_equals_comparing_all(spark, how, hot_rows):
    values = [-30.0, -0.25, 0.0, 1.5e-7, 0.5, 3.3, 5.0, 9.99, 10.0, 10.01, 700.0, 749.0, 749.5, 1000.0, 1000.5, None]
    points = spark.createDataFrame([(i, v) for i, v in enumerate(values * 3)], "p int, v double")
    bands = spark.createDataFrame(BANDS, "band int, lo double, hi double")
    got = rows(band_join(points, bands, "v", "lo", "hi", how, hot_rows, broadcast_bytes=0).select("p", "band"))
    expected = []
    for i, v in enumerate(values * 3):
        hits = [b for b, lo, hi in BANDS if v is not None and lo <= v <= hi]
        expected += [(b, i) for b in hits] or ([(None, i)] if how == "left" else [])
    assert got == sorted(expected, key=lambda r: tuple((x is not None, str(x)) for x in r))


def test_band_gap_and_no_bands(spark):
    points = spark.createDataFrame([(1, 749.5)], "p int, v double")
    grades = spark.createDataFrame([(1, 700, 749), (2, 750, 799)], "grade int, lo bigint, hi bigint")
    assert band_join(points, grades, "v", "lo", "hi").count() == 0
    assert band_join(points, grades.limit(0), "v", "lo", "hi", "left").count() == 1


def test_band_join_of_open_and_very_large_bands(spark):
    inf = float("inf")
    bands = [(1, -inf, -5.0), (2, 1e15, inf), (3, -inf, inf), (4, 1e300, 2e300), (5, 0.0, 1e-9)]
    values = [-1e308, -5.0, 0.0, 5e-10, 1e15, 1.5e300, inf, -inf]
    points = spark.createDataFrame(list(enumerate(values)), "p int, v double")
    got = rows(band_join(points, spark.createDataFrame(bands, "band int, lo double, hi double"), "v", "lo", "hi").select("p", "band"))
    assert sorted(got) == sorted((b, i) for i, v in enumerate(values) for b, lo, hi in bands if lo <= v <= hi)


def test_large_integer_bands_do_not_share_a_cell(spark):
    bands = spark.range(2000).select(F.col("id").alias("band"), (F.lit(1_700_000_000_000_000) + F.col("id") * 7_000_000).alias("lo"))
    bands = bands.withColumn("hi", F.col("lo") + 6_999_999)
    points = bands.select((F.col("lo") + 3).alias("v"))
    found = band_join(points, bands, "v", "lo", "hi", broadcast_bytes=0)
    assert found.count() == 2000
    ends = spark.createDataFrame([(1, -(2**63), 2**63 - 1), (2, 2**63 - 5, 2**63 - 1)], "band int, lo bigint, hi bigint")
    assert band_join(spark.createDataFrame([(2**63 - 2,)], "v bigint"), ends, "v", "lo", "hi").count() == 2


def test_hot_limit_follows_the_width_of_rows(spark):
    narrow = spark.range(10)
    wide = spark.range(10).select("id", F.repeat(F.lit("x"), 100_000).alias("s"))
    assert hot_limit(narrow, 5_000_000) == 5_000_000
    assert hot_limit(wide, 5_000_000) < 20_000
    assert hot_limit(narrow.limit(0), 77) == 77


def test_top_n_above_the_limit_of_the_plan_rule(spark):
    numbers = spark.range(40_000).select(F.lit(1).alias("g"), "id")
    found = top_per_group(numbers, ["g"], [("id", "desc")], n=5000)
    assert found.agg(F.min("id"), F.count("id")).first() == (35_000, 5000)
    assert "_share" in found._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
@pytest.mark.parametrize("hot", [(60, 50), (60, 1), (1, 50), (0, 40), (40, 0)])
def test_grid_join_equals_a_plain_join(spark, how, hot):
    def side(name, rows, offset):
        keys = [7] * rows + [i + offset for i in range(30)] + [i % 5 for i in range(20)] + [None] * 9
        return spark.createDataFrame([(k, i % 11) for i, k in enumerate(keys)], f"k long, {name} long").repartition(4)

    left, right = side("a", hot[0], 100), side("b", hot[1], 115)
    found = skew.grid_join(left, right, ["k"], how, hot_rows=8)
    assert found.columns == ["k", "a", "b"]
    assert rows(found) == rows(left.join(right, ["k"], how))


def test_no_task_of_a_grid_holds_a_hot_key_whole(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        left = spark.range(4000).select(F.lit(1).alias("k"), F.col("id").alias("a"))
        right = spark.range(1000).select(F.lit(1).alias("k"), F.col("id").alias("b"))
        found = skew.grid_join(left, right, ["k"], "full", hot_rows=250)
        per_task = found.groupBy(F.spark_partition_id()).agg(F.count_distinct("a").alias("a"), F.count_distinct("b").alias("b")).collect()
        assert found.count() == 4_000_000
        # cells fall on eight tasks by hash: none has a side whole
        assert len(per_task) > 4 and all(r["a"] < 4000 for r in per_task)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_grid_join_on_two_columns_and_wrong_kinds(spark):
    left = spark.createDataFrame([(1, "x", i) for i in range(30)] + [(1, None, 99)], "k long, n string, a long")
    right = spark.createDataFrame([(1, "x", i) for i in range(30)] + [(2, "x", 5)], "k long, n string, b long")
    assert rows(skew.grid_join(left, right, ["k", "n"], "full", 5)) == rows(left.join(right, ["k", "n"], "full"))
    with pytest.raises(ValueError):
        skew.grid_join(left, right, ["k"], "left_semi")

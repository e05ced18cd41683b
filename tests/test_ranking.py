"""Windows across parts against plain Spark windows."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from loomgrain.operators import ranking
from loomgrain.session import materialise

PRICE = [("price", "desc")]
ID = [("id", "asc")]


@pytest.fixture(scope="module")
def sales(spark):
    # a third of the rows in group 0 with one price, many ties, groups and prices that are missing
    return spark.range(4003).select(
        "id",
        F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 17 == 1, None).otherwise(F.col("id") % 11).alias("g"),
        F.when(F.col("id") % 3 == 0, 5)
        .when(F.col("id") % 19 == 2, None)
        .otherwise(F.floor(F.col("id") * 7919 % 40))
        .alias("price"),
    )


def plain(df, group, order, tie):
    peers = Window.partitionBy(*group).orderBy(*ranking.sort_columns(order))
    total = Window.partitionBy(*group).orderBy(*ranking.sort_columns([*order, *tie]))
    return df.select(
        "*",
        F.row_number().over(total).cast("long").alias("row_number"),
        F.rank().over(peers).cast("long").alias("rank"),
        F.dense_rank().over(peers).cast("long").alias("dense_rank"),
    )


@pytest.mark.parametrize("parts", [1, 16, 60])
@pytest.mark.parametrize("direction", ["asc", "desc"])
@pytest.mark.parametrize("group", [["g"], []])
def test_ranks_across_parts(sales, group, direction, parts):
    order = [("price", direction)]
    got = ranking.with_ranks(sales, group, order, ID, group_rows=10, parts=parts)
    assert rows(got) == rows(plain(sales, group, order, ID))


def test_one_value_over_many_parts(spark):
    same = spark.range(1000).select("id", F.lit(1).alias("g"), F.lit(2).alias("price"))
    ranked = ranking.with_ranks(same, ["g"], PRICE, ID, group_rows=10, parts=20)
    assert {(r["rank"], r["dense_rank"]) for r in ranked.collect()} == {(1, 1)}
    assert sorted(r["row_number"] for r in ranked.collect()) == list(range(1, 1001))


def test_small_groups_use_a_plain_window(sales):
    got = ranking.with_ranks(sales, ["g"], PRICE, ID, group_rows=10**6)
    assert rows(got) == rows(plain(sales, ["g"], PRICE, ID))


@pytest.mark.parametrize("buckets", [1, 4, 7, 5000])
@pytest.mark.parametrize("parts", [1, 13])
def test_ntile(sales, buckets, parts):
    order = [*PRICE, *ID]
    got = ranking.with_ntile(sales, order, buckets, parts)
    window = Window.orderBy(*ranking.sort_columns(order))
    assert rows(got) == rows(sales.withColumn("ntile", F.ntile(buckets).over(window).cast("long")))


@pytest.mark.parametrize("parts", [1, 13, 200])
def test_neighbours_keep_nulls(sales, parts):
    order = [*PRICE, *ID]
    got = ranking.with_neighbours(sales, order, "price", parts=parts)
    window = Window.orderBy(*ranking.sort_columns(order))
    expected = sales.withColumns({"previous": F.lag("price").over(window), "next": F.lead("price").over(window)})
    assert rows(got) == rows(expected)


@pytest.mark.parametrize("direction", ["asc", "desc"])
@pytest.mark.parametrize("group_rows", [50, 10**6])
def test_group_ends(sales, direction, group_rows):
    order = [("price", direction), ("id", direction)]
    got = ranking.with_group_ends(sales, ["g"], order, "price", group_rows=group_rows, broadcast_bytes=0)
    full = Window.partitionBy("g").orderBy(*ranking.sort_columns(order)).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    expected = sales.withColumns(
        {"first_value": F.first_value("price").over(full), "last_value": F.last_value("price").over(full)}
    )
    assert rows(got) == rows(expected)


def test_top_per_group_is_cut_before_the_shuffle(sales):
    top = ranking.top_per_group(sales, ["g"], [*PRICE, *ID], 2)
    text = top._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in text and "Partial" in text
    window = Window.partitionBy("g").orderBy(*ranking.sort_columns([*PRICE, *ID]))
    assert rows(top) == rows(sales.withColumn("n", F.row_number().over(window)).where("n <= 2").drop("n"))


def test_empty_input(spark):
    none = spark.range(0).select("id", F.col("id").alias("g"), F.col("id").alias("price"))
    assert ranking.with_ranks(none, ["g"], PRICE, ID).count() == 0
    assert ranking.with_ntile(none, [*PRICE, *ID], 4).count() == 0
    assert ranking.with_neighbours(none, [*PRICE, *ID], "price").count() == 0


def test_bad_arguments(sales):
    with pytest.raises(ValueError):
        ranking.with_ntile(sales, ID, 0)
    with pytest.raises(ValueError):
        ranking.sort_columns([("id", "down")])
    with pytest.raises(ValueError):
        ranking.with_group_ends(sales, ["g"], [("price", "asc"), ("id", "desc")], "id")


def exchanges(df):
    """Exchanges of the plan that move the rows; those of a summary follow an aggregate."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    return [line for at, line in enumerate(lines) if "Exchange " in line and "Aggregate" not in lines[at + 1]]


def test_rows_move_once(sales, monkeypatch):
    written = []

    def keep(df, label):
        written.append((label, df))
        return materialise(df, label)

    monkeypatch.setattr(ranking, "materialise", keep)
    ranking.with_neighbours(sales, [*PRICE, *ID], "price", parts=7).collect()
    ranking.with_ranks(sales, ["g"], PRICE, ID, group_rows=10, parts=7).collect()
    plans = {label: df for label, df in written if label != "borders"}
    assert set(plans) == {"neighbour-parts", "ranked-parts"}
    for df in plans.values():
        moved = [x for x in exchanges(df) if "shufflepartitionidpassthrough" in x]
        assert len(moved) == 1 and len(exchanges(df)) == 1
        assert df._jdf.queryExecution().executedPlan().toString().count("Sort [") == 1


@pytest.mark.parametrize("parts", [1, 2, 3, 8, 33])
def test_parts_follow_the_order(sales, parts):
    order = [("g", "desc"), ("price", "asc"), ("id", "desc")]
    found = ranking.in_parts(sales, order, parts).collect()
    numbers = {r["id"]: r["_part"] for r in found}
    place = Window.orderBy(*ranking.sort_columns(order))
    ordered = [numbers[r["id"]] for r in sales.withColumn("n", F.row_number().over(place)).orderBy("n").collect()]
    assert ordered == sorted(ordered) and set(ordered) == set(range(parts))
    sizes = [ordered.count(p) for p in range(parts)]
    assert max(sizes) <= 2.5 * len(ordered) / parts + 1


def test_text_and_date_keys(spark):
    import datetime as dt

    rows_ = [(i, None if i % 9 == 0 else f"k{i % 23}", dt.date(2026, 1, 1 + i % 20) if i % 7 else None) for i in range(400)]
    df = spark.createDataFrame(rows_, "id long, name string, day date")
    order = [("name", "desc"), ("day", "asc")]
    got = ranking.with_ranks(df, [], order, ID, parts=9)
    assert rows(got) == rows(plain(df, [], order, ID))
    assert ranking.with_neighbours(df.limit(0), [("name", "asc")], "id").count() == 0

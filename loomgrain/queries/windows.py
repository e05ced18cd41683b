"""Window functions."""

from pyspark.sql import functions as F

from loomgrain.operators.ranking import (
    top_per_group,
    with_group_ends,
    with_neighbours,
    with_ntile,
    with_ranks,
)
from loomgrain.queries.registry import query

c = F.col

PRICE_DOWN = [("o_totalprice", "desc"), ("o_orderkey", "desc")]
PRIORITY = [("o_orderpriority", "asc")]
KEY = [("o_orderkey", "asc")]
BY_DATE = [("o_orderdate", "asc"), ("o_orderkey", "asc")]


def orders(t, *columns):
    return t["orders"].select("o_orderkey", *columns)


@query(
    "row_number",
    """SELECT o_orderkey, o_custkey, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey)
       AS row_number FROM orders""",
)
def row_number(t):
    ranked = with_ranks(orders(t, "o_custkey", "o_totalprice"), ["o_custkey"], [("o_totalprice", "desc")], KEY)
    return ranked.select("o_orderkey", "o_custkey", "row_number")


@query(
    "rank",
    """SELECT o_orderkey, o_custkey, o_orderpriority, RANK() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority)
       AS "rank" FROM orders""",
)
def rank(t):
    ranked = with_ranks(orders(t, "o_custkey", "o_orderpriority"), ["o_custkey"], PRIORITY, KEY)
    return ranked.select("o_orderkey", "o_custkey", "o_orderpriority", "rank")


@query(
    "dense_rank",
    """SELECT o_orderkey, o_orderstatus, o_orderpriority,
       DENSE_RANK() OVER (PARTITION BY o_orderstatus ORDER BY o_orderpriority) AS "dense_rank" FROM orders""",
)
def dense_rank(t):
    ranked = with_ranks(orders(t, "o_orderstatus", "o_orderpriority"), ["o_orderstatus"], PRIORITY, KEY)
    return ranked.select("o_orderkey", "o_orderstatus", "o_orderpriority", "dense_rank")


@query(
    "ntile_global",
    """SELECT o_orderkey, o_totalprice, NTILE(4) OVER (ORDER BY o_totalprice DESC, o_orderkey DESC) AS quartile
       FROM orders""",
)
def ntile_global(t):
    return with_ntile(orders(t, "o_totalprice"), PRICE_DOWN, 4).withColumnRenamed("ntile", "quartile")


@query(
    "lag",
    """SELECT o_orderkey, LAG(o_totalprice) OVER (ORDER BY o_orderdate, o_orderkey) AS previous_price FROM orders""",
)
def lag(t):
    with_both = with_neighbours(orders(t, "o_orderdate", "o_totalprice"), BY_DATE, "o_totalprice", "previous_price")
    return with_both.select("o_orderkey", "previous_price")


@query(
    "lead",
    """SELECT o_orderkey, LEAD(o_totalprice) OVER (ORDER BY o_orderdate, o_orderkey) AS next_price FROM orders""",
)
def lead(t):
    with_both = with_neighbours(
        orders(t, "o_orderdate", "o_totalprice"), BY_DATE, "o_totalprice", lead_name="next_price"
    )
    return with_both.select("o_orderkey", "next_price")


def group_ends(t):
    return with_group_ends(orders(t, "o_custkey", "o_totalprice"), ["o_custkey"], PRICE_DOWN, "o_orderkey")


@query(
    "first_value",
    """SELECT o_orderkey, o_custkey, FIRST_VALUE(o_orderkey) OVER (PARTITION BY o_custkey
       ORDER BY o_totalprice DESC, o_orderkey DESC ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
       AS first_value FROM orders""",
)
def first_value(t):
    return group_ends(t).select("o_orderkey", "o_custkey", "first_value")


@query(
    "last_value",
    """SELECT o_orderkey, o_custkey, LAST_VALUE(o_orderkey) OVER (PARTITION BY o_custkey
       ORDER BY o_totalprice DESC, o_orderkey DESC ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
       AS last_value FROM orders""",
)
def last_value(t):
    return group_ends(t).select("o_orderkey", "o_custkey", "last_value")


@query(
    "latest_per_key",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, ROW_NUMBER() OVER
       (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS place FROM orders) o WHERE place = 1""",
)
def latest_per_key(t):
    newest = top_per_group(
        orders(t, "o_custkey", "o_totalprice", "o_orderdate"),
        ["o_custkey"],
        [("o_orderdate", "desc"), ("o_orderkey", "desc")],
    )
    return newest.select("o_custkey", "o_orderkey", "o_totalprice")


@query(
    "top_n_per_group",
    """SELECT o_orderstatus, o_orderpriority, o_orderkey, o_totalprice FROM (SELECT *, ROW_NUMBER() OVER
       (PARTITION BY o_orderstatus, o_orderpriority ORDER BY o_totalprice DESC, o_orderkey DESC) AS place
       FROM orders) o WHERE place <= 3""",
)
def top_n_per_group(t):
    group = ["o_orderstatus", "o_orderpriority"]
    return top_per_group(orders(t, *group, "o_totalprice"), group, PRICE_DOWN, 3).select(
        *group, "o_orderkey", "o_totalprice"
    )

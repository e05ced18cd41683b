"""Sorting, limits and set operations."""

from pyspark.sql import functions as F

from loomgrain.plans.lake import union_by_name
from loomgrain.queries.registry import query

c = F.col


@query("order_asc", "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal, c_custkey")
def order_asc(t):
    return t["customer"].select("c_custkey", "c_acctbal").orderBy("c_acctbal", "c_custkey")


@query("order_desc", "SELECT p_partkey, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey DESC")
def order_desc(t):
    return t["part"].select("p_partkey", "p_retailprice").orderBy("p_retailprice", "p_partkey", ascending=False)


@query(
    "order_multi",
    "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders ORDER BY o_orderpriority DESC, o_totalprice, o_orderkey",
)
def order_multi(t):
    # the key at the end lets rows with equal priority spread over all tasks
    return (
        t["orders"]
        .select("o_orderkey", "o_orderpriority", "o_totalprice")
        .orderBy(F.desc("o_orderpriority"), F.asc("o_totalprice"), F.asc("o_orderkey"))
    )


@query("limit", "SELECT c_custkey, c_name FROM customer ORDER BY c_custkey LIMIT 10")
def limit(t):
    return t["customer"].select("c_custkey", "c_name").orderBy("c_custkey").limit(10)


@query(
    "top_k",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20",
)
def top_k(t):
    return t["orders"].select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20)


@query(
    "first_row",
    "SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 1",
)
def first_row(t):
    first = t["orders"].orderBy("o_orderdate", "o_orderkey").limit(1)
    return first.select("o_orderkey", "o_custkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))


IN_SEGMENT = "SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING'"
IN_CREDIT = "SELECT c_custkey, c_name FROM customer WHERE c_acctbal >= 3000"


def in_segment(t):
    return t["customer"].where(c("c_mktsegment") == "BUILDING").select("c_custkey", "c_name")


def in_credit(t):
    return t["customer"].where(c("c_acctbal") >= 3000).select("c_custkey", "c_name")


@query("union_distinct", f"{IN_SEGMENT} UNION {IN_CREDIT}")
def union_distinct(t):
    return in_segment(t).unionByName(in_credit(t)).distinct()


@query("union_all", f"{IN_SEGMENT} UNION ALL {IN_CREDIT}")
def union_all(t):
    return in_segment(t).unionByName(in_credit(t))


@query(
    "intersect",
    """SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'R'
       INTERSECT SELECT l_partkey, l_suppkey FROM lineitem WHERE l_linestatus = 'F'""",
)
def intersect(t):
    # copies are dropped before the shuffle, so a pair with many lines counts once
    returned = t["lineitem"].where(c("l_returnflag") == "R").select("l_partkey", "l_suppkey").distinct()
    final = t["lineitem"].where(c("l_linestatus") == "F").select("l_partkey", "l_suppkey").distinct()
    return returned.intersect(final)


@query(
    "except",
    """SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'R'
       EXCEPT SELECT l_partkey, l_suppkey FROM lineitem WHERE l_linestatus = 'F'""",
)
def except_(t):
    returned = t["lineitem"].where(c("l_returnflag") == "R").select("l_partkey", "l_suppkey").distinct()
    final = t["lineitem"].where(c("l_linestatus") == "F").select("l_partkey", "l_suppkey").distinct()
    return returned.subtract(final)


@query(
    "union_missing_cols",
    """SELECT c_custkey AS party_key, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment, NULL AS size
       FROM customer UNION ALL
       SELECT s_suppkey, s_name, s_acctbal, NULL, NULL FROM supplier UNION ALL
       SELECT p_partkey, p_name, NULL, NULL, CAST(p_size AS BIGINT) FROM part""",
)
def union_missing_cols(t):
    customer = t["customer"].select(
        c("c_custkey").alias("party_key"),
        c("c_name").alias("name"),
        c("c_acctbal").alias("balance"),
        c("c_mktsegment").alias("segment"),
    )
    supplier = t["supplier"].select(
        c("s_suppkey").alias("party_key"), c("s_name").alias("name"), c("s_acctbal").alias("balance")
    )
    part = t["part"].select(
        c("p_partkey").alias("party_key"), c("p_name").alias("name"), c("p_size").cast("long").alias("size")
    )
    return union_by_name([customer, supplier, part])

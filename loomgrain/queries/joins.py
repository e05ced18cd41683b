"""Joins."""

from pyspark.sql import functions as F

from loomgrain.contracts import CHANGES
from loomgrain.operators.bands import band_join
from loomgrain.operators.quality import split, validate_changes
from loomgrain.operators.skew import grid_join, skew_join
from loomgrain.operators.updates import latest_changes, merge_changes, overlay
from loomgrain.queries.changes import order_changes, order_transactions
from loomgrain.queries.registry import query
from loomgrain.session import materialise

c = F.col


def renamed(df, **names):
    return df.withColumnsRenamed(names)


@query(
    "inner_join",
    "SELECT c_custkey, c_name, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey",
)
def inner_join(t):
    nation = renamed(t["nation"], n_nationkey="c_nationkey")
    return t["customer"].join(nation, "c_nationkey").select("c_custkey", "c_name", "n_name")


@query(
    "left_join",
    """SELECT c_custkey, c_name, n_name FROM customer
       LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <= 2) n ON c_nationkey = n_nationkey""",
)
def left_join(t):
    nation = renamed(t["nation"].where(c("n_regionkey") <= 2), n_nationkey="c_nationkey")
    return t["customer"].join(nation, "c_nationkey", "left").select("c_custkey", "c_name", "n_name")


@query(
    "right_join",
    """SELECT c_custkey, o_orderkey FROM (SELECT * FROM customer WHERE c_acctbal >= 3000) c
       RIGHT JOIN orders ON c_custkey = o_custkey""",
)
def right_join(t):
    rich = t["customer"].where(c("c_acctbal") >= 3000).select("c_custkey")
    orders = t["orders"].select("o_orderkey", "o_custkey")
    # a right join is the left join of the swapped sides, which lets hot customers be split
    joined = skew_join(orders, rich.select("c_custkey", c("c_custkey").alias("o_custkey")), ["o_custkey"], "left")
    return joined.select("c_custkey", "o_orderkey")


@query(
    "full_join",
    """SELECT COALESCE(k1, k2) AS custkey, segment, orders FROM
       (SELECT c_custkey AS k1, c_mktsegment AS segment FROM customer WHERE c_acctbal >= 0) a FULL JOIN
       (SELECT o_custkey AS k2, COUNT(*) AS orders FROM orders WHERE o_totalprice > 400000 GROUP BY o_custkey) b
       ON k1 = k2""",
)
def full_join(t):
    solvent = t["customer"].where(c("c_acctbal") >= 0).select(
        c("c_custkey").alias("custkey"), c("c_mktsegment").alias("segment")
    )
    large = (
        t["orders"]
        .where(c("o_totalprice") > 400000)
        .groupBy(c("o_custkey").alias("custkey"))
        .agg(F.count(F.lit(1)).alias("orders"))
    )
    return solvent.join(large, "custkey", "full").select("custkey", "segment", "orders")


@query(
    "multi_join",
    """SELECT o_orderkey, o_orderstatus, p_name, CAST(l_quantity AS DOUBLE) AS l_quantity
       FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey""",
)
def multi_join(t):
    orders = t["orders"].select(c("o_orderkey").alias("l_orderkey"), "o_orderstatus")
    part = t["part"].select(c("p_partkey").alias("l_partkey"), "p_name")
    lines = t["lineitem"].select("l_orderkey", "l_partkey", "l_quantity")
    with_orders = skew_join(lines, orders, ["l_orderkey"])
    return skew_join(with_orders, part, ["l_partkey"], count_on=lines).select(
        c("l_orderkey").alias("o_orderkey"), "o_orderstatus", "p_name", "l_quantity"
    )


@query(
    "range_join",
    """SELECT o_orderkey, o_totalprice, grade FROM orders JOIN
       (SELECT DISTINCT CAST(floor(o_totalprice / 10000) AS BIGINT) AS grade,
               floor(o_totalprice / 10000) * 10000.0 AS lo,
               floor(o_totalprice / 10000) * 10000.0 + 9999.99 AS hi FROM orders) b
       ON o_totalprice BETWEEN lo AND hi""",
)
def range_join(t):
    orders = t["orders"].select("o_orderkey", "o_totalprice")
    bands = (
        orders.select(F.floor(c("o_totalprice") / 10000).alias("grade"))
        .distinct()
        .select("grade", (c("grade") * 10000.0).alias("lo"), (c("grade") * 10000.0 + 9999.99).alias("hi"))
    )
    return band_join(orders, bands, "o_totalprice", "lo", "hi").select("o_orderkey", "o_totalprice", "grade")


@query(
    "exists_semi",
    """SELECT c_custkey, c_name FROM customer WHERE EXISTS
       (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)""",
)
def exists_semi(t):
    buyers = t["orders"].where(c("o_totalprice") > 400000).select(c("o_custkey").alias("c_custkey")).distinct()
    return t["customer"].join(buyers, "c_custkey", "left_semi").select("c_custkey", "c_name")


@query(
    "not_exists_anti",
    """SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS
       (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)""",
)
def not_exists_anti(t):
    buyers = t["orders"].where(c("o_totalprice") > 400000).select(c("o_custkey").alias("c_custkey")).distinct()
    return t["customer"].join(buyers, "c_custkey", "left_anti").select("c_custkey", "c_name")


@query(
    "broadcast_join",
    """SELECT n_name, COUNT(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""",
)
def broadcast_join(t):
    nation = renamed(t["nation"], n_nationkey="c_nationkey").select("c_nationkey", "n_name")
    # broadcast once its size has been measured; a larger one is joined by shares of the hot keys
    joined = skew_join(t["customer"].select("c_nationkey"), nation, ["c_nationkey"])
    return joined.groupBy("n_name").agg(F.count(F.lit(1)).alias("customers"))


@query(
    "lookup_left_broadcast",
    """SELECT l_orderkey, l_linenumber, l_partkey, p_brand FROM lineitem
       LEFT JOIN (SELECT p_partkey, p_brand FROM part WHERE p_size > 25) p ON l_partkey = p_partkey""",
)
def lookup_left_broadcast(t):
    large = t["part"].where(c("p_size") > 25).select(c("p_partkey").alias("l_partkey"), "p_brand")
    lines = t["lineitem"].select("l_orderkey", "l_linenumber", "l_partkey")
    return skew_join(lines, large, ["l_partkey"], "left").select(
        "l_orderkey", "l_linenumber", "l_partkey", "p_brand"
    )


@query(
    "bridge_fact_join",
    """SELECT o_orderstatus, p_type, COUNT(*) AS lines FROM lineitem
       JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey GROUP BY o_orderstatus, p_type""",
)
def bridge_fact_join(t):
    part = t["part"].select(c("p_partkey").alias("l_partkey"), "p_type")
    orders = t["orders"].select(c("o_orderkey").alias("l_orderkey"), "o_orderstatus")
    lines = skew_join(t["lineitem"].select("l_orderkey", "l_partkey"), part, ["l_partkey"])
    # one row per order and type crosses the network, however many lines an order has
    counted = lines.groupBy("l_orderkey", "p_type").agg(F.count(F.lit(1)).alias("lines"))
    return counted.join(orders, "l_orderkey").groupBy("o_orderstatus", "p_type").agg(F.sum("lines").alias("lines"))


@query(
    "update_overlay",
    """SELECT o_orderkey, o_custkey,
       COALESCE(CASE WHEN o_orderkey % 10 = 0 THEN 'senior_' || o_orderpriority END, o_orderpriority) AS o_orderpriority,
       COALESCE(CASE WHEN o_orderkey % 20 = 0 THEN o_totalprice + 100 END, o_totalprice) AS o_totalprice FROM orders""",
)
def update_overlay(t):
    orders = t["orders"].select("o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice")
    # every tenth order changes, half of those without a new price; shifted keys have no base row
    updates = orders.where(c("o_orderkey") % 10 == 0).select(
        "o_orderkey",
        F.concat(F.lit("senior_"), "o_orderpriority").alias("new_priority"),
        F.when(c("o_orderkey") % 20 == 0, c("o_totalprice") + 100).alias("new_price"),
    )
    absent = updates.withColumn("o_orderkey", -1 - c("o_orderkey"))
    return overlay(
        orders,
        updates.unionByName(absent),
        ["o_orderkey"],
        {"o_orderpriority": "new_priority", "o_totalprice": "new_price"},
    )


@query(
    "orphan_check",
    """SELECT l_partkey, COUNT(*) AS lines FROM lineitem
       LEFT JOIN (SELECT p_partkey FROM part WHERE p_size <= 40) p ON l_partkey = p_partkey
       WHERE p_partkey IS NULL GROUP BY l_partkey""",
)
def orphan_check(t):
    known = t["part"].where(c("p_size") <= 40).select(c("p_partkey").alias("l_partkey"))
    # counted per key first, so a key with many lines is one row in the join
    lines = t["lineitem"].groupBy("l_partkey").agg(F.count(F.lit(1)).alias("lines"))
    return lines.join(known, "l_partkey", "left_anti")


@query(
    "filter_then_join",
    """SELECT l_orderkey, l_linenumber, p_name FROM lineitem JOIN part ON l_partkey = p_partkey
       WHERE p_retailprice >= 910""",
)
def filter_then_join(t):
    dear = t["part"].where("p_retailprice >= 910").select(c("p_partkey").alias("l_partkey"), "p_name")
    lines = t["lineitem"].select("l_orderkey", "l_linenumber", "l_partkey")
    return skew_join(lines, dear, ["l_partkey"]).select("l_orderkey", "l_linenumber", "p_name")


@query(
    "skew_join",
    """SELECT c_mktsegment, o_orderkey, o_orderpriority FROM orders
       JOIN customer ON CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_custkey END = c_custkey""",
)
def skew_join_query(t):
    # a third of all orders belongs to customer 0
    orders = t["orders"].select(
        F.when(c("o_orderkey") % 3 == 0, 0).otherwise(c("o_custkey")).alias("c_custkey"), "o_orderkey", "o_orderpriority"
    )
    customer = t["customer"].select("c_custkey", "c_mktsegment")
    share = max(1, t["orders"].count() // 16)
    # no broadcast here: the shares are what this query shows
    return skew_join(orders, customer, ["c_custkey"], hot_rows=share, broadcast_bytes=0).select(
        "c_mktsegment", "o_orderkey", "o_orderpriority"
    )


@query(
    "full_join_hot",
    """SELECT coalesce(o.k, c.k) AS k, COUNT(*) AS row_count, COUNT(o_orderkey) AS orders, COUNT(c_custkey) AS customers,
       CAST(SUM(o_orderkey) AS BIGINT) AS order_keys, CAST(SUM(c_custkey) AS BIGINT) AS customer_keys
       FROM (SELECT CASE WHEN o_orderkey % 100 = 0 THEN -1 ELSE o_custkey + 10 END AS k, o_orderkey FROM orders) o
       FULL JOIN (SELECT CASE WHEN c_custkey % 50 = 0 THEN -1 ELSE c_custkey END AS k, c_custkey FROM customer) c ON o.k = c.k
       GROUP BY 1""",
)
def full_join_hot(t):
    """One key is hot on both sides; orders and customers without a partner come out once."""
    orders = t["orders"].select(
        F.when(c("o_orderkey") % 100 == 0, -1).otherwise(c("o_custkey") + 10).alias("k"), "o_orderkey"
    )
    customers = t["customer"].select(F.when(c("c_custkey") % 50 == 0, -1).otherwise(c("c_custkey")).alias("k"), "c_custkey")
    # a quarter of the customers of the hot key, so that both sides are cut
    share = max(2, t["customer"].count() // 200)
    return grid_join(orders, customers, ["k"], "full", share).groupBy("k").agg(
        F.count("*").alias("row_count"),
        F.count("o_orderkey").alias("orders"),
        F.count("c_custkey").alias("customers"),
        F.sum("o_orderkey").alias("order_keys"),
        F.sum("c_custkey").alias("customer_keys"),
    )


@query(
    "cdc_apply",
    """SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 10 = 0 THEN CAST(CAST(o_totalprice AS DECIMAL(16,2)) + 5 AS DOUBLE)
       ELSE o_totalprice END AS o_totalprice FROM orders WHERE o_orderkey % 10 <> 1""",
)
def cdc_apply(t):
    accepted, _ = split(validate_changes(order_changes(t), CHANGES, F.lit("orders")))
    latest = materialise(latest_changes(accepted, ["transaction_id"]), "latest-changes")
    merged = merge_changes(order_transactions(t), latest, ["transaction_id"], ["amount", "transaction_ts"])
    return merged.select(
        c("transaction_id").alias("o_orderkey"),
        c("customer_id").alias("o_custkey"),
        c("amount").cast("double").alias("o_totalprice"),
    )

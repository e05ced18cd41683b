"""Aggregates."""

from pyspark.sql import functions as F

from loomgrain.functions.values import money
from loomgrain.queries.registry import query

c = F.col


def total(column, name):
    return F.sum(money(column)).cast("double").alias(name)


# the average of exact cents, divided as doubles
def average(column, name):
    return F.round(F.sum(money(column)).cast("double") / F.count(column), 2).alias(name)


NET = "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END"


def paid():
    return F.when(c("o_orderstatus") == "P", None).otherwise(c("o_totalprice"))


@query("count_star", "SELECT COUNT(*) AS orders FROM orders")
def count_star(t):
    return t["orders"].agg(F.count("*").alias("orders"))


@query("count_col", f"SELECT COUNT(*) AS orders, COUNT({NET}) AS paid_orders FROM orders")
def count_col(t):
    return t["orders"].agg(F.count("*").alias("orders"), F.count(paid()).alias("paid_orders"))


@query("sum_total", "SELECT CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue FROM orders")
def sum_total(t):
    return t["orders"].agg(total("o_totalprice", "revenue"))


@query(
    "avg_round",
    """SELECT ROUND(CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(o_totalprice), 2) AS avg_price
       FROM orders""",
)
def avg_round(t):
    return t["orders"].agg(average("o_totalprice", "avg_price"))


@query(
    "sum_coalesce",
    f"SELECT CAST(SUM(COALESCE(CAST({NET} AS DECIMAL(18,2)), 0)) AS DOUBLE) AS paid_total FROM orders",
)
def sum_coalesce(t):
    return t["orders"].agg(F.sum(F.coalesce(money(paid()), F.lit(0))).cast("double").alias("paid_total"))


@query("max_min_num", "SELECT MAX(o_totalprice) AS dearest, MIN(o_totalprice) AS cheapest FROM orders")
def max_min_num(t):
    return t["orders"].agg(F.max("o_totalprice").alias("dearest"), F.min("o_totalprice").alias("cheapest"))


@query(
    "max_min_date",
    """SELECT strftime(MAX(o_orderdate), '%Y-%m-%d') AS last_day, strftime(MIN(o_orderdate), '%Y-%m-%d') AS first_day,
       MAX(o_orderpriority) AS last_priority FROM orders""",
)
def max_min_date(t):
    return t["orders"].agg(
        F.date_format(F.max("o_orderdate"), "yyyy-MM-dd").alias("last_day"),
        F.date_format(F.min("o_orderdate"), "yyyy-MM-dd").alias("first_day"),
        F.max("o_orderpriority").alias("last_priority"),
    )


@query(
    "group_by",
    """SELECT o_orderstatus, COUNT(*) AS orders,
       ROUND(CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(o_totalprice), 2) AS avg_price,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
       FROM orders GROUP BY o_orderstatus ORDER BY o_orderstatus""",
)
def group_by(t):
    return (
        t["orders"]
        .groupBy("o_orderstatus")
        .agg(F.count("*").alias("orders"), average("o_totalprice", "avg_price"), total("o_totalprice", "revenue"))
        .orderBy("o_orderstatus")
    )


@query(
    "group_by_join",
    """SELECT n_name, c_mktsegment, COUNT(*) AS customers,
       CAST(SUM(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance, MAX(c_acctbal) AS largest
       FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name, c_mktsegment ORDER BY 1, 2""",
)
def group_by_join(t):
    nation = t["nation"].select(c("n_nationkey").alias("c_nationkey"), "n_name")
    # grouped by key before the join, so only one row per key and segment meets the nation
    by_key = t["customer"].groupBy("c_nationkey", "c_mktsegment").agg(
        F.count("*").alias("n"), F.sum(money("c_acctbal")).alias("s"), F.max("c_acctbal").alias("m")
    )
    return (
        by_key.join(nation, "c_nationkey")
        .groupBy("n_name", "c_mktsegment")
        .agg(
            F.sum("n").alias("customers"),
            F.sum("s").cast("double").alias("balance"),
            F.max("m").alias("largest"),
        )
        .orderBy("n_name", "c_mktsegment")
    )


@query(
    "having",
    """SELECT o_custkey, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue FROM orders
       GROUP BY o_custkey HAVING SUM(CAST(o_totalprice AS DECIMAL(18,2))) > 2500000""",
)
def having(t):
    spent = t["orders"].groupBy("o_custkey").agg(F.sum(money("o_totalprice")).alias("revenue"))
    return spent.where(c("revenue") > 2500000).withColumn("revenue", c("revenue").cast("double"))


@query("group_count", 'SELECT event_type, COUNT(*) AS "count" FROM events GROUP BY event_type')
def group_count(t):
    return t["events"].groupBy("event_type").count()


@query("row_count", "SELECT COUNT(*) AS row_count FROM lineitem")
def row_count(t):
    return t["lineitem"].agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "preagg_join",
    """SELECT o_orderkey, o_orderpriority, lines, quantity FROM orders JOIN
       (SELECT l_orderkey, COUNT(*) AS lines, CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity
        FROM lineitem GROUP BY l_orderkey) l ON o_orderkey = l_orderkey""",
)
def preagg_join(t):
    lines = t["lineitem"].groupBy(c("l_orderkey").alias("o_orderkey")).agg(
        F.count("*").alias("lines"), total("l_quantity", "quantity")
    )
    orders = t["orders"].select("o_orderkey", "o_orderpriority")
    return orders.join(lines, "o_orderkey")


@query(
    "distinct_keys",
    "SELECT p_partkey, p_name FROM part WHERE p_partkey IN (SELECT DISTINCT l_partkey FROM lineitem WHERE l_quantity >= 49)",
)
def distinct_keys(t):
    keys = t["lineitem"].where(c("l_quantity") >= 49).select(c("l_partkey").alias("p_partkey")).distinct()
    return t["part"].join(keys, "p_partkey", "left_semi").select("p_partkey", "p_name")

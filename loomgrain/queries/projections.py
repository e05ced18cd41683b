"""Projections, filters and predicates."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomgrain.contracts import contract
from loomgrain.operators.quality import cast_to_contract, project_to_contract
from loomgrain.operators.skew import skew_join
from loomgrain.queries.registry import query

c = F.col


@query("select_cols", "SELECT c_name, c_mktsegment, c_custkey FROM customer")
def select_cols(t):
    return t["customer"].select("c_name", "c_mktsegment", "c_custkey")


@query("where_ge", "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal >= 3000")
def where_ge(t):
    return t["customer"].where(c("c_acctbal") >= 3000).select("c_custkey", "c_acctbal")


@query("eq", "SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING'")
def eq(t):
    return t["customer"].where(c("c_mktsegment") == "BUILDING").select("c_custkey", "c_name")


@query(
    "neq",
    """SELECT c_custkey, c_mktsegment FROM customer
       WHERE CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END <> 'BUILDING'""",
)
def neq(t):
    # the segment of accounts in debt counts as unknown, so those rows drop out
    known = F.when(c("c_acctbal") < 0, None).otherwise(c("c_mktsegment"))
    return t["customer"].where(known != "BUILDING").select("c_custkey", "c_mktsegment")


@query("in_list", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')")
def in_list(t):
    return t["orders"].where(c("o_orderpriority").isin("1-URGENT", "2-HIGH")).select("o_orderkey", "o_orderpriority")


@query(
    "not_in_list",
    """SELECT o_orderkey, o_orderpriority FROM orders
       WHERE CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END NOT IN ('1-URGENT', '2-HIGH')""",
)
def not_in_list(t):
    known = F.when(c("o_orderstatus") == "P", None).otherwise(c("o_orderpriority"))
    return t["orders"].where(~known.isin("1-URGENT", "2-HIGH")).select("o_orderkey", "o_orderpriority")


@query("like", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE 's%'")
def like(t):
    return t["part"].where(c("p_name").like("s%")).select("p_partkey", "p_name")


@query("not_like", "SELECT c_custkey, c_name FROM customer WHERE c_name NOT LIKE '%_1%'")
def not_like(t):
    # the underscore stands for any one character
    return t["customer"].where(~c("c_name").like("%_1%")).select("c_custkey", "c_name")


@query("between", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice BETWEEN 20000 AND 30000")
def between(t):
    return t["orders"].where(c("o_totalprice").between(20000, 30000)).select("o_orderkey", "o_totalprice")


@query("gt", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 250000")
def gt(t):
    return t["orders"].where(c("o_totalprice") > 250000).select("o_orderkey", "o_totalprice")


@query("ge", "SELECT p_partkey, CAST(p_size AS BIGINT) AS p_size FROM part WHERE p_size >= 40")
def ge(t):
    return t["part"].where(c("p_size") >= 40).select("p_partkey", c("p_size").cast("long").alias("p_size"))


@query("lt", "SELECT p_partkey, CAST(p_size AS BIGINT) AS p_size FROM part WHERE p_size < 10")
def lt(t):
    return t["part"].where(c("p_size") < 10).select("p_partkey", c("p_size").cast("long").alias("p_size"))


@query("le", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity <= 5")
def le(t):
    return t["lineitem"].where(c("l_quantity") <= 5).select("l_orderkey", "l_linenumber", "l_quantity")


@query(
    "is_null",
    """SELECT c_custkey, c_name FROM customer LEFT JOIN
       (SELECT DISTINCT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 300000) u
       ON c_custkey = o_custkey WHERE o_custkey IS NULL""",
)
def is_null(t):
    urgent = (
        t["orders"]
        .where((c("o_orderpriority") == "1-URGENT") & (c("o_totalprice") > 300000))
        .select("o_custkey")
        .distinct()
    )
    joined = t["customer"].join(urgent, c("c_custkey") == c("o_custkey"), "left")
    return joined.where(c("o_custkey").isNull()).select("c_custkey", "c_name")


@query(
    "is_not_null",
    """SELECT o_orderkey, CAST(c_custkey AS BIGINT) AS c_custkey FROM orders LEFT JOIN
       (SELECT c_custkey FROM customer WHERE c_acctbal >= 3000) r ON c_custkey = o_custkey
       WHERE c_custkey IS NOT NULL""",
)
def is_not_null(t):
    rich = t["customer"].where(c("c_acctbal") >= 3000).select("c_custkey")
    rich = rich.withColumn("o_custkey", c("c_custkey"))
    joined = skew_join(t["orders"].select("o_orderkey", "o_custkey"), rich, ["o_custkey"], "left")
    return joined.where(c("c_custkey").isNotNull()).select("o_orderkey", "c_custkey")


@query(
    "bool_logic",
    """SELECT o_orderkey, o_orderstatus FROM orders
       WHERE (o_orderstatus = 'F' AND o_totalprice > 100000) OR NOT (o_orderpriority <> '1-URGENT')""",
)
def bool_logic(t):
    keep = ((c("o_orderstatus") == "F") & (c("o_totalprice") > 100000)) | ~(c("o_orderpriority") != "1-URGENT")
    return t["orders"].where(keep).select("o_orderkey", "o_orderstatus")


@query("sql_predicate", "SELECT event_id, user_id FROM events WHERE event_type = 'error' AND value > 10")
def sql_predicate(t):
    return t["events"].where("event_type = 'error' AND value > 10").select("event_id", "user_id")


@query(
    "add_column",
    """SELECT l_orderkey, l_linenumber, l_extendedprice, l_discount,
       CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DOUBLE) AS net_price
       FROM lineitem""",
)
def add_column(t):
    net = c("l_extendedprice").cast("decimal(12,2)") * (1 - c("l_discount").cast("decimal(4,2)"))
    return (
        t["lineitem"]
        .select("l_orderkey", "l_linenumber", "l_extendedprice", "l_discount")
        .withColumn("net_price", net.cast("double"))
    )


@query("literal_column", "SELECT c_custkey, 'customer' AS source_table, 'parquet' AS source_format FROM customer")
def literal_column(t):
    return (
        t["customer"]
        .select("c_custkey")
        .withColumns({"source_table": F.lit("customer"), "source_format": F.lit("parquet")})
    )


@query("drop_column", "SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def drop_column(t):
    return t["supplier"].drop("s_nationkey")


@query("alias_column", "SELECT e.o_orderkey AS order_id, e.o_totalprice AS amount FROM orders e")
def alias_column(t):
    return t["orders"].alias("e").select(c("e.o_orderkey").alias("order_id"), c("e.o_totalprice").alias("amount"))


@query(
    "case_when",
    """SELECT o_orderkey, CASE WHEN o_totalprice < 50000 THEN 'small' WHEN o_totalprice < 200000 THEN 'medium'
       WHEN o_totalprice < 400000 THEN 'large' END AS band FROM orders""",
)
def case_when(t):
    price = c("o_totalprice")
    band = F.when(price < 50000, "small").when(price < 200000, "medium").when(price < 400000, "large")
    return t["orders"].select("o_orderkey", band.alias("band"))


EVENT_TEXT = contract(
    "event_text",
    {"event_id": "bigint", "score": "int", "amount": "decimal(14,2)", "happened": "date"},
    "event_id",
)


@query(
    "cast_contract",
    """SELECT event_id, TRY_CAST(CASE WHEN event_type = 'error' THEN props ELSE regexp_extract(props, '[0-9]+') END
       AS BIGINT) AS score, CAST(CAST(value AS DECIMAL(14,2)) AS DOUBLE) AS amount,
       CASE WHEN event_type = 'view' THEN NULL ELSE strftime(ts, '%Y-%m-%d') END AS happened FROM events""",
)
def cast_contract(t):
    day = F.date_format("ts", "yyyy-MM-dd")
    text = t["events"].select(
        c("event_id").cast("string").alias("event_id"),
        F.when(c("event_type") == "error", c("props"))
        .otherwise(F.regexp_extract("props", "[0-9]+", 0))
        .alias("score"),
        c("value").cast("string").alias("amount"),
        F.when(c("event_type") == "view", F.concat(F.lit("day "), day)).otherwise(day).alias("happened"),
    )
    typed = cast_to_contract(text, EVENT_TEXT)
    return typed.select(
        "event_id", c("score").cast("long").alias("score"), c("amount").cast("double").alias("amount"),
        c("happened").cast("string").alias("happened"),
    )


@query("distinct_rows", "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def distinct_rows(t):
    return t["orders"].select("o_orderstatus", "o_orderpriority").distinct()


@query("dedup_rows", "SELECT DISTINCT * FROM (SELECT * FROM supplier UNION ALL SELECT * FROM supplier) s")
def dedup_rows(t):
    supplier = t["supplier"]
    return supplier.unionByName(supplier).dropDuplicates()


CUSTOMER_SHORT = contract(
    "customer_short", {"c_custkey": "bigint", "c_mktsegment": "string", "c_acctbal": "double"}, "c_custkey"
)


@query("project_contract", "SELECT c_custkey, c_mktsegment, c_acctbal FROM customer")
def project_contract(t):
    return project_to_contract(t["customer"], CUSTOMER_SHORT)


@query(
    "apply_by_type",
    """SELECT c_custkey, lower(c_name) AS c_name, c_nationkey, c_acctbal, lower(c_mktsegment) AS c_mktsegment
       FROM customer""",
)
def apply_by_type(t):
    customer = t["customer"]
    return customer.select(
        *[F.lower(f.name).alias(f.name) if isinstance(f.dataType, T.StringType) else c(f.name) for f in customer.schema]
    )


@query("expr_column", "SELECT p_partkey, right(p_name, 3) AS name_end, p_size * 2 AS double_size FROM part")
def expr_column(t):
    return t["part"].select(
        "p_partkey", F.expr("right(p_name, 3)").alias("name_end"), F.expr("p_size * 2").alias("double_size")
    )


@query(
    "sql_query",
    """SELECT c_nationkey, COUNT(*) AS customers, CAST(SUM(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance
       FROM customer WHERE c_acctbal >= 3000 GROUP BY c_nationkey""",
)
def sql_query(t):
    return t.spark.sql(
        """SELECT c_nationkey, COUNT(*) AS customers, CAST(SUM(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance
           FROM {customer} WHERE c_acctbal >= :least GROUP BY c_nationkey""",
        args={"least": 3000},
        customer=t["customer"],
    )

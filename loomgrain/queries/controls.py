"""Execution controls: the rows must not depend on them."""

from pyspark import StorageLevel
from pyspark.sql import functions as F

from loomgrain.functions.values import money
from loomgrain.plans.layout import scan_facts, timed
from loomgrain.queries.registry import query
from loomgrain.queries.shapes import EVENTS, dated_feed, event_days, event_sql, order_sql, order_summary, spread
from loomgrain.session import session_settings
from loomgrain.sources.files import list_files
from loomgrain.sources.readers import read_batch

c = F.col


@query("repartition", order_sql())
def repartition(t):
    return order_summary(spread(t["orders"], 16))


@query("coalesce_parts", order_sql())
def coalesce_parts(t):
    orders = t.spark.read.parquet(t.staged("orders-spread", lambda p: spread(t["orders"], 16).write.parquet(p)))
    # a quarter of the tasks, each taking whole partitions, so no row moves
    return order_summary(orders.coalesce(max(1, orders.rdd.getNumPartitions() // 4)))


@query(
    "repartition_by_key",
    """SELECT o_custkey, COUNT(*) AS orders, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
       FROM orders GROUP BY o_custkey""",
)
def repartition_by_key(t):
    # summed before rows move to their key's partition, so a hot key is one row there
    spent = t["orders"].groupBy("o_custkey").agg(
        F.count("*").alias("orders"), F.sum(money("o_totalprice")).cast("double").alias("revenue")
    )
    return spent.repartition(int(t.spark.conf.get("spark.sql.shuffle.partitions")), "o_custkey")


@query(
    "cache",
    """SELECT o_orderstatus, COUNT(*) AS orders, (SELECT COUNT(*) FROM orders WHERE o_totalprice > 100000) AS dear
       FROM orders WHERE o_totalprice > 100000 GROUP BY o_orderstatus""",
)
def cache(t):
    dear = t["orders"].select("o_orderstatus", "o_totalprice").where(c("o_totalprice") > 100000).cache()
    rows = dear.count()
    by_status = dear.groupBy("o_orderstatus").agg(F.count("*").alias("orders")).collect()
    dear.unpersist()
    # three statuses
    return t.spark.createDataFrame(
        [(r["o_orderstatus"], r["orders"], rows) for r in by_status], "o_orderstatus string, orders bigint, dear bigint"
    )


@query("persist_level", order_sql("WHERE o_totalprice > 100000"))
def persist_level(t):
    dear = t["orders"].where(c("o_totalprice") > 100000).persist(StorageLevel.MEMORY_AND_DISK)
    summary = order_summary(dear)
    rows = summary.collect()
    dear.unpersist()
    # one row per status and priority
    return t.spark.createDataFrame(rows, summary.schema)


@query("clear_cache", order_sql())
def clear_cache(t):
    t["orders"].cache().count()
    t.spark.catalog.clearCache()
    return order_summary(t["orders"])


@query(
    "explain",
    """SELECT o_orderstatus, COUNT(*) AS orders, CAST(1 AS BIGINT) AS filter_pushed, CAST(1 AS BIGINT) AS columns_pruned
       FROM orders WHERE o_totalprice > 100000 GROUP BY o_orderstatus""",
)
def explain(t):
    counted = t["orders"].where(c("o_totalprice") > 100000).groupBy("o_orderstatus").agg(F.count("*").alias("orders"))
    plan = t.spark.sql("EXPLAIN FORMATTED SELECT * FROM {counted}", counted=counted).first()[0]
    pushed = int("GreaterThan(o_totalprice,100000.0)" in plan)
    pruned = int("ReadSchema: struct<o_orderstatus:string,o_totalprice:double>" in plan)
    return counted.withColumns({"filter_pushed": F.lit(pushed).cast("long"), "columns_pruned": F.lit(pruned).cast("long")})


@query(
    "session_conf",
    """SELECT o_orderpriority, COUNT(*) AS orders, CAST(1 AS BIGINT) AS adaptive, CAST(1 AS BIGINT) AS partition_bytes,
       CAST(1 AS BIGINT) AS open_cost, CAST(1 AS BIGINT) AS shuffle_partitions FROM orders GROUP BY o_orderpriority""",
)
def session_conf(t):
    # values that are nobody's default are set in a session of their own and must arrive in its plans
    session = t.spark.newSession()
    names = {
        "adaptive": "spark.sql.adaptive.enabled",
        "partition_bytes": "spark.sql.files.maxPartitionBytes",
        "open_cost": "spark.sql.files.openCostInBytes",
        "shuffle_partitions": "spark.sql.shuffle.partitions",
    }
    wanted = {**session_settings(13), "spark.sql.files.maxPartitionBytes": "65536", "spark.sql.files.openCostInBytes": "0"}
    for name in names.values():
        session.conf.set(name, wanted[name])
    orders = session.read.parquet(t.path("orders"))
    counted = orders.groupBy("o_orderpriority").agg(F.count("*").alias("orders"))
    plan = counted._jdf.queryExecution().executedPlan().toString()
    size = sum(r["length"] for r in list_files(session, t.path("orders")).select("length").collect())
    splits = orders.rdd.getNumPartitions()
    holds = {
        "adaptive": "AdaptiveSparkPlan" in plan,
        "partition_bytes": splits >= size / 65536,
        "open_cost": session.conf.get(names["open_cost"]) == "0",
        "shuffle_partitions": ", 13)" in plan,
    }
    return counted.withColumns({name: F.lit(int(ok)).cast("long") for name, ok in holds.items()})


@query(
    "column_pruning",
    "SELECT l_returnflag, CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity FROM lineitem GROUP BY l_returnflag",
)
def column_pruning(t):
    return t["lineitem"].groupBy("l_returnflag").agg(F.sum(money("l_quantity")).cast("double").alias("quantity"))


@query("partition_pruning", event_sql("WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-09'"))
def partition_pruning(t):
    events = read_batch(t.spark, "csv", f"{dated_feed(t)}/events", schema=EVENTS.schema)
    return event_days(events.where("batch_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-09'"))


@query(
    "timed_action",
    "SELECT 'count lineitem' AS label, COUNT(*) AS row_count, CAST(1 AS BIGINT) AS was_timed FROM lineitem",
)
def timed_action(t):
    lines = t["lineitem"]
    result = timed("count lineitem", lines.count)
    facts = scan_facts(lines)
    was_timed = int(result.seconds > 0 and facts["input_files"] > 0)
    return t.spark.createDataFrame(
        [(result.label, result.value, was_timed)], "label string, row_count bigint, was_timed bigint"
    )

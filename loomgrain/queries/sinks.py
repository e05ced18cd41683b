"""Sinks: whole tables are written, read back and compared."""

from pyspark.sql import functions as F

from loomgrain.contracts import AUDIT_SCHEMA
from loomgrain.functions.values import money
from loomgrain.operators.quality import split, validate_io_rows, with_payload
from loomgrain.plans.loads import load
from loomgrain.plans.publish import current_version, publish, read_version
from loomgrain.queries.registry import own_name, query
from loomgrain.queries.shapes import (
    CUSTOMER,
    ORDERS,
    SPOILT,
    order_sql,
    order_summary,
    side_by_side,
    spoilt_csv,
)
from loomgrain.session import fresh_path
from loomgrain.sinks.tables import create_namespace, register_views, replace_table
from loomgrain.sinks.writers import write_rejects, write_table
from loomgrain.sources.readers import read_by_contract, read_table

c = F.col


def written(t, fmt, table="orders", contract=ORDERS):
    path = fresh_path(t.spark, f"{table}-{fmt}")
    write_table(t[table], fmt, path, mode="overwrite")
    return read_table(t.spark, fmt, path, schema=contract.schema)


@query("write_parquet", order_sql())
def write_parquet(t):
    return order_summary(written(t, "parquet"))


@query("write_csv", order_sql())
def write_csv(t):
    return order_summary(written(t, "csv"))


@query("write_json", order_sql())
def write_json(t):
    return order_summary(written(t, "json"))


@query(
    "write_by_format",
    """SELECT f.fmt AS "format", c_mktsegment, COUNT(*) AS customers FROM customer,
       (SELECT unnest(['csv', 'json', 'parquet']) AS fmt) f GROUP BY 1, 2""",
)
def write_by_format(t):
    frames = [written(t, fmt, "customer", CUSTOMER).withColumn("format", F.lit(fmt)) for fmt in ("csv", "json", "parquet")]
    everything = frames[0].unionByName(frames[1]).unionByName(frames[2])
    return everything.groupBy("format", "c_mktsegment").agg(F.count("*").alias("customers"))


@query("write_append", order_sql())
def write_append(t):
    path = fresh_path(t.spark, "orders-appended")
    for status in ("F", "O", "P"):
        write_table(t["orders"].where(c("o_orderstatus") == status), "parquet", path, mode="append")
    return order_summary(t.spark.read.schema(ORDERS.schema).parquet(path))


@query(
    "write_partitioned",
    """SELECT o_orderstatus, COUNT(*) AS orders, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
       FROM orders GROUP BY o_orderstatus""",
)
def write_partitioned(t):
    path = fresh_path(t.spark, "orders-by-status")
    write_table(t["orders"], "parquet", path, partition_by=["o_orderstatus"])
    # then one partition is written again and must not touch the others
    finished = t["orders"].where(c("o_orderstatus") == "F")
    write_table(finished, "parquet", path, "overwrite", ["o_orderstatus"], replace_partitions=True)
    kept = t.spark.read.schema(ORDERS.schema).parquet(path)
    return kept.groupBy("o_orderstatus").agg(
        F.count("*").alias("orders"), F.sum(money("o_totalprice")).cast("double").alias("revenue")
    )


@query(
    "write_versioned",
    """SELECT v AS version, COUNT(*) AS parts, CAST(SUM(p_size + CASE WHEN v = 2 THEN 1 ELSE 0 END) AS BIGINT) AS sizes
       FROM part, (VALUES (1), (2)) versions(v) GROUP BY v""",
)
def write_versioned(t):
    root = fresh_path(t.spark, "part-versions")
    base = publish(t["part"], root, 1)
    publish(base.withColumn("p_size", c("p_size") + 1), root, 2, lambda written: written.count() == base.count())
    newest = current_version(t.spark, root)
    both = read_version(t.spark, root, 1).withColumn("version", F.lit(1)).unionByName(
        read_version(t.spark, root).withColumn("version", F.lit(newest).cast("int"))
    )
    return both.groupBy("version").agg(F.count("*").alias("parts"), F.sum(c("p_size").cast("long")).alias("sizes"))


@query("table_create", order_sql("WHERE o_orderstatus <> 'P'"))
def table_create(t):
    name = own_name(t.spark, "sink")
    create_namespace(t.spark, name, t.staged("sink-namespace", lambda path: None))
    replace_table(t.spark, f"{name}.orders", t["orders"])
    # the second call drops the first table
    table = replace_table(t.spark, f"{name}.orders", t["orders"].where(c("o_orderstatus") != "P"))
    return order_summary(table)


@query(
    "namespace_create",
    """SELECT 'loomgrain_lake' AS namespace, 'customer' AS table_name, COUNT(*) AS row_count FROM customer""",
)
def namespace_create(t):
    location = t.staged("lake-namespace", lambda path: None)
    name = own_name(t.spark, "lake")
    create_namespace(t.spark, name, location)
    create_namespace(t.spark, name, location)
    replace_table(t.spark, f"{name}.customer", t["customer"])
    listed = t.spark.sql(f"SHOW TABLES IN {name}").where("tableName = 'customer' AND NOT isTemporary")
    rows = t.spark.table(f"{name}.customer").agg(F.count(F.lit(1)).alias("row_count"))
    # the application's part of the name is left out
    plain = F.regexp_extract("namespace", "^(loomgrain_lake)_", 1)
    return side_by_side(rows, listed.select(plain.alias("namespace"), c("tableName").alias("table_name")))


@query(
    "temp_view",
    """SELECT n_name, COUNT(*) AS suppliers FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name""",
)
def temp_view(t):
    register_views({"loomgrain_supplier": t["supplier"], "loomgrain_nation": t["nation"]})
    return t.spark.sql(
        """SELECT n_name, COUNT(*) AS suppliers FROM loomgrain_supplier
           JOIN loomgrain_nation ON s_nationkey = n_nationkey GROUP BY n_name"""
    )


REASONS = """CASE WHEN o_orderkey % 10 IN (3, 4, 5) THEN 'malformed_record'
    WHEN o_orderkey % 10 = 6 THEN 'missing_product_id' WHEN o_orderkey % 10 = 7 THEN 'negative_amount'
    WHEN o_orderkey % 10 = 8 THEN 'invalid_event_date' END"""


@query(
    "quarantine_write",
    f"SELECT reason, COUNT(*) AS rejects FROM (SELECT {REASONS} AS reason FROM orders) r WHERE reason IS NOT NULL GROUP BY reason",
)
def quarantine_write(t):
    path = fresh_path(t.spark, "quarantine")
    rows = read_by_contract(t.spark, "csv", spoilt_csv(t), SPOILT, typed=True, header=False)
    accepted, rejected = split(validate_io_rows(with_payload(rows, SPOILT)))
    write_rejects(rejected, path)
    # accepted rows hold no rejects, so nothing more is written
    write_rejects(split(accepted)[1], path)
    rejects = t.spark.read.parquet(path)
    return rejects.groupBy(c("_error_reason").alias("reason")).agg(F.count("*").alias("rejects"))


# by the all-text contract a price that is no number fails its cast instead, and sign and date text are no concern
LOADED = """SELECT 'nightly' AS scenario, 'spoilt_orders' AS target_table,
    CAST(COUNT(CASE WHEN o_orderkey % 10 NOT IN (3, 4, 5, 6) THEN 1 END) AS BIGINT) AS accepted_rows,
    CAST(COUNT(CASE WHEN o_orderkey % 10 IN (3, 4, 5, 6) THEN 1 END) AS BIGINT) AS rejected_rows FROM orders"""


def nightly_load(t):
    """Load the spoilt orders; returns (audit path, target path, reject root)."""
    audit, target, rejects = (fresh_path(t.spark, x) for x in ("audit", "target", "rejects"))

    def to_parquet(accepted, contract, writers):
        write_table(accepted, "parquet", f"{target}/{contract.name}", mode="overwrite")

    load(t.spark, "csv", spoilt_csv(t), SPOILT, to_parquet, "nightly", rejects, audit, header=False)
    return audit, target, rejects


@query("audit_write", LOADED)
def audit_write(t):
    audit, _, _ = nightly_load(t)
    record = t.spark.read.schema(AUDIT_SCHEMA).parquet(audit)
    return record.select("scenario", "target_table", "accepted_rows", "rejected_rows")


@query("show_rows", "SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders ORDER BY o_orderkey LIMIT 10")
def show_rows(t):
    return t["orders"].select("o_orderkey", "o_totalprice", "o_orderpriority").orderBy("o_orderkey").limit(10)

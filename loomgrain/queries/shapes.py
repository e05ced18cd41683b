"""Shared pieces of the source, sink and dataflow queries."""

from math import ceil

from pyspark.sql import functions as F

from loomgrain.contracts import contract
from loomgrain.functions.values import money
from loomgrain.plans.lake import union_by_name, write_dated

c = F.col

ORDERS = contract(
    "orders",
    {
        "o_orderkey": "bigint",
        "o_custkey": "bigint",
        "o_orderstatus": "string",
        "o_totalprice": "double",
        "o_orderdate": "timestamp_ntz",
        "o_orderpriority": "string",
    },
    "o_orderkey",
    is_fact=True,
)
CUSTOMER = contract(
    "customer",
    {"c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_acctbal": "double", "c_mktsegment": "string"},
    "c_custkey",
)
PART = contract(
    "part",
    {
        "p_partkey": "bigint",
        "p_name": "string",
        "p_brand": "string",
        "p_type": "string",
        "p_size": "int",
        "p_retailprice": "double",
    },
    "p_partkey",
)
EVENTS = contract(
    "events",
    {
        "event_id": "bigint",
        "ts": "timestamp_ntz",
        "user_id": "bigint",
        "event_type": "string",
        "value": "double",
        "props": "string",
    },
    "event_id",
)
CONTRACTS = {x.name: x for x in (ORDERS, CUSTOMER, PART, EVENTS)}

ORDER_SUMMARY = """SELECT o_orderstatus, o_orderpriority, COUNT(*) AS orders, CAST(SUM(o_custkey) AS BIGINT) AS customers,
    CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
    strftime(MIN(o_orderdate), '%Y-%m-%d') AS first_day, strftime(MAX(o_orderdate), '%Y-%m-%d') AS last_day
    FROM orders {where} GROUP BY o_orderstatus, o_orderpriority"""


def order_sql(where=""):
    return ORDER_SUMMARY.format(where=where)


def order_summary(orders):
    """Per status and priority: every column of the orders leaves a trace in the result."""
    return orders.groupBy("o_orderstatus", "o_orderpriority").agg(
        F.count("*").alias("orders"),
        F.sum(c("o_custkey").cast("long")).alias("customers"),
        F.sum(money("o_totalprice")).cast("double").alias("revenue"),
        F.date_format(F.min("o_orderdate"), "yyyy-MM-dd").alias("first_day"),
        F.date_format(F.max("o_orderdate"), "yyyy-MM-dd").alias("last_day"),
    )


SLICE_ROWS = 2_000_000


def spread(df, least):
    """``df`` over ``least`` partitions, or as many as its rows need."""
    return df.repartition(max(least, ceil(df.count() / SLICE_ROWS)))


def spread_sql(least):
    """The number of partitions ``spread`` takes, over the rows at hand."""
    return f"CAST(GREATEST({least}, ceil(COUNT(*) / {SLICE_ROWS}.0)) AS BIGINT)"


def side_by_side(*frames):
    """One row out of several one-row frames, without joining them."""
    stacked = union_by_name(list(frames))
    return stacked.agg(*[F.max(name).alias(name) for name in stacked.columns])


EVENT_DAYS = """SELECT strftime(ts, '%Y-%m-%d') AS batch_date, COUNT(*) AS events,
    CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM events {where} GROUP BY 1"""


def event_sql(where=""):
    return EVENT_DAYS.format(where=where)


def event_days(events):
    return events.groupBy(c("batch_date").cast("string").alias("batch_date")).agg(
        F.count("*").alias("events"), F.sum(money("value")).cast("double").alias("total")
    )


def dated_events(t):
    return t["events"].withColumn("batch_date", c("ts").cast("date"))


def dated_feed(t, fmt="csv"):
    """The events as a feed of ``<root>/events/batch_date=`` folders."""
    return t.staged(f"feed-{fmt}", lambda root: write_dated(dated_events(t), fmt, f"{root}/events", "bulk"))


# lines of the orders as CSV text, spoilt by the last digit of the key:
# 3: one field short, 4: one field too many, 5: a price that is no number,
# 6: no customer, 7: a negative price, 8: a date that is none
def spoilt_order_lines(t):
    digit = c("o_orderkey") % 10
    price = (
        F.when(digit == 5, "not_a_number")
        .when(digit == 7, (-c("o_totalprice")).cast("string"))
        .otherwise(c("o_totalprice").cast("string"))
    )
    day = F.when(digit == 8, "bad-date").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    customer = F.when(digit == 6, "").otherwise(c("o_custkey").cast("string"))
    full = F.concat_ws(",", c("o_orderkey").cast("string"), customer, price, day)
    line = (
        F.when(digit == 3, F.concat_ws(",", c("o_orderkey").cast("string"), customer, price))
        .when(digit == 4, F.concat(full, F.lit(",unexpected")))
        .otherwise(full)
    )
    return t["orders"].select(line.alias("value"))


SPOILT = contract(
    "spoilt_orders",
    {"record_id": "bigint", "product_id": "bigint", "amount": "double", "event_date": "string"},
    "record_id",
)


def spoilt_csv(t):
    return t.staged("spoilt-csv", lambda path: spoilt_order_lines(t).write.text(path))


def spoilt_json(t):
    """The same rows as JSON lines; digit 3 breaks off, digit 4 has one more field."""
    digit = c("o_orderkey") % 10
    row = F.to_json(
        F.struct(
            c("o_orderkey").alias("record_id"),
            F.when(digit != 6, c("o_custkey")).alias("product_id"),
            F.when(digit == 5, "not_a_number")
            .when(digit == 7, (-c("o_totalprice")).cast("string"))
            .otherwise(c("o_totalprice").cast("string"))
            .alias("amount"),
            F.when(digit == 8, "bad-date").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("event_date"),
            F.when(digit == 4, "unexpected").alias("extra"),
        )
    )
    line = F.when(digit == 3, F.expr("left(line, length(line) - 2)")).otherwise(c("line"))
    return t.staged(
        "spoilt-json",
        lambda path: t["orders"].withColumn("line", row).select(line.alias("value")).write.text(path),
    )

"""Scalar functions."""

from datetime import datetime, timezone

from pyspark.sql import functions as F

from loomgrain.functions.values import normal_code, normal_email, try_convert, try_date
from loomgrain.queries.registry import query
from loomgrain.session import materialise

c = F.col


def part(t, name, column):
    return t["part"].select("p_partkey", column.alias(name))


def customer(t, name, column):
    return t["customer"].select("c_custkey", column.alias(name))


@query("substring", "SELECT p_partkey, substring(p_name, 1, 5) AS name_start FROM part")
def substring(t):
    return part(t, "name_start", F.substring("p_name", 1, 5))


@query(
    "concat",
    """SELECT c_custkey, c_name || '-' || CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS label FROM customer""",
)
def concat(t):
    segment = F.when(c("c_acctbal") >= 0, c("c_mktsegment"))
    return customer(t, "label", F.concat("c_name", F.lit("-"), segment))


@query(
    "concat_ws",
    """SELECT c_custkey, concat_ws('-', c_name, CASE WHEN c_acctbal >= 0 THEN c_mktsegment END) AS label
       FROM customer""",
)
def concat_ws(t):
    segment = F.when(c("c_acctbal") >= 0, c("c_mktsegment"))
    return customer(t, "label", F.concat_ws("-", "c_name", segment))


@query("lower", "SELECT c_custkey, lower(c_mktsegment) AS segment FROM customer")
def lower(t):
    return customer(t, "segment", F.lower("c_mktsegment"))


@query("upper", "SELECT p_partkey, upper(p_name) AS name FROM part")
def upper(t):
    return part(t, "name", F.upper("p_name"))


def padded():
    """Names with as many spaces around them as the last digits of the key say."""
    pad = lambda n: F.repeat(F.lit(" "), n.cast("int"))
    return F.concat(pad(c("p_partkey") % 4), "p_name", pad(c("p_partkey") % 3))


PADDED = "repeat(' ', CAST(p_partkey % 4 AS INT)) || p_name || repeat(' ', CAST(p_partkey % 3 AS INT))"


@query("trim", f"SELECT p_partkey, trim({PADDED}) AS name FROM part")
def trim(t):
    return part(t, "name", F.trim(padded()))


@query("ltrim", f"SELECT p_partkey, ltrim({PADDED}) AS name FROM part")
def ltrim(t):
    return part(t, "name", F.ltrim(padded()))


@query("rtrim", f"SELECT p_partkey, rtrim({PADDED}) AS name FROM part")
def rtrim(t):
    return part(t, "name", F.rtrim(padded()))


@query("charindex", "SELECT p_partkey, CAST(instr(p_name, 'a') AS BIGINT) AS position_of_a FROM part")
def charindex(t):
    return part(t, "position_of_a", F.instr("p_name", "a").cast("long"))


@query("left", "SELECT c_custkey, left(c_mktsegment, 3) AS code FROM customer")
def left(t):
    return customer(t, "code", F.left("c_mktsegment", F.lit(3)))


@query("right", "SELECT c_custkey, right(c_name, 3) AS code FROM customer")
def right(t):
    return customer(t, "code", F.right("c_name", F.lit(3)))


@query("reverse", "SELECT p_partkey, reverse(p_name) AS name FROM part")
def reverse(t):
    return part(t, "name", F.reverse("p_name"))


@query("replace", "SELECT c_custkey, replace(c_name, '#', ' no. ') AS name FROM customer")
def replace(t):
    return customer(t, "name", F.replace("c_name", F.lit("#"), F.lit(" no. ")))


@query("regexp_replace", "SELECT c_custkey, regexp_replace(c_name, '0+', '_', 'g') AS name FROM customer")
def regexp_replace(t):
    return customer(t, "name", F.regexp_replace("c_name", "0+", "_"))


@query("length", "SELECT doc_id, CAST(length(text) AS BIGINT) AS characters FROM documents")
def length(t):
    return t["documents"].select("doc_id", F.length("text").cast("long").alias("characters"))


@query(
    "coalesce",
    """SELECT o_orderkey, COALESCE(CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END, 0) AS paid
       FROM orders""",
)
def coalesce(t):
    paid = F.when(c("o_orderstatus") == "P", None).otherwise(c("o_totalprice"))
    return t["orders"].select("o_orderkey", F.coalesce(paid, F.lit(0.0)).alias("paid"))


@query("round", "SELECT o_orderkey, ROUND(o_totalprice / 7, 2) AS weekly FROM orders")
def round_(t):
    return t["orders"].select("o_orderkey", F.round(c("o_totalprice") / 7, 2).alias("weekly"))


@query(
    "to_date_fmt",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders""",
)
def to_date_fmt(t):
    good = F.date_format("o_orderdate", "yyyy-MM-dd")
    text = F.when(c("o_orderkey") % 7 == 0, F.lit("bad-date")).otherwise(good)
    return t["orders"].select("o_orderkey", try_date(text).cast("string").alias("day"))


@query(
    "cast_types",
    """SELECT event_id, TRY_CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k,
       CAST(CAST(value AS DECIMAL(14,2)) AS DOUBLE) AS amount, CAST(event_id % 2 AS BIGINT) AS flag,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS moment, CAST(NULL AS BIGINT) AS no_number FROM events""",
)
def cast_types(t):
    digits = F.regexp_extract("props", "[0-9]+", 0)
    flag = F.when(c("event_id") % 2 == 1, "true").otherwise("false")
    moment = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return t["events"].select(
        "event_id",
        try_convert(digits, "bigint").alias("k"),
        try_convert(c("value").cast("string"), "decimal(14,2)").cast("double").alias("amount"),
        try_convert(flag, "boolean").cast("long").alias("flag"),
        F.date_format(try_convert(moment, "timestamp_ntz"), "yyyy-MM-dd HH:mm:ss").alias("moment"),
        try_convert(c("event_type"), "bigint").alias("no_number"),
    )


@query(
    "load_timestamp",
    "SELECT c_custkey, CAST(1 AS BIGINT) AS in_time, CAST(1 AS BIGINT) AS load_times FROM customer",
)
def load_timestamp(t):
    # the stamp lies between two times of the driver, and one query has one stamp
    before = datetime.now(timezone.utc)
    stamped = materialise(t["customer"].select("c_custkey", F.current_timestamp().alias("load_ts")), "stamped")
    after = datetime.now(timezone.utc)
    in_time = c("load_ts").between(F.lit(before), F.lit(after))
    times = stamped.agg(F.count_distinct("load_ts").alias("load_times")).first()["load_times"]
    return stamped.select(
        "c_custkey", in_time.cast("int").cast("long").alias("in_time"), F.lit(times).cast("long").alias("load_times")
    )


@query(
    "row_to_json",
    """SELECT p_partkey, '{"p_partkey":' || p_partkey || ',"p_name":"' || p_name || '"' ||
       CASE WHEN p_size > 25 THEN ',"p_brand":"' || p_brand || '"' ELSE '' END || '}' AS payload FROM part""",
)
def row_to_json(t):
    # a NULL field is left out of the text
    brand = F.when(c("p_size") > 25, c("p_brand")).alias("p_brand")
    return part(t, "payload", F.to_json(F.struct("p_partkey", "p_name", brand)))


@query("upper_trim", f"SELECT p_partkey, upper(trim({PADDED})) AS code FROM part")
def upper_trim(t):
    return part(t, "code", normal_code(padded()))


@query(
    "lower_trim",
    "SELECT c_custkey, lower(trim('  ' || c_name || '@Example.COM ')) AS email FROM customer",
)
def lower_trim(t):
    return customer(t, "email", normal_email(F.concat(F.lit("  "), "c_name", F.lit("@Example.COM "))))


@query(
    "date_compare",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders
       WHERE strftime(o_orderdate, '%Y-%m-%d') >= '1997-01-01' AND o_orderdate < TIMESTAMP '1999-01-01'""",
)
def date_compare(t):
    # the range reaches the scan as a timestamp; the text form only holds for ISO dates
    kept = t["orders"].where(
        (c("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz"))
        & (c("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz"))
    )
    return kept.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))

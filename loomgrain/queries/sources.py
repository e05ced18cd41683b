"""Scans and sources. Each writes whole tables in the format under test and reads them back."""

from pyspark.sql import functions as F

from loomgrain.contracts import CORRUPT
from loomgrain.functions.values import money
from loomgrain.queries.registry import own_name, query
from loomgrain.queries.shapes import (
    CUSTOMER,
    EVENTS,
    ORDERS,
    SPOILT,
    dated_feed,
    event_days,
    event_sql,
    order_sql,
    order_summary,
    side_by_side,
    spoilt_csv,
    spoilt_json,
    spread,
    spread_sql,
)
from loomgrain.sinks.tables import create_namespace, replace_table
from loomgrain.sinks.writers import write_table
from loomgrain.sources.files import build_manifest, inventory, parse_zip_csv, read_manifests, unzip_lines
from loomgrain.sources.readers import (
    read_batch,
    read_by_contract,
    read_parts,
    read_table,
    read_tolerant_parquet,
    with_source_file,
)
from loomgrain.sources.routing import route

c = F.col
FILES = 8


@query("csv_infer", order_sql())
def csv_infer(t):
    return order_summary(read_table(t.spark, "csv", t.copy("orders", "csv")))


@query("csv_schema", order_sql("WHERE o_totalprice >= 100000"))
def csv_schema(t):
    orders = read_table(t.spark, "csv", t.copy("orders", "csv"), schema=ORDERS.schema)
    return order_summary(orders.where(c("o_totalprice") >= 100000))


# the typed schema rejects the fields' number and the price that is no number
SPOILT_TYPED = """SELECT CASE WHEN o_orderkey % 10 IN (3, 4, 5) THEN 'malformed' ELSE 'parsed' END AS outcome,
    COUNT(*) AS lines, CAST(SUM(CASE WHEN o_orderkey % 10 NOT IN (3, 4, 5) THEN o_orderkey ELSE 0 END) AS BIGINT) AS keys,
    CAST(SUM(CASE WHEN o_orderkey % 10 NOT IN (3, 4, 5, 6) THEN o_custkey ELSE 0 END) AS BIGINT) AS products,
    CAST(SUM(CASE WHEN o_orderkey % 10 IN (3, 4, 5) THEN 0 WHEN o_orderkey % 10 = 7 THEN -CAST(o_totalprice AS DECIMAL(18,2))
         ELSE CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE) AS amount,
    COUNT(CASE WHEN o_orderkey % 10 = 8 THEN 1 END) AS bad_dates FROM orders GROUP BY 1"""


@query("csv_permissive", SPOILT_TYPED)
def csv_permissive(t):
    rows = read_by_contract(t.spark, "csv", spoilt_csv(t), SPOILT, typed=True, header=False)
    parsed = c(CORRUPT).isNull()
    value = lambda name: F.coalesce(F.when(parsed, c(name)), F.lit(0))
    # the parser only checks the columns a query asks for, so all of them are used
    return rows.groupBy(F.when(parsed, "parsed").otherwise("malformed").alias("outcome")).agg(
        F.count("*").alias("lines"),
        F.sum(value("record_id")).alias("keys"),
        F.sum(value("product_id")).alias("products"),
        F.sum(money(value("amount"))).cast("double").alias("amount"),
        F.count_if(parsed & (c("event_date") == "bad-date")).alias("bad_dates"),
    )


@query("json_infer", order_sql())
def json_infer(t):
    orders = read_table(t.spark, "json", t.copy("orders", "json"))
    return order_summary(orders.withColumn("o_orderdate", c("o_orderdate").cast("timestamp_ntz")))


@query(
    "json_permissive",
    """SELECT CASE WHEN o_orderkey % 10 = 3 THEN 'malformed' ELSE 'parsed' END AS outcome, COUNT(*) AS lines,
       CAST(COUNT(CASE WHEN o_orderkey % 10 NOT IN (3, 6) THEN 1 END) AS BIGINT) AS with_product FROM orders GROUP BY 1""",
)
def json_permissive(t):
    rows = read_by_contract(t.spark, "json", spoilt_json(t), SPOILT, multiLine=False)
    malformed = c(CORRUPT).isNotNull()
    return (
        rows.select(F.when(malformed, "malformed").otherwise("parsed").alias("outcome"), "record_id", "product_id")
        .groupBy("outcome")
        .agg(
            F.count("*").alias("lines"),
            F.count_if((c("outcome") == "parsed") & c("product_id").isNotNull()).alias("with_product"),
        )
    )


def order_parts(t):
    """The orders as a folder of parts."""
    return t.staged("orders-parts", lambda path: spread(t["orders"], FILES).write.parquet(path))


@query("parquet_dir", order_sql())
def parquet_dir(t):
    return order_summary(t.spark.read.parquet(order_parts(t)))


@query("parquet_paths", order_sql())
def parquet_paths(t):
    halves = t.staged(
        "orders-halves",
        lambda path: [
            t["orders"].where(c("o_orderkey") % 2 == rest).write.parquet(f"{path}/part_{rest}") for rest in (0, 1)
        ],
    )
    return order_summary(read_parts(t.spark, [f"{halves}/part_1", f"{halves}/part_0"]))


@query("glob_scan", order_sql())
def glob_scan(t):
    folder = t.staged(
        "orders-globbed",
        lambda path: [
            write_table(t["orders"].where(c("o_orderkey") % 2 == rest), "csv", f"{path}/orders_part_{rest}")
            for rest in (0, 1)
        ]
        + [write_table(t["customer"], "csv", f"{path}/customer_part_0")],
    )
    return order_summary(read_table(t.spark, "csv", f"{folder}/orders_part_*", schema=ORDERS.schema))


@query(
    "read_by_format",
    """SELECT f.fmt AS "format", COUNT(*) AS customers, CAST(SUM(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance
       FROM customer, (SELECT unnest(['csv', 'json', 'parquet']) AS fmt) f GROUP BY 1""",
)
def read_by_format(t):
    frames = [
        read_table(t.spark, fmt, t.copy("customer", fmt), schema=CUSTOMER.schema).withColumn("format", F.lit(fmt))
        for fmt in ("csv", "json", "parquet")
    ]
    all_formats = frames[0].unionByName(frames[1]).unionByName(frames[2])
    return all_formats.groupBy("format").agg(
        F.count("*").alias("customers"),
        F.sum(c("c_acctbal").cast("decimal(18,2)")).cast("double").alias("balance"),
    )


@query("partition_discovery", event_sql())
def partition_discovery(t):
    return event_days(read_batch(t.spark, "csv", f"{dated_feed(t)}/events", schema=EVENTS.schema))


@query("single_batch_scan", event_sql("WHERE CAST(ts AS DATE) = DATE '2024-01-03'"))
def single_batch_scan(t):
    return event_days(read_batch(t.spark, "csv", f"{dated_feed(t)}/events", "2024-01-03", schema=EVENTS.schema))


@query(
    "tolerant_parquet",
    f"""SELECT {spread_sql(FILES)} AS files_read, {spread_sql(2)} AS files_skipped, COUNT(*) AS row_count
        FROM orders""",
)
def tolerant_parquet(t):
    def write(path):
        spread(t["orders"], FILES).write.parquet(f"{path}/good")
        # the same rows as text: no Parquet reader can open these
        spread(t["orders"].select(F.to_json(F.struct("*")).alias("value")), 2).write.text(f"{path}/bad")

    folder = t.staged("orders-mixed", write)
    _, files = read_tolerant_parquet(t.spark, [f"{folder}/good", f"{folder}/bad"], ORDERS.schema)
    return files.agg(
        F.count_if("was_read").alias("files_read"),
        F.count_if(~c("was_read")).alias("files_skipped"),
        F.sum("rows").alias("row_count"),
    )


ARCHIVE_ROWS = 5000


def zipper():
    """Packs a slice of the lines into one archive, next to a member that tries to leave the folder.

    A nested function travels to the executors by value, so they need not have this package.
    """

    def zip_lines(pdf):
        import io
        import zipfile

        import pandas as pd

        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w", compression=zipfile.ZIP_DEFLATED) as archive:
            text = "record_id,product_id,amount,event_date\n" + "".join(line + "\n" for line in pdf["value"])
            archive.writestr("incoming/extract.csv", text)
            archive.writestr("../evil.csv", "1,1,1,2026-01-01\n")
        name = f"archive_{pdf['archive_no'].iloc[0]:08d}.zip"
        return pd.DataFrame({"path": [name], "content": [buffer.getvalue()]})

    return zip_lines


@query(
    "zip_csv_scan",
    f"""SELECT CAST(floor(o_orderkey / {ARCHIVE_ROWS}) AS BIGINT) AS archive_no, COUNT(*) AS row_count,
        CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS amount FROM orders GROUP BY 1""",
)
def zip_csv_scan(t):
    lines = t["orders"].select(
        F.floor(c("o_orderkey") / ARCHIVE_ROWS).alias("archive_no"),
        F.concat_ws(
            ",", c("o_orderkey").cast("string"), c("o_custkey").cast("string"), c("o_totalprice").cast("string"),
            F.date_format("o_orderdate", "yyyy-MM-dd"),
        ).alias("value"),
    )
    # the key is unique, so an archive never holds more than ARCHIVE_ROWS lines
    archives = lines.groupBy("archive_no").applyInPandas(zipper(), "path string, content binary")
    rows = parse_zip_csv(unzip_lines(archives), SPOILT, unsafe="skip")
    return (
        rows.groupBy(F.regexp_extract("archive", "([0-9]+)", 1).cast("long").alias("archive_no"))
        .agg(F.count("*").alias("row_count"), F.sum(c("amount").cast("decimal(18,2)")).cast("double").alias("amount"))
    )


@query("object_store_scan", order_sql())
def object_store_scan(t):
    # any URI a Hadoop file system answers to; s3a:// needs session.object_store_settings
    path = t.path("orders")
    return order_summary(t.spark.read.parquet(path if ":/" in path else f"file://{path}"))


@query("catalog_table_scan", order_sql())
def catalog_table_scan(t):
    name = own_name(t.spark, "scan")

    def write(path):
        create_namespace(t.spark, name, path)
        replace_table(t.spark, f"{name}.orders", t["orders"])

    t.staged("catalog-scan", write)
    return order_summary(t.spark.table(f"{name}.orders"))


@query(
    "inline_rows",
    """SELECT weight, COUNT(*) AS orders FROM orders JOIN
       (VALUES ('1-URGENT', 5), ('2-HIGH', 4), ('3-MEDIUM', 3), ('5-LOW', 1)) w(priority, weight)
       ON o_orderpriority = priority GROUP BY weight""",
)
def inline_rows(t):
    # four rows by definition, so the broadcast is bounded
    weights = t.spark.createDataFrame(
        [("1-URGENT", 5), ("2-HIGH", 4), ("3-MEDIUM", 3), ("5-LOW", 1)], "o_orderpriority string, weight int"
    )
    return t["orders"].join(F.broadcast(weights), "o_orderpriority").groupBy("weight").agg(F.count("*").alias("orders"))


def two_tables(t):
    """Orders and customers, each as a folder with a set number of files."""
    return t.staged(
        "inventory",
        lambda path: [spread(t[n], least).write.parquet(f"{path}/{n}") for n, least in (("orders", FILES), ("customer", 2))],
    )


@query(
    "file_inventory",
    f"""SELECT 'orders' AS table_name, {spread_sql(FILES)} AS files, COUNT(*) AS row_count FROM orders
        UNION ALL SELECT 'customer', {spread_sql(2)}, COUNT(*) FROM customer""",
)
def file_inventory(t):
    folder = two_tables(t)
    found = inventory(t.spark, folder, "*.parquet").where(c("bytes") > 0).select("table_name", "files")
    counted = None
    for name in ("orders", "customer"):
        rows = t.spark.read.parquet(f"{folder}/{name}").agg(F.count(F.lit(1)).alias("row_count"))
        rows = rows.withColumn("table_name", F.lit(name))
        counted = rows if counted is None else counted.unionByName(rows)
    return found.join(counted, "table_name").select("table_name", "files", "row_count")


def manifest(t):
    """A manifest with the expected rows of three tables."""

    def write(path):
        entries = None
        for name in ("orders", "customer", "lineitem"):
            entry = t[name].agg(F.count(F.lit(1)).alias("rows")).select(
                F.struct(
                    F.lit(name).alias("table"),
                    F.lit("parquet").alias("format"),
                    F.lit(1).cast("long").alias("files"),
                    "rows",
                ).alias("entry")
            )
            entries = entry if entries is None else entries.unionByName(entry)
        # three entries
        gathered = entries.agg(F.sort_array(F.collect_list("entry")).alias("tables"))
        gathered.select(F.lit("daily").alias("scenario"), "tables").write.json(path)

    return t.staged("manifest", write)


@query(
    "manifest_scan",
    """SELECT 'daily' AS scenario, n AS table_name, 'parquet' AS "format", CAST(1 AS BIGINT) AS files, r AS "rows"
       FROM (SELECT 'orders' AS n, COUNT(*) AS r FROM orders UNION ALL SELECT 'customer', COUNT(*) FROM customer
             UNION ALL SELECT 'lineitem', COUNT(*) FROM lineitem) x""",
)
def manifest_scan(t):
    return read_manifests(t.spark, manifest(t))


@query(
    "source_lineage",
    """SELECT CAST(o_orderkey % 2 AS BIGINT) AS part_no, COUNT(*) AS orders FROM orders GROUP BY 1""",
)
def source_lineage(t):
    folder = t.staged(
        "orders-lineage",
        lambda path: [
            t["orders"].where(c("o_orderkey") % 2 == rest).write.parquet(f"{path}/piece={rest}") for rest in (0, 1)
        ],
    )
    rows = with_source_file(t.spark.read.parquet(folder).drop("piece"))
    return rows.groupBy(F.regexp_extract("_source_file", "piece=([0-9])", 1).cast("long").alias("part_no")).agg(
        F.count("*").alias("orders")
    )


ROUTES = {
    "01": ("parties", "daily", ("customer",)),
    "02": ("catalogue", "daily", ("part", "customer")),
    "03": ("trade", "daily", ("orders",)),
}


@query(
    "source_routing",
    """SELECT '01' AS scenario, 'customer' AS table_name, COUNT(*) AS row_count FROM customer UNION ALL
       SELECT '02', 'part', COUNT(*) FROM part UNION ALL SELECT '02', 'customer', COUNT(*) FROM customer""",
)
def source_routing(t):
    root = t.staged(
        "routes",
        lambda path: [t[table].write.parquet(p) for _, table, p in route(path, "all", "parquet", ROUTES)],
    )
    counted = None
    for scenario, table, path in route(root, "1,02", "parquet", ROUTES):
        rows = t.spark.read.parquet(path).agg(F.count(F.lit(1)).alias("row_count"))
        rows = rows.select(F.lit(scenario).alias("scenario"), F.lit(table).alias("table_name"), "row_count")
        counted = rows if counted is None else counted.unionByName(rows)
    return counted


@query(
    "build_manifest",
    f"""SELECT {spread_sql(FILES)} AS files, {spread_sql(FILES)} AS checksums, COUNT(*) AS row_count FROM orders""",
)
def build_manifest_query(t):
    files = build_manifest(t.spark, order_parts(t), "*.parquet")
    listed = files.agg(
        F.count_if(c("length") > 0).alias("files"), F.count_distinct("checksum").alias("checksums")
    )
    rows = t.spark.read.parquet(order_parts(t)).agg(F.count(F.lit(1)).alias("row_count"))
    return side_by_side(listed, rows)

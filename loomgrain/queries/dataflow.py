"""Pipelines: validation, loads, change data, lake tables, batches, layouts."""

from zlib import crc32

from pyspark.sql import functions as F

from loomgrain.contracts import AUDIT_SCHEMA, CHANGES, contract
from loomgrain.functions.values import money
from loomgrain.operators.quality import (
    duplicate_keys,
    reconcile,
    same_rows,
    schema_drift,
    split,
    validate_changes,
    validate_contract,
    validate_io_rows,
)
from loomgrain.operators.updates import latest_changes
from loomgrain.plans.batches import RepeatedBatch, committed, ingest_batch, log, states
from loomgrain.plans.changes import apply_latest
from loomgrain.plans.lake import build_bronze_silver, compact_folder, compact_version, load_batches, to_silver, union_by_name, with_lineage
from loomgrain.plans.layout import compare_layouts, timed_update
from loomgrain.plans.loads import load_many, stage
from loomgrain.plans.publish import current_version, names_of, publish, read_version, version_files
from loomgrain.queries.changes import order_changes, order_transactions
from loomgrain.queries.registry import own_name, query
from loomgrain.queries.shapes import (
    CONTRACTS,
    CUSTOMER,
    EVENTS,
    ORDERS,
    PART,
    SPOILT,
    dated_feed,
    event_days,
    event_sql,
    order_sql,
    order_summary,
    side_by_side,
    spoilt_csv,
    spread,
    spread_sql,
)
from loomgrain.queries.sinks import LOADED, REASONS, nightly_load
from loomgrain.session import fresh_path, materialise
from loomgrain.sinks.writers import write_table
from loomgrain.sources.files import build_manifest, list_files
from loomgrain.sources.footers import footers
from loomgrain.sources.gate import SchemaDrift, drift_of_parts, read_checked_parts, refuse_unlike_files
from loomgrain.sources.readers import read_by_contract, read_table
from loomgrain.sources.routing import pick_tables
from loomgrain.streaming.ingest import batch_sink, ingest_new_files, ingest_stream, ingested

c = F.col


def by_reason(df, name="lines"):
    return df.groupBy(c("_error_reason").alias("reason")).agg(F.count("*").alias(name))


TEXT_REASONS = """CASE WHEN o_orderkey % 10 IN (3, 4) THEN 'malformed_record'
    WHEN o_orderkey % 10 = 5 THEN 'invalid_or_missing_amount'
    WHEN o_orderkey % 10 = 6 THEN 'invalid_or_missing_product_id' END"""


def spoilt(t, typed):
    return read_by_contract(t.spark, "csv", spoilt_csv(t), SPOILT, typed=typed, header=False)


@query(
    "contract_validate",
    f"SELECT reason, COUNT(*) AS lines FROM (SELECT {TEXT_REASONS} AS reason FROM orders) r GROUP BY reason",
)
def contract_validate(t):
    return by_reason(validate_contract(spoilt(t, typed=False), SPOILT))


@query(
    "rule_validate",
    f"SELECT reason, COUNT(*) AS lines FROM (SELECT {REASONS} AS reason FROM orders) r GROUP BY reason",
)
def rule_validate(t):
    return by_reason(validate_io_rows(spoilt(t, typed=True)))


@query(
    "split_accept_reject",
    f"""SELECT CASE WHEN reason IS NULL THEN 'accepted' ELSE 'rejected' END AS outcome, COUNT(*) AS lines
        FROM (SELECT {TEXT_REASONS} AS reason FROM orders) r GROUP BY 1""",
)
def split_accept_reject(t):
    outcome = stage(validate_contract(spoilt(t, typed=False), SPOILT), SPOILT)
    accepted = outcome.accepted.agg(F.count("*").alias("lines")).withColumn("outcome", F.lit("accepted"))
    rejected = outcome.rejected.agg(F.count("*").alias("lines")).withColumn("outcome", F.lit("rejected"))
    return accepted.unionByName(rejected).select("outcome", "lines")


@query("load_audit", f"SELECT l.*, CAST(1 AS BIGINT) AS files_counted, CAST(1 AS BIGINT) AS in_time_order FROM ({LOADED}) l")
def load_audit(t):
    audit, _, _ = nightly_load(t)
    record = t.spark.read.schema(AUDIT_SCHEMA).parquet(audit)
    return record.select(
        "scenario",
        "target_table",
        "accepted_rows",
        "rejected_rows",
        (c("source_files") >= 1).cast("long").alias("files_counted"),
        (c("started_at") <= c("completed_at")).cast("long").alias("in_time_order"),
    )


@query(
    "reconcile",
    f"""SELECT l.target_table AS table_name, accepted_rows + rejected_rows AS expected_rows, accepted_rows, rejected_rows,
        accepted_rows AS target_rows, CAST(1 AS BIGINT) AS reconciled FROM ({LOADED}) l""",
)
def reconcile_query(t):
    audit, target, _ = nightly_load(t)
    counted = t["orders"].agg(F.count("*").alias("expected_rows")).withColumn("table_name", F.lit(SPOILT.name))
    expected = materialise(counted, "expected")
    stored = t.spark.read.parquet(f"{target}/{SPOILT.name}").count()
    observed = (
        t.spark.read.schema(AUDIT_SCHEMA)
        .parquet(audit)
        .select(c("target_table").alias("table_name"), "accepted_rows", "rejected_rows")
        .withColumn("target_rows", F.lit(stored).cast("long"))
    )
    return reconcile(expected, observed, ["table_name"]).withColumn("reconciled", c("reconciled").cast("long"))


@query(
    "multi_table_load",
    """SELECT 'customer' AS target_table, COUNT(*) AS accepted_rows, CAST(0 AS BIGINT) AS rejected_rows FROM customer
       UNION ALL SELECT 'part', COUNT(*), 0 FROM part UNION ALL SELECT 'orders', COUNT(*), 0 FROM orders""",
)
def multi_table_load(t):
    audit, target, rejects = (fresh_path(t.spark, x) for x in ("audit", "target", "rejects"))

    def to_parquet(accepted, table, writers):
        write_table(accepted, "parquet", f"{target}/{table.name}", mode="overwrite")

    paths = {name: t.copy(name, "json") for name in ("orders", "part", "customer")}
    order = ("customer", "part", "orders")
    load_many(t.spark, "json", paths, to_parquet, "daily", rejects, audit, CONTRACTS, order)
    record = t.spark.read.schema(AUDIT_SCHEMA).parquet(audit)
    return record.select("target_table", "accepted_rows", "rejected_rows")


CHANGE_REASONS = """SELECT reason, CAST(SUM(copies) AS BIGINT) AS changes FROM (SELECT CASE o_orderkey % 10
    WHEN 2 THEN 'invalid_operation' WHEN 3 THEN 'update_missing_values' WHEN 4 THEN 'invalid_transaction_id'
    WHEN 5 THEN 'invalid_change_ts' END AS reason,
    CASE WHEN o_orderkey % 10 <= 1 THEN 2 ELSE 1 END AS copies FROM orders WHERE o_orderkey % 10 <= 6) r GROUP BY reason"""


def checked_changes(t):
    return validate_changes(order_changes(t), CHANGES, F.lit("orders"))


@query("cdc_validate", CHANGE_REASONS)
def cdc_validate(t):
    return by_reason(checked_changes(t), "changes")


def staged_changes(checked):
    """The newest accepted change of each key, written once for the counts and the merge."""
    accepted, _ = split(checked)
    return materialise(latest_changes(accepted, ["transaction_id"]).select(*CHANGES.names), "staged-changes")


@query(
    "cdc_stage",
    """SELECT CASE WHEN o_orderkey % 10 = 6 THEN -1 - o_orderkey ELSE o_orderkey END AS transaction_id,
       CASE WHEN o_orderkey % 10 = 1 THEN 'D' ELSE 'U' END AS operation,
       CASE o_orderkey % 10 WHEN 0 THEN CAST(CAST(o_totalprice AS DECIMAL(16,2)) + 5 AS DOUBLE)
            WHEN 6 THEN o_totalprice END AS amount FROM orders WHERE o_orderkey % 10 IN (0, 1, 6)""",
)
def cdc_stage(t):
    return staged_changes(checked_changes(t)).select("transaction_id", "operation", c("amount").cast("double").alias("amount"))


def published_orders(t):
    """The orders as the first version of a dataset, published once per session and data folder."""
    return t.staged("transactions", lambda root: publish(order_transactions(t), root, 1))


@query(
    "cdc_merge",
    """SELECT o_orderkey AS transaction_id, o_custkey AS customer_id,
       CASE WHEN o_orderkey % 10 = 0 THEN CAST(CAST(o_totalprice AS DECIMAL(16,2)) + 5 AS DOUBLE) ELSE o_totalprice END AS amount,
       strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders WHERE o_orderkey % 10 <> 1""",
)
def cdc_merge(t):
    root = published_orders(t)
    found = apply_latest(staged_changes(checked_changes(t)), root, ["transaction_id"], ["amount", "transaction_ts"], onto=1)
    return read_version(t.spark, root, found["version"]).select(
        "transaction_id",
        "customer_id",
        c("amount").cast("double").alias("amount"),
        F.date_format("transaction_ts", "yyyy-MM-dd").alias("day"),
    )


@query(
    "cdc_by_file",
    """SELECT CAST(1 AS BIGINT) AS rewritten_files, CAST(7 AS BIGINT) AS carried_files, CAST(1 AS BIGINT) AS updated,
       CAST(0 AS BIGINT) AS deleted, CAST(1 AS BIGINT) AS unmatched, COUNT(*) AS row_count,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(16,2))) + 7 AS DOUBLE) AS amount FROM orders""",
)
def cdc_by_file(t):
    """One order changes: of eight files, cut along the key, one is written anew."""
    root = fresh_path(t.spark, "by-file")
    base = order_transactions(t)
    publish(base.repartitionByRange(8, "transaction_id"), root, 1)
    first = base.agg(F.min("transaction_id").alias("transaction_id"))
    one = base.join(F.broadcast(first), "transaction_id").select(
        F.lit("U").alias("operation"), "transaction_id", (c("amount") + 7).cast("decimal(16,2)").alias("amount"), "transaction_ts"
    )
    unknown = one.withColumn("transaction_id", -1 - c("transaction_id"))
    counts = apply_latest(materialise(one.unionByName(unknown), "one-change"), root, ["transaction_id"], ["amount", "transaction_ts"])
    found = [F.lit(counts[name]).cast("long").alias(name) for name in ("rewritten_files", "carried_files", "updated", "deleted", "unmatched")]
    return read_version(t.spark, root).agg(*found, F.count("*").alias("row_count"), F.sum("amount").cast("double").alias("amount"))


@query(
    "cdc_metrics",
    """SELECT CAST(SUM(CASE d WHEN 0 THEN 2 WHEN 1 THEN 2 WHEN 6 THEN 1 ELSE 0 END) AS BIGINT) AS accepted,
       COUNT(CASE WHEN d IN (2, 3, 4, 5) THEN 1 END) AS rejected, COUNT(CASE WHEN d IN (0, 1, 6) THEN 1 END) AS staged,
       COUNT(CASE WHEN d = 0 THEN 1 END) AS updated, COUNT(CASE WHEN d = 1 THEN 1 END) AS deleted,
       COUNT(CASE WHEN d = 6 THEN 1 END) AS unmatched FROM (SELECT o_orderkey % 10 AS d FROM orders) o""",
)
def cdc_metrics(t):
    # checked once: the counts and the newest changes both read what was written
    checked = materialise(checked_changes(t), "checked-changes")
    totals = checked.agg(
        F.count_if(c("_error_reason").isNull()).alias("accepted"),
        F.count_if(c("_error_reason").isNotNull()).alias("rejected"),
    )
    # the run that applies the changes counts them: no pass of its own over the base
    counts = apply_latest(staged_changes(checked), published_orders(t), ["transaction_id"], ["amount", "transaction_ts"], onto=1)
    names = ("staged", "updated", "deleted", "unmatched")
    return totals.select("*", *[F.lit(counts[name]).cast("long").alias(name) for name in names])


def lake_sources(t):
    """Customers delivered twice as CSV (with loose spaces), parts once."""

    def write(path):
        loose = t["customer"].withColumn("c_mktsegment", F.concat(F.lit("  "), "c_mktsegment", F.lit(" ")))
        twice = loose.unionByName(loose)
        write_table(twice, "csv", f"{path}/01/customer", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        write_table(t["customer"].drop("c_acctbal"), "csv", f"{path}/02/customer")
        write_table(t["part"], "csv", f"{path}/02/part")

    root = t.staged("lake-sources", write)
    return [(number, table, f"{root}/{number}/{table}") for number, table in (("01", "customer"), ("02", "customer"), ("02", "part"))]


def lake(t):
    """Bronze and silver tables, built once per session and data folder."""
    number = crc32(t.folder.encode())
    bronze, silver = own_name(t.spark, f"bronze_{number}"), own_name(t.spark, f"silver_{number}")

    def write(path):
        build_bronze_silver(
            t.spark, lake_sources(t), "csv", bronze, silver, locations={bronze: f"{path}/bronze", silver: f"{path}/silver"}
        )

    t.staged("lake", write)
    return {x: (t.spark.table(f"{bronze}.{x}"), t.spark.table(f"{silver}.{x}")) for x in ("customer", "part")}


@query(
    "bronze_ingest",
    """SELECT s AS source_scenario, 'customer' AS source_table, 'csv' AS source_format, n AS row_count, b AS with_balance
       FROM (SELECT '01' AS s, 2 * COUNT(*) AS n, 2 * COUNT(c_acctbal) AS b FROM customer
             UNION ALL SELECT '02', COUNT(*), 0 FROM customer) x
       UNION ALL SELECT '02', 'part', 'csv', COUNT(*), 0 FROM part""",
)
def bronze_ingest(t):
    bronze = {name: tables[0] for name, tables in lake(t).items()}
    everything = bronze["customer"].unionByName(bronze["part"], allowMissingColumns=True)
    return everything.groupBy("source_scenario", "source_table", "source_format").agg(
        F.count("*").alias("row_count"), F.count("c_acctbal").alias("with_balance")
    )


@query(
    "silver_clean",
    """SELECT s AS source_scenario, c_custkey, c_mktsegment, CASE WHEN s = '01' THEN c_acctbal END AS c_acctbal
       FROM customer, (VALUES ('01'), ('02')) v(s)""",
)
def silver_clean(t):
    _, silver = lake(t)["customer"]
    return silver.select("source_scenario", c("c_custkey").cast("long").alias("c_custkey"), "c_mktsegment", "c_acctbal")


def batches(t, load_type, batch_date=None, target=None, **more):
    target = target or fresh_path(t.spark, f"batches-{load_type}")
    load_batches(
        t.spark, dated_feed(t), target, ["events"], load_type, batch_date, schemas={"events": EVENTS.schema}, **more
    )
    return target


def loaded(t, target):
    return t.spark.read.parquet(f"{target}/events")


@query("bulk_load", event_sql())
def bulk_load(t):
    return event_days(loaded(t, batches(t, "bulk")))


@query("incremental_load", event_sql("WHERE CAST(ts AS DATE) IN (DATE '2024-01-03', DATE '2024-01-04')"))
def incremental_load(t):
    target = batches(t, "incremental", "2024-01-03")
    return event_days(loaded(t, batches(t, "incremental", "2024-01-04", target)))


@query("reprocess_load", event_sql())
def reprocess_load(t):
    target = batches(t, "bulk")
    # the date is loaded again: its rows are replaced and all other dates stay
    return event_days(loaded(t, batches(t, "reprocess", "2024-01-03", target)))


@query(
    "compact_load",
    """SELECT COUNT(*) AS events, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total,
       '2024-01-03' AS batch_date FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-03'""",
)
def compact_load(t):
    target = batches(t, "compact", "2024-01-03")
    return event_days(t.spark.read.parquet(f"{target}_compacted/events"))


@query(
    "compact_files",
    f"""SELECT {spread_sql(40)} AS files_before, COUNT(*) AS row_count, CAST(1 AS BIGINT) AS fewer_files,
        CAST(1 AS BIGINT) AS same_rows FROM customer""",
)
def compact_files(t):
    small = t.staged("customer-small-files", lambda path: spread(t["customer"], 40).write.parquet(path))
    target = fresh_path(t.spark, "customer-compacted")
    # large files are wanted: the number comes from the folder's bytes
    wanted = compact_folder(t.spark, "parquet", small, target)
    before = list_files(t.spark, small, "*.parquet").count()
    compacted = t.spark.read.parquet(target)
    after = list_files(t.spark, target, "*.parquet").count()
    equal = same_rows(t.spark.read.parquet(small), compacted)
    return compacted.agg(
        F.lit(before).cast("long").alias("files_before"),
        F.count("*").alias("row_count"),
        F.lit(int(after == wanted < before)).cast("long").alias("fewer_files"),
        F.lit(int(equal)).cast("long").alias("same_rows"),
    )


@query(
    "compact_by_bins",
    """SELECT CAST(2 AS BIGINT) AS kept, CAST(10 AS BIGINT) AS merged, CAST(1 AS BIGINT) AS fewer_files,
       CAST(2 AS BIGINT) AS untouched, COUNT(*) AS row_count, CAST(SUM(o_orderkey) AS BIGINT) AS keys FROM orders""",
)
def compact_by_bins(t):
    """Two large files and ten small ones: the small are merged, the large are carried over."""
    root = fresh_path(t.spark, "bins")
    digit = c("o_orderkey") % 100
    part = F.when(digit < 45, 0).when(digit < 90, 1).otherwise(digit - 88).cast("int")
    publish(t["orders"].repartitionById(12, part), root, 1)
    before = {r["path"]: r["length"] for r in list_files(t.spark, f"{root}/version_1", "*.parquet").collect()}
    found = compact_version(t.spark, root, max(before.values()))
    after = set(names_of(version_files(t.spark, root)))
    untouched = sum(name in after for name in names_of(version_files(t.spark, root, 1)))
    facts = {"kept": found["kept"], "merged": found["merged"], "fewer_files": int(found["written"] < 10), "untouched": untouched}
    return read_version(t.spark, root).agg(
        *[F.lit(value).cast("long").alias(name) for name, value in facts.items()],
        F.count("*").alias("row_count"),
        F.sum("o_orderkey").alias("keys"),
    )


@query(
    "selected_tables",
    """SELECT 'customer' AS table_name, COUNT(*) AS row_count FROM customer UNION ALL SELECT 'supplier', COUNT(*) FROM supplier""",
)
def selected_tables(t):
    counted = None
    for name in pick_tables(["region", "nation", "customer", "supplier", "part"], ["customer", "supplier"]):
        rows = t[name].agg(F.count("*").alias("row_count")).withColumn("table_name", F.lit(name))
        counted = rows if counted is None else counted.unionByName(rows)
    return counted.select("table_name", "row_count")


@query(
    "batch_checks",
    """SELECT 'rows per date' AS check_name, strftime(ts, '%Y-%m-%d') AS subject, COUNT(*) AS row_count FROM events GROUP BY 2
       UNION ALL SELECT 'failed per date', strftime(ts, '%Y-%m-%d'), COUNT(*) FROM events WHERE event_type = 'error' GROUP BY 2
       UNION ALL SELECT 'per channel', event_type, COUNT(*) FROM events GROUP BY event_type
       UNION ALL SELECT 'purchases per date', strftime(ts, '%Y-%m-%d'), COUNT(*) FROM events WHERE event_type = 'purchase' GROUP BY 2
       UNION ALL SELECT 'segment list', c_mktsegment, COUNT(*) FROM customer GROUP BY c_mktsegment
       UNION ALL SELECT 'customers reminded', 'all', COUNT(*) FROM customer
             WHERE c_custkey IN (SELECT user_id FROM events WHERE event_type = 'error')""",
)
def batch_checks(t):
    events = read_table(t.spark, "csv", f"{dated_feed(t)}/events", schema=EVENTS.schema)
    day = c("batch_date").cast("string")

    def check(name, frame, subject):
        return frame.groupBy(subject.alias("subject")).agg(F.count("*").alias("row_count")).withColumn("check_name", F.lit(name))

    failed = events.where("event_type = 'error'")
    reminded = t["customer"].join(failed.select(c("user_id").alias("c_custkey")).distinct(), "c_custkey", "left_semi")
    parts = [
        check("rows per date", events, day),
        check("failed per date", failed, day),
        check("per channel", events, c("event_type")),
        check("purchases per date", events.where("event_type = 'purchase'"), day),
        check("segment list", t["customer"], c("c_mktsegment")),
        reminded.agg(F.count("*").alias("row_count")).withColumns(
            {"subject": F.lit("all"), "check_name": F.lit("customers reminded")}
        ),
    ]
    return union_by_name(parts).select("check_name", "subject", "row_count")


@query(
    "layout_compare",
    """SELECT f.fmt AS "format", l.layout, COUNT(*) AS joined FROM customer JOIN nation ON c_nationkey = n_nationkey,
       (SELECT unnest(['csv', 'json', 'parquet']) AS fmt) f, (SELECT unnest(['tiny', 'large']) AS layout) l GROUP BY 1, 2""",
)
def layout_compare(t):
    nation = t["nation"].select(c("n_nationkey").alias("c_nationkey"), "n_name")
    results = []
    for fmt in ("csv", "json", "parquet"):
        tiny = t.staged(f"customer-tiny-{fmt}", lambda path, f=fmt: write_table(spread(t["customer"], 40), f, path))
        layouts = {"tiny": tiny, "large": t.copy("customer", fmt)}
        for run in compare_layouts(t.spark, fmt, layouts, nation, ["c_nationkey"], CUSTOMER.schema):
            results.append((fmt, run.label, run.value))
    # one row per format and layout
    return t.spark.createDataFrame(results, "format string, layout string, joined bigint")


@query(
    "update_bench",
    """SELECT u AS update_size, COUNT(*) AS row_count, COUNT(CASE WHEN (u = 'small' AND o_orderkey % 100 = 0)
       OR (u = 'large' AND o_orderkey % 2 = 0) THEN 1 END) AS changed FROM orders, (VALUES ('small'), ('large')) v(u) GROUP BY u""",
)
def update_bench(t):
    frames = []
    for label, step in (("small", 100), ("large", 2)):
        updates = t["orders"].where(c("o_orderkey") % step == 0).select("o_orderkey", F.lit("9-CHANGED").alias("new_priority"))
        run = timed_update(label, t["orders"], updates, ["o_orderkey"], {"o_orderpriority": "new_priority"})
        version = t.spark.read.parquet(run.value)
        frames.append(
            version.agg(
                F.lit(label).alias("update_size"),
                F.count("*").alias("row_count"),
                F.count_if(c("o_orderpriority") == "9-CHANGED").alias("changed"),
            )
        )
    return union_by_name(frames)


@query("ingest_pattern", f"SELECT accepted_rows, rejected_rows, CAST(1 AS BIGINT) AS promoted FROM ({LOADED}) l")
def ingest_pattern(t):
    """Manifest, read, split, quarantine, compact, reconcile, and promote only at the end."""
    landing = spoilt_csv(t)
    manifest = build_manifest(t.spark, landing, "*.txt").where(c("length") > 0)
    work = fresh_path(t.spark, "ingest")
    outcome = stage(validate_contract(spoilt(t, typed=False), SPOILT), SPOILT)
    if outcome.rejected_rows:
        outcome.rejected.write.mode("append").parquet(f"{work}/quarantine")
    discovered = t.spark.read.text(landing).count()

    def complete(candidate):
        return (
            manifest.count() == outcome.source_files
            and discovered == outcome.accepted_rows + outcome.rejected_rows
            and candidate.count() == outcome.accepted_rows
        )

    # the accepted rows leave the staging area as few, large files
    publish(spread(outcome.accepted, 1), f"{work}/orders", 1, complete)
    return read_version(t.spark, f"{work}/orders").agg(
        F.count("*").alias("accepted_rows"),
        F.lit(outcome.rejected_rows).cast("long").alias("rejected_rows"),
        F.lit(current_version(t.spark, f"{work}/orders")).cast("long").alias("promoted"),
    )


@query(
    "batch_restart",
    f"""SELECT l.accepted_rows, l.rejected_rows, CAST(1 AS BIGINT) AS refused, CAST(1 AS BIGINT) AS audit_lines,
        CAST(1 AS BIGINT) AS reported FROM ({LOADED}) l""",
)
def batch_restart(t):
    """A batch once, again (refused) and replayed: the rows, rejects and metrics of one run are left."""
    root = fresh_path(t.spark, "batches")

    def ingest(replay=False):
        ingest_batch(t.spark, "csv", spoilt_csv(t), SPOILT, root, "2026-01-03", replay, header=False)

    ingest()
    try:
        ingest()
        refused = 0
    except RepeatedBatch:
        refused = 1
    ingest(replay=True)
    metrics = committed(t.spark, root, "metrics")
    lines = metrics.agg(
        F.count("*").alias("audit_lines"),
        (F.count_if((c("source_files") >= c("read_files")) & (c("source_bytes") > 0) & (c("written_files") > 0))).alias("reported"),
    )
    counts = [
        committed(t.spark, root, kind).agg(F.count("*").alias(name))
        for kind, name in (("rows", "accepted_rows"), ("rejects", "rejected_rows"))
    ]
    both = side_by_side(counts[0], counts[1])
    return side_by_side(both, lines).withColumn("refused", F.lit(refused).cast("long"))


@query(
    "failed_replay",
    f"""SELECT l.accepted_rows, l.rejected_rows, CAST(3 AS BIGINT) AS attempts, CAST(1 AS BIGINT) AS failed,
        CAST(1 AS BIGINT) AS in_state_failed, l.accepted_rows + 1 AS after_repair FROM ({LOADED}) l""",
)
def failed_replay(t):
    """A replay that fails leaves the committed rows; the next one takes their place."""
    root = fresh_path(t.spark, "attempts")
    source = f"{root}/source"

    def ingest(fmt="csv", replay=True):
        ingest_batch(t.spark, fmt, source, SPOILT, f"{root}/lake", "2026-01-03", replay, **({"header": False} if fmt == "csv" else {}))

    t.spark.read.text(spoilt_csv(t)).write.text(source)
    ingest(replay=False)
    try:
        # the landed text is no Parquet
        ingest("parquet")
        failed = 0
    except Exception:
        failed = 1
    kept = [
        materialise(committed(t.spark, f"{root}/lake", kind).agg(F.count("*").alias(name)), "kept")
        for kind, name in (("rows", "accepted_rows"), ("rejects", "rejected_rows"))
    ]
    state = states(t.spark, f"{root}/lake").agg(F.count_if(c("state") == "failed").alias("in_state_failed"))
    state = materialise(state, "state")
    # an order that is accepted arrives once more
    t.spark.read.text(source).where(c("value").rlike("^[0-9]*0,")).orderBy("value").limit(1).write.mode("append").text(source)
    ingest()
    after = committed(t.spark, f"{root}/lake").agg(F.count("*").alias("after_repair"))
    attempts = log(t.spark, f"{root}/lake").agg(F.count_distinct("attempt").alias("attempts"))
    both = side_by_side(side_by_side(kept[0], kept[1]), side_by_side(state, after))
    return side_by_side(both, attempts).withColumn("failed", F.lit(failed).cast("long"))


@query("incremental_prefix", order_sql())
def incremental_prefix(t):
    root = fresh_path(t.spark, "arriving")
    source, target, checkpoint = f"{root}/source", f"{root}/target", f"{root}/checkpoint"
    for rest in (0, 1, 2):
        t["orders"].where(c("o_orderkey") % 3 == rest).write.mode("append").parquet(source)
        ingest_new_files(t.spark, "parquet", source, ORDERS, target, checkpoint)
    # nothing new has arrived: this run adds no rows
    ingest_new_files(t.spark, "parquet", source, ORDERS, target, checkpoint)
    return order_summary(ingested(t.spark, ORDERS, target))


@query(
    "stream_batches",
    """SELECT CAST(2 AS BIGINT) AS batches, CAST(0 AS BIGINT) AS repeated_rows, o.* FROM (SELECT COUNT(*) AS row_count,
       CAST(SUM(o_orderkey) AS BIGINT) AS keys, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS amount FROM orders) o""",
)
def stream_batches(t):
    """Files arrive twice; each arrival is a batch, and a batch number that comes again adds nothing."""
    root = fresh_path(t.spark, "stream-batches")
    source, lake = f"{root}/source", f"{root}/lake"
    for rest in (0, 1):
        t["orders"].where(c("o_orderkey") % 2 == rest).write.mode("append").parquet(source)
        ingest_stream(t.spark, "parquet", source, ORDERS, lake, f"{root}/checkpoint")
    # nothing new has arrived, and the first batch is handed over once more
    ingest_stream(t.spark, "parquet", source, ORDERS, lake, f"{root}/checkpoint")
    before = committed(t.spark, lake).count()
    again = read_by_contract(t.spark, "parquet", source, ORDERS)
    batch_sink(lake, ORDERS, "stream")(validate_contract(again, ORDERS), 0)
    rows = committed(t.spark, lake)
    return rows.agg(
        F.count_distinct("batch_id").alias("batches"),
        F.lit(rows.count() - before).cast("long").alias("repeated_rows"),
        F.count("*").alias("row_count"),
        F.sum("o_orderkey").alias("keys"),
        F.sum(money("o_totalprice")).cast("double").alias("amount"),
    )


@query(
    "format_equivalence",
    """SELECT f.fmt AS "format", COUNT(*) AS parts, CAST(1 AS BIGINT) AS same_as_parquet FROM part,
       (SELECT unnest(['csv', 'json']) AS fmt) f GROUP BY 1""",
)
def format_equivalence(t):
    def by_contract(fmt):
        rows = read_by_contract(t.spark, fmt, t.copy("part", fmt), PART)
        return split(validate_contract(rows, PART))[0].select(*PART.names)

    truth = by_contract("parquet")
    frames = []
    for fmt in ("csv", "json"):
        rows = by_contract(fmt)
        equal = int(same_rows(truth, rows))
        frames.append(
            rows.agg(F.lit(fmt).alias("format"), F.count("*").alias("parts"), F.lit(equal).cast("long").alias("same_as_parquet"))
        )
    return union_by_name(frames)


DRIFTED = contract(
    "part",
    {
        "p_partkey": "bigint",
        "p_name": "string",
        "p_size": "bigint",
        "p_retailprice": "double",
        "p_colour": "string",
    },
    "p_partkey",
)


@query(
    "schema_drift_check",
    """SELECT d.*, (SELECT COUNT(*) FROM part) AS affected_rows FROM (VALUES
       ('p_brand', 'added', NULL, 'string'), ('p_colour', 'missing', 'string', NULL),
       ('p_size', 'changed', 'bigint', 'int'), ('p_type', 'added', NULL, 'string'))
       d("column", kind, expected, actual)""",
)
def schema_drift_check(t):
    part = t["part"]
    drift = schema_drift(part.schema, DRIFTED)
    lines = t.spark.createDataFrame(drift, "column string, kind string, expected string, actual string")
    return lines.withColumn("affected_rows", F.lit(part.count()).cast("long"))


@query(
    "schema_gate",
    """SELECT d.*, (SELECT COUNT(*) FROM part) AS row_count, CAST(1 AS BIGINT) AS refused FROM (VALUES
       ('02', 'p_colour', 'added', NULL, 'string'), ('02', 'p_size', 'changed', 'int', 'string'),
       ('02', 'p_type', 'missing', 'string', NULL)) d(part_no, "column", kind, expected, actual)""",
)
def schema_gate(t):
    def write(root):
        t["part"].write.parquet(f"{root}/01")
        changed = t["part"].withColumns({"p_size": c("p_size").cast("string"), "p_colour": F.lit("red")}).drop("p_type")
        changed.write.parquet(f"{root}/02")

    root = t.staged("unlike-parts", write)
    fitting = contract("part", dict(t["part"].dtypes), "p_partkey")
    paths = [f"{root}/01", f"{root}/02"]
    try:
        refused = 0 * read_checked_parts(t.spark, "parquet", paths, fitting).count()
    except SchemaDrift:
        refused = 1
    drift = [(path[-2:], *line) for path, *line in drift_of_parts(t.spark, "parquet", paths, fitting)]
    lines = t.spark.createDataFrame(drift, "part_no string, column string, kind string, expected string, actual string")
    whole = read_checked_parts(t.spark, "parquet", paths[:1], fitting)
    return lines.withColumns({"row_count": F.lit(whole.count()).cast("long"), "refused": F.lit(refused).cast("long")})


@query(
    "footer_check",
    f"""SELECT (SELECT {spread_sql(3)} FROM orders WHERE o_orderkey % 2 = 0)
        + (SELECT {spread_sql(3)} FROM orders WHERE o_orderkey % 2 = 1) + 2 AS files, CAST(1 AS BIGINT) AS corrupt,
        CAST(1 AS BIGINT) AS empty_files, CAST(2 AS BIGINT) AS schemas, CAST(COUNT(*) AS BIGINT) AS named_rows,
        CAST(1 AS BIGINT) AS refused, 'o_custkey' AS drifted FROM orders""",
)
def footer_check(t):
    """Many parts with two schemas, an empty file and a corrupt one, told apart by their footers alone."""

    def write(root):
        spread(t["orders"].where("o_orderkey % 2 = 0"), 3).write.parquet(f"{root}/01")
        spread(t["orders"].where("o_orderkey % 2 = 1").withColumn("o_custkey", c("o_custkey").cast("string")), 3).write.parquet(f"{root}/02")
        t["orders"].limit(0).coalesce(1).write.parquet(f"{root}/03")
        t["orders"].limit(1).coalesce(1).select(F.to_json(F.struct("*")).alias("value")).write.text(f"{root}/04")

    root = t.staged("footers", write)
    parts = [f"{root}/0{n}" for n in (1, 2, 3, 4)]
    found = materialise(footers(t.spark, parts, "part-*"), "footers")
    try:
        refuse_unlike_files(t.spark, "parquet", parts[:2])
        refused = 0
    except SchemaDrift:
        refused = 1
    drift = drift_of_parts(t.spark, "parquet", parts[:3], contract("orders", dict(t["orders"].dtypes), "o_orderkey"))
    return found.agg(
        F.count("*").alias("files"),
        F.count_if(~c("readable")).alias("corrupt"),
        F.count_if(c("rows") == 0).alias("empty_files"),
        F.count_distinct("columns").alias("schemas"),
        F.sum("rows").alias("named_rows"),
        F.lit(refused).cast("long").alias("refused"),
        F.lit(",".join(sorted({line[1] for line in drift}))).alias("drifted"),
    )


@query(
    "duplicate_key_check",
    """SELECT l_orderkey, l_linenumber, COUNT(*) AS copies FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1""",
)
def duplicate_key_check(t):
    return duplicate_keys(t["lineitem"], ["l_orderkey", "l_linenumber"])


@query("silver_by_key", "SELECT c_custkey, c_mktsegment, '01' AS source_scenario FROM customer")
def silver_by_key(t):
    first = with_lineage(t["customer"], "01", "customer", "parquet").drop("bronze_load_ts")
    second = with_lineage(t["customer"], "02", "customer", "parquet").drop("bronze_load_ts")
    return to_silver(first.unionByName(second), key=["c_custkey"]).select("c_custkey", "c_mktsegment", "source_scenario")

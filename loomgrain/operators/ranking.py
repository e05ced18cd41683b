"""Ranking and offset windows whose groups may be larger than one task.

A plain window puts each partition group into one task, and a window without
a partition puts everything into one. Here every row gets the number of its
part in the total order, so a large group spreads over many parts; rows move
once, to their part, the window runs inside (part, group) on what has arrived,
and its result is written once. A summary with a few rows per part carries the
positions across part borders.

The borders come from a bounded sample of the sort keys and are written before
anything uses them; a row finds its part by a binary search in built-in
expressions. ``order`` with its tie break should be total, as equal sort keys
can neither be split over parts nor keep their order when a task runs again.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomgrain.operators.skew import BROADCAST_BYTES, HOT_ROWS, SAMPLE_SEED, key_counts, skew_join
from loomgrain.session import materialise

PART_ROWS = 2_000_000
GROUP_SHARES = 64
BORDER_SAMPLE = 100  # sampled keys per part
MOST_SAMPLED = 2_000_000  # keys sampled for any number of parts

Order = tuple[str, str]


def sort_columns(order: list[Order]) -> list[Column]:
    """``[("price", "desc"), ("id", "asc")]`` as sort expressions, NULLs first when ascending."""
    for name, direction in order:
        if direction not in {"asc", "desc"}:
            raise ValueError(f"unknown sort direction for {name}: {direction}")
    return [F.asc_nulls_first(n) if d == "asc" else F.desc_nulls_last(n) for n, d in order]


def largest_group(df: DataFrame, partition_by: list[str], limit: int) -> int:
    """Rows of the largest group, counted closely enough to compare it with ``limit``."""
    return key_counts(df, partition_by, limit).agg(F.max("_rows").alias("largest")).first()["largest"] or 0


def parts_for(df: DataFrame) -> int:
    return max(df.sparkSession.sparkContext.defaultParallelism, ceil(df.count() / PART_ROWS))


def lay_out(df: DataFrame, order: list[Order], parts: int) -> DataFrame:
    """Rows in total order with ``_part`` and ``_pos``, to be written before it is used twice."""
    return (
        df.repartitionByRange(parts, *sort_columns(order))
        .sortWithinPartitions(*sort_columns(order))
        # upper bits: partition number, lower 33 bits: position inside it
        .withColumn("_pos", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_pos", 33).cast("int"))
    )


def comes_before(first: Column, second: Column, order: list[Order]) -> Column:
    """Whether the sort key ``first`` lies before ``second``; both are structs of the order's columns."""
    before, same = F.lit(False), F.lit(True)
    for name, direction in order:
        x, y = first[name], second[name]
        if direction == "asc":
            here = F.coalesce(x < y, x.isNull() & y.isNotNull())
        else:
            here = F.coalesce(x > y, x.isNotNull() & y.isNull())
        before, same = before | (same & here), same & x.eqNullSafe(y)
    return before


def borders(df: DataFrame, order: list[Order], parts: int, rows: int) -> DataFrame:
    """One row: ``keys``, up to ``parts`` - 1 sort keys in order that cut the rows into parts of like size."""
    wanted = min(BORDER_SAMPLE * parts, MOST_SAMPLED)
    key = F.struct(*[F.col(name) for name, _ in order])
    keys = df.select(*[name for name, _ in order])
    if rows > wanted:
        keys = keys.sample(wanted / rows, seed=SAMPLE_SEED)
    # the sample is bounded, so one task may order it
    place = F.row_number().over(Window.orderBy(*sort_columns(order)))
    placed = keys.withColumn("_place", place).withColumn("_sampled", F.count(F.lit(1)).over(Window.partitionBy()))
    step = F.greatest(F.lit(1.0), F.col("_sampled") / parts)
    cuts = placed.where(F.floor(F.col("_place") / step) > F.floor((F.col("_place") - 1) / step)).where(F.col("_place") < F.col("_sampled"))
    numbered = F.array_sort(F.collect_list(F.struct("_place", key.alias("key"))))
    return materialise(cuts.agg(F.transform(numbered, lambda x: x["key"]).alias("keys")), "borders")


def in_parts(df: DataFrame, order: list[Order], parts: int | None) -> DataFrame:
    """``df`` with ``_part``, moved once so that each part is in one task and parts follow the order."""
    rows = df.count()
    parts = parts or max(df.sparkSession.sparkContext.defaultParallelism, ceil(rows / PART_ROWS))
    found = borders(df, order, parts, rows)
    keys, many = found.select("keys").scalar(), found.select(F.size("keys")).scalar()
    own = F.struct(*[F.col(name) for name, _ in order])
    # how many borders lie before the row, one binary digit after the other
    numbered = df.withColumn("_part", F.lit(0))
    digit = 1 << max(0, parts - 1).bit_length()
    while digit:
        tried = F.col("_part") + digit
        passed = (tried <= many) & comes_before(F.get(keys, tried - 1), own, order)
        numbered = numbered.withColumn("_part", F.when(passed, tried).otherwise(F.col("_part")))
        digit >>= 1
    return numbered.repartitionById(parts, "_part")


def with_ranks(
    df: DataFrame,
    partition_by: list[str],
    order: list[Order],
    tie_break: list[Order],
    group_rows: int = HOT_ROWS,
    parts: int | None = None,
) -> DataFrame:
    """Add ``row_number``, ``rank`` and ``dense_rank``.

    rank and dense_rank treat rows equal in ``order`` as peers; row_number goes
    on to ``tie_break``. Groups that fit a task use a plain window.
    """
    if partition_by and largest_group(df, partition_by, group_rows) <= group_rows:
        peers = Window.partitionBy(*partition_by).orderBy(*sort_columns(order))
        total = Window.partitionBy(*partition_by).orderBy(*sort_columns([*order, *tie_break]))
        return df.select(
            "*",
            F.row_number().over(total).cast("long").alias("row_number"),
            F.rank().over(peers).cast("long").alias("rank"),
            F.dense_rank().over(peers).cast("long").alias("dense_rank"),
        )
    return _ranks_across_parts(df, partition_by, order, tie_break, parts)


def _ranks_across_parts(df, partition_by, order, tie_break, parts) -> DataFrame:
    group = [(name, "asc") for name in partition_by]
    along_part = sort_columns([*group, *order, *tie_break])
    laid = in_parts(df, [*group, *order, *tie_break], parts).withColumn(
        "_pos", F.row_number().over(Window.partitionBy("_part").orderBy(*along_part)).cast("long")
    )
    # sorted as the whole part is: no second sort
    in_part = Window.partitionBy("_part", *partition_by).orderBy(*sort_columns([*order, *tie_break]))
    key = F.struct(*[F.col(name) for name, _ in order])
    local = materialise(
        laid.withColumn("_key", key)
        .withColumn("_rn", F.row_number().over(in_part).cast("long"))
        .withColumn("_starts", (F.col("_rn") == 1) | ~F.col("_key").eqNullSafe(F.lag("_key").over(in_part)))
        .withColumn("_dense", F.sum(F.col("_starts").cast("long")).over(in_part))
        .withColumn("_rank", F.max(F.when(F.col("_starts"), F.col("_rn"))).over(in_part))
        .drop("_starts"),
        "ranked-parts",
    )

    pieces = local.groupBy("_part", *partition_by).agg(
        F.max("_rn").alias("_rows"),
        F.max("_dense").alias("_keys"),
        F.max("_rank").alias("_last_rank"),
        F.min_by("_key", "_pos").alias("_first_key"),
        F.max_by("_key", "_pos").alias("_last_key"),
        F.min("_pos").alias("_from"),
        F.max("_pos").alias("_to"),
    )
    # only the first and the last group of a part can cross a border: of any number of small groups two per part are left
    ends = local.groupBy("_part").agg(F.min("_pos").alias("_part_from"), F.max("_pos").alias("_part_to"))
    pieces = pieces.join(F.broadcast(ends), "_part").where("_from = _part_from OR _to = _part_to")
    along = Window.partitionBy(*partition_by).orderBy("_part")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    so_far = along.rowsBetween(Window.unboundedPreceding, 0)
    carried = (
        pieces.withColumn("_pieces", F.count(F.lit(1)).over(Window.partitionBy(*partition_by)))
        .where(F.col("_pieces") > 1)
        .withColumn("_rows_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
        .withColumn(
            "_continues",
            (F.row_number().over(along) > 1) & F.col("_first_key").eqNullSafe(F.lag("_last_key").over(along)),
        )
        .withColumn(
            "_keys_before",
            F.coalesce(F.sum("_keys").over(before), F.lit(0)) - F.sum(F.col("_continues").cast("long")).over(so_far),
        )
        .withColumn(
            "_run_rank",
            F.last(
                F.when((F.col("_keys") > 1) | ~F.col("_continues"), F.col("_rows_before") + F.col("_last_rank")),
                ignorenulls=True,
            ).over(so_far),
        )
        .withColumn(
            "_first_rank",
            F.when(F.col("_continues"), F.lag("_run_rank").over(along)).otherwise(F.col("_rows_before") + 1),
        )
        .select(
            F.col("_part").alias("_c_part"),
            *[F.col(name).alias(f"_c_{name}") for name in partition_by],
            "_rows_before",
            "_keys_before",
            "_first_rank",
        )
    )
    same_piece = F.col("_part") == F.col("_c_part")
    for name in partition_by:
        same_piece = same_piece & F.col(name).eqNullSafe(F.col(f"_c_{name}"))
    rows_before = F.coalesce("_rows_before", F.lit(0))
    return local.join(F.broadcast(carried), same_piece, "left").select(
        *df.columns,
        (F.col("_rn") + rows_before).alias("row_number"),
        F.when(F.col("_dense") == 1, F.coalesce("_first_rank", "_rank"))
        .otherwise(F.col("_rank") + rows_before)
        .alias("rank"),
        (F.col("_dense") + F.coalesce("_keys_before", F.lit(0))).alias("dense_rank"),
    )


def with_global_position(df: DataFrame, order: list[Order], parts: int | None = None) -> DataFrame:
    """Add ``position`` (1-based place in the total order) and ``total_rows``."""
    laid = materialise(lay_out(df, order, parts or parts_for(df)), "layout")
    sizes = laid.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    # one row per part, so these windows stay small
    by_part = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        F.col("_part"),
        F.coalesce(F.sum("_rows").over(by_part), F.lit(0)).alias("_start"),
        F.sum("_rows").over(Window.partitionBy()).alias("total_rows"),
    )
    in_part = F.col("_pos").bitwiseAND(F.lit((1 << 33) - 1))
    return laid.join(F.broadcast(starts), "_part").select(
        *df.columns, (F.col("_start") + in_part + 1).alias("position"), "total_rows"
    )


def with_ntile(df: DataFrame, order: list[Order], buckets: int, parts: int | None = None) -> DataFrame:
    """Add ``ntile`` over the whole table: the first ``rows % buckets`` buckets hold one row more."""
    if buckets < 1:
        raise ValueError("buckets must be at least 1")
    placed = (
        with_global_position(df, order, parts)
        .withColumn("_small", F.expr(f"total_rows DIV {buckets}"))
        .withColumn("_extra", F.expr(f"total_rows % {buckets}"))
        # rows held by the larger buckets at the front
        .withColumn("_front", F.expr("_extra * (_small + 1)"))
    )
    bucket = F.expr(
        "CASE WHEN position <= _front THEN (position - 1) DIV (_small + 1) "
        "ELSE _extra + (position - 1 - _front) DIV greatest(_small, 1) END + 1"
    )
    return placed.select(*df.columns, bucket.alias("ntile"))


def with_neighbours(
    df: DataFrame,
    order: list[Order],
    column: str,
    lag_name: str = "previous",
    lead_name: str = "next",
    parts: int | None = None,
) -> DataFrame:
    """Add the value of ``column`` one row before and one row after in the total order."""
    in_part = Window.partitionBy("_part").orderBy(*sort_columns(order))
    boxed = F.struct(F.col(column).alias("v"))
    local = materialise(
        in_parts(df, order, parts)
        .withColumn("_pos", F.row_number().over(in_part))
        .withColumn("_lag", F.lag(boxed).over(in_part))
        .withColumn("_lead", F.lead(boxed).over(in_part)),
        "neighbour-parts",
    )
    # one row per part, so this window stays small
    by_part = Window.orderBy("_part")
    edges = (
        local.groupBy("_part")
        .agg(F.min_by(boxed, "_pos").alias("_first"), F.max_by(boxed, "_pos").alias("_last"))
        .select(
            "_part",
            F.lag("_last").over(by_part).alias("_from_before"),
            F.lead("_first").over(by_part).alias("_from_after"),
        )
    )
    return local.join(F.broadcast(edges), "_part").select(
        *df.columns,
        F.coalesce("_lag", "_from_before")["v"].alias(lag_name),
        F.coalesce("_lead", "_from_after")["v"].alias(lead_name),
    )


def with_group_ends(
    df: DataFrame,
    partition_by: list[str],
    order: list[Order],
    column: str,
    first_name: str = "first_value",
    last_name: str = "last_value",
    group_rows: int = HOT_ROWS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add the first and last ``column`` of each group under ``order``.

    The full-frame window equals an aggregate joined back, and the aggregate
    combines on the map side, so no group ever has to fit one task.
    """
    directions = {direction for _, direction in order}
    if len(directions) != 1:
        raise ValueError("order must be all ascending or all descending")
    key = F.struct(*[F.col(name) for name, _ in order])
    boxed = F.struct(F.col(column).alias("v"))
    low, high = F.min_by(boxed, key)["v"], F.max_by(boxed, key)["v"]
    first, last = (low, high) if directions == {"asc"} else (high, low)
    # a struct of the keys also matches the group whose key is NULL
    grouped = df.withColumn("_group", F.struct(*partition_by))
    ends = grouped.groupBy("_group").agg(first.alias(first_name), last.alias(last_name))
    joined = skew_join(grouped, materialise(ends, "group-ends"), ["_group"], "left", group_rows, broadcast_bytes)
    return joined.select(*df.columns, first_name, last_name)


def top_per_group(df: DataFrame, partition_by: list[str], order: list[Order], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each group.

    Spark cuts every map task's share of a group to ``n`` rows before the
    shuffle (WindowGroupLimit), so a hot group sends ``n`` rows per task. Above
    the limit up to which Spark does so, groups are cut in shares first: a
    task then sees a share of a hot group, and ``n`` rows of each share are left.
    """
    limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    order_by = sort_columns(order)

    def cut(rows: DataFrame, groups: list[str]) -> DataFrame:
        place = F.row_number().over(Window.partitionBy(*groups).orderBy(*order_by))
        return rows.withColumn("_place", place).where(F.col("_place") <= n).drop("_place")

    if n > limit:
        content = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]) + F.spark_partition_id()
        df = cut(df.withColumn("_share", F.pmod(content, F.lit(GROUP_SHARES))), [*partition_by, "_share"]).drop("_share")
    return cut(df, partition_by)

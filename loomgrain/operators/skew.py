"""Joins and broadcasts that hold up when one key owns a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomgrain.session import MB, materialise

HOT_ROWS = 5_000_000
HOT_BYTES = 1024 * MB
BROADCAST_BYTES = 256 * MB
BROADCAST_ROWS = 2_000_000
NULL_KEY_SHARES = 4096
SAMPLE_ROWS = 1000
SAMPLE_SEED = 20260101

_FIXED_WIDTH = 16


def row_bytes(df: DataFrame):
    """Column with the approximate in-memory width of a row."""
    fixed = _FIXED_WIDTH * len(df.schema.fields)
    width = F.lit(fixed).cast("long")
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(F.col(f"`{field.name}`")), F.lit(0))
        elif not isinstance(field.dataType, T.AtomicType):
            width = width + F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f"`{field.name}`")))), F.lit(0))
    return width


def fits_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES, max_rows: int = BROADCAST_ROWS) -> bool:
    """Measure ``df``: its rows first, and their width only if there are few.

    A count reads no columns of a columnar table, so a large side is told apart
    without being scanned.
    """
    if max_bytes <= 0 or df.count() > max_rows:
        return False
    return (df.agg(F.sum(row_bytes(df)).alias("bytes")).first()["bytes"] or 0) <= max_bytes


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only for a side whose size has been measured.

    The measurement evaluates ``df``: stage an expensive one first.
    """
    return F.broadcast(df) if fits_broadcast(df, max_bytes, max_rows) else df


def key_counts(df: DataFrame, on: list[str], limit: int) -> DataFrame:
    """Rows per key, good enough to tell keys with more than ``limit`` rows apart.

    For large limits the count comes from a sample that holds about a thousand
    rows of a key at the limit, so hardly any key is shuffled. The counts choose
    a strategy; no result is computed from them.
    """
    fraction = min(1.0, SAMPLE_ROWS / limit)
    seen = df.select(*on) if fraction == 1.0 else df.select(*on).sample(fraction, seed=SAMPLE_SEED)
    return seen.groupBy(*on).agg(F.ceil(F.count(F.lit(1)) / F.lit(fraction)).alias("_rows"))


def hot_limit(df: DataFrame, hot_rows: int = HOT_ROWS, hot_bytes: int = HOT_BYTES) -> int:
    """Rows of one key a task may hold: ``hot_rows``, fewer where rows are wide. A few rows tell their width."""
    width = df.limit(SAMPLE_ROWS).agg(F.avg(row_bytes(df)).alias("width")).first()["width"]
    return max(1, min(hot_rows, int(hot_bytes / width))) if width else hot_rows


def hot_keys(df: DataFrame, on: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys with more than ``hot_rows`` rows and how many shares to cut each into.

    At most ``rows / hot_rows`` keys can qualify, so the result is bounded
    whatever the data looks like.
    """
    return (
        key_counts(df, on, hot_rows)
        .where(F.col("_rows") > hot_rows)
        .select(*on, F.ceil(F.col("_rows") / F.lit(hot_rows)).cast("int").alias("_shares"))
    )


def _hottest(hot: DataFrame) -> DataFrame:
    """As many of the hottest keys as a broadcast may hold."""
    least = 1
    while not fits_broadcast(hot):
        least *= 2
        hot = hot.where(F.col("_shares") > least)
    return F.broadcast(hot)


def _share(df: DataFrame, shares):
    """A row's share: content and input partition decide, so that neither a hot
    key nor a run of identical copies ends up in one place, and a task that is
    run again gives every row the share it had before."""
    return F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]) + F.spark_partition_id(), shares).cast("int")


def skew_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str = "inner",
    hot_rows: int = HOT_ROWS,
    broadcast_bytes: int = BROADCAST_BYTES,
    count_on: DataFrame | None = None,
) -> DataFrame:
    """Equi join whose left side may have hot keys.

    A right side measured as small is broadcast: no left row moves. Otherwise
    the left rows of every hot key are cut into shares. Rows of other keys take
    share 0 on both sides; the right rows of a hot key are repeated once per
    share. Left rows without a key are spread as well. ``how`` must keep the
    left side whole or drop it by match: inner, left, left_semi or left_anti.

    Keys are counted, and the width of rows is told, on ``count_on`` where
    ``left`` itself is expensive: ``left`` is then computed by the join alone.
    Which keys count as hot decides the cost and never the result.
    """
    if how not in {"inner", "left", "left_semi", "left_anti"}:
        raise ValueError(f"skew_join does not support {how}")
    if fits_broadcast(right, broadcast_bytes):
        return left.join(F.broadcast(right), on, how)
    counted = left if count_on is None else count_on
    hot = materialise(hot_keys(counted, on, hot_limit(counted, hot_rows)), "hot-keys")
    if hot.isEmpty():
        return left.join(right, on, how)
    hot = _hottest(hot)
    no_key = F.expr(" OR ".join(f"`{k}` IS NULL" for k in on))
    shared_left = (
        left.join(hot, on, "left")
        # a missing key matches nothing, so its rows may go anywhere
        .withColumn("_shares", F.when(no_key, F.lit(NULL_KEY_SHARES)).otherwise(F.coalesce("_shares", F.lit(1))))
        .withColumn("_share", _share(left, F.col("_shares")))
        .drop("_shares")
    )
    shared_right = (
        right.join(hot, on, "left")
        .withColumn("_share", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_shares"), F.lit(1)) - 1)))
        .drop("_shares")
    )
    return shared_left.join(shared_right, [*on, "_share"], how).drop("_share")


def grid_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner", hot_rows: int = HOT_ROWS) -> DataFrame:
    """Equi join whose keys may be hot on both sides: inner, left, right or full.

    The rows of a hot key lie in a grid of left by right shares: a left row
    goes to one share and is repeated along the right ones, a right row the
    other way round, so each pair meets in one cell and no task holds more than
    about ``hot_rows`` of a side. A cell may be empty of one side although the
    key is not, so rows without a partner are not told by cell: those of either
    side come from an anti join with the other side's distinct keys, once.
    Rows without a key have no partner. Without hot keys it is a plain join.
    """
    if how not in {"inner", "left", "right", "full"}:
        raise ValueError(f"grid_join does not support {how}")
    counted = [hot_keys(side, on, hot_limit(side, hot_rows)).withColumnRenamed("_shares", name) for side, name in ((left, "_l"), (right, "_r"))]
    hot = counted[0].join(counted[1], on, "full").select(*on, F.coalesce("_l", F.lit(1)).alias("_l"), F.coalesce("_r", F.lit(1)).alias("_r"))
    hot = materialise(hot.where(F.expr(" AND ".join(f"`{k}` IS NOT NULL" for k in on))), "grid-keys")
    if hot.isEmpty():
        return left.join(right, on, how)
    shares = _hottest(hot.withColumn("_shares", F.greatest("_l", "_r"))).drop("_shares")

    def placed(side: DataFrame, own: str, other: str, place: str, along: str) -> DataFrame:
        return (
            side.withColumn(place, _share(side, F.lit(1 << 30)))
            .join(shares, on, "left")
            .withColumn(place, F.pmod(F.col(place), F.coalesce(own, F.lit(1))))
            .withColumn(along, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(other), F.lit(1)) - 1)))
            .drop(own, other)
        )

    met = placed(left, "_l", "_r", "_i", "_j").join(placed(right, "_r", "_l", "_j", "_i"), [*on, "_i", "_j"]).drop("_i", "_j")
    for side, other, kinds in ((left, right, {"left", "full"}), (right, left, {"right", "full"})):
        if how in kinds:
            keys = materialise(other.select(*on).distinct(), "grid-partners")
            met = met.unionByName(skew_join(side, keys, on, "left_anti", hot_rows), allowMissingColumns=True)
    return met

"""Join of points to closed value bands without comparing every pair."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgrain.operators.skew import BROADCAST_BYTES, HOT_ROWS, skew_join
from loomgrain.session import materialise

FINEST_LEVEL = -20
FINEST_CELL = 2.0**FINEST_LEVEL
# cell numbers stay below 2^CELL_BITS, where a double still tells neighbours apart
CELL_BITS = 50
# above the level of any finite width: one cell for all bands without an end
OPEN_LEVEL = 1100


def band_join(
    points: DataFrame,
    bands: DataFrame,
    value: str,
    low: str,
    high: str,
    how: str = "inner",
    hot_rows: int = HOT_ROWS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Rows of ``points`` paired with the ``bands`` where low <= value <= high.

    A band belongs to the level whose cell size is the power of two just above
    its width, so it touches at most two cells however wide it is. The cell
    also grows with the band's values, so that cell numbers stay exact for
    values up to the largest double. Bands with an infinite end share one level
    of one cell. A point looks up one cell per level that occurs. The cells
    give an equi join, and the original predicate settles the match.
    """
    if how not in {"inner", "left"}:
        raise ValueError(f"band_join does not support {how}")
    low_value, high_value = (F.col(x).cast("double") for x in (low, high))
    width = F.greatest(high_value - low_value, F.lit(0.0))
    by_width = F.when(width <= FINEST_CELL, F.lit(FINEST_LEVEL)).otherwise(F.ceil(F.log2(width)).cast("int"))
    size = F.greatest(F.abs(low_value), F.abs(high_value))
    by_size = F.when(size < 1, F.lit(FINEST_LEVEL)).otherwise(F.ceil(F.log2(size)).cast("int") - CELL_BITS)
    finite = (size < F.lit(float("inf"))) & (width < F.lit(float("inf")))
    level = F.when(finite, F.greatest(by_width, by_size)).otherwise(F.lit(OPEN_LEVEL))

    def cell(column, lvl):
        # the quotient of a point may pass the range of a long, where floor stops at its end: no band lies there
        placed = F.floor(F.col(column).cast("double") / F.pow(F.lit(2.0), lvl)).cast("long")
        return F.when(lvl < OPEN_LEVEL, placed).otherwise(F.lit(0).cast("long"))

    placed = (
        bands.where(F.col(low) <= F.col(high))
        .withColumn("_level", level)
        .withColumn("_cell", F.explode(F.sequence(cell(low, F.col("_level")), cell(high, F.col("_level")))))
    )
    # widths of doubles span about a thousand powers of two: a bounded list
    levels = sorted(row["_level"] for row in placed.select("_level").distinct().collect())
    listed = F.array(*[F.lit(lvl) for lvl in levels]).cast("array<int>")

    point_columns = points.columns
    band_columns = bands.columns
    tagged = points.withColumn("_point", F.monotonically_increasing_id()) if how == "left" else points
    if how == "left":
        tagged = materialise(tagged, "band-points")
    spread = (
        tagged.where(F.col(value).isNotNull())
        .withColumn("_level", F.explode(listed))
        .withColumn("_cell", cell(value, F.col("_level")))
    )
    matched = (
        skew_join(spread, placed, ["_level", "_cell"], "inner", hot_rows, broadcast_bytes)
        .where(F.col(value).between(F.col(low), F.col(high)))
    )
    if how == "inner":
        return matched.select(*point_columns, *band_columns)
    return (
        tagged.join(matched.select("_point", *band_columns), "_point", "left")
        .select(*point_columns, *band_columns)
    )

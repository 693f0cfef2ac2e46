"""Ranks over one huge ordering, without sorting it in a single task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANK_RANGE = 1 << 16
#: Bits of a carried rank: the input, and the row and column of its window.
ORD_BITS, PIECE_BITS = 24, 15
PIECES_ACROSS = 1 << 31  # more windows than a row of pixels can have


def carried_rank(ord: Column | str, piece_index: Column | str) -> Column:
    """A priority that falls with ``ord``, then with the window's row and column, known without looking at other rows.

    It fits beside a byte in 64 bits. Null where an input or window is beyond its bits.
    """
    place, piece = (F.col(c) if isinstance(c, str) else c for c in (ord, piece_index))
    row, column = F.shiftright(piece.cast("bigint"), 31), piece.cast("bigint").bitwiseAND(F.lit(PIECES_ACROSS - 1))
    ords, pieces = 1 << ORD_BITS, 1 << PIECE_BITS
    fits = place.between(0, ords - 1) & row.between(0, pieces - 1) & (column < pieces)
    return F.when(fits, (ords - 1 - place) * pieces * pieces + (pieces - 1 - row) * pieces + (pieces - 1 - column)).cast("bigint")


def with_position(
    df: DataFrame, job: str, ord: str, tie: str | None = None, position: str = "position", total: str = "total"
) -> DataFrame:
    """Adds the 0-based place of each row within its job by ``ord, tie``, and the job's row count.

    Both are whole numbers, unique together within the job; gaps are fine. Rows are ranked inside
    ranges of ``RANK_RANGE`` values, so no window grows with the table even if one job owns all of
    it. What comes before a range is a running sum over one count per range.
    """
    ranges = ["_range"] if tie is None else ["_range", ord, "_ties"]
    ranged = df.withColumn("_range", F.floor(F.col(ord) / RANK_RANGE))
    if tie is not None:
        ranged = ranged.withColumn("_ties", F.floor(F.col(tie) / RANK_RANGE))
    starts = _starts(ranged, job, ranges, total)
    inside = Window.partitionBy(job, *ranges).orderBy(tie or ord)
    return (
        ranged.withColumn("_place", F.row_number().over(inside) - 1)
        .join(starts, [job, *ranges])
        .withColumn(position, F.col("_start") + F.col("_place"))
        .drop("_range", "_ties", "_start", "_place")
    )


def _starts(ranged: DataFrame, job: str, ranges: list[str], total: str) -> DataFrame:
    """How many rows of the job come before each range."""
    counts = ranged.groupBy(job, *ranges).agg(F.count(F.lit(1)).alias("_n"))
    if len(ranges) == 1:
        return counts.select(job, *ranges, _before([job], ranges).alias("_start"), _total(job).alias(total))
    coarse = counts.groupBy(job, "_range").agg(F.sum("_n").alias("_n"))
    earlier = coarse.select(job, "_range", _before([job], ["_range"]).alias("_earlier"), _total(job).alias(total))
    inside = counts.select(job, *ranges, _before([job, "_range"], ranges[1:]).alias("_inside"))
    return inside.join(earlier, [job, "_range"]).select(job, *ranges, (F.col("_earlier") + F.col("_inside")).alias("_start"), total)


def _before(within: list[str], by: list[str]) -> Column:
    earlier = Window.partitionBy(*within).orderBy(*by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.sum("_n").over(earlier) - F.col("_n")


def _total(job: str) -> Column:
    return F.sum("_n").over(Window.partitionBy(job))

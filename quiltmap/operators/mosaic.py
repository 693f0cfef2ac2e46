"""Pixel form: merging overlaps and halving the resolution.

A pixel row is ``zoom, gx, gy, r, g, b`` with ``priority``; ``gx, gy`` count pixels across the
whole world at that zoom. Absent pixels are transparent.

While inputs are still being merged each band is ``priority * 256 + value`` in one bigint, null
where transparent, so that "the value on top" is a plain maximum and the hash aggregate keeps
fixed-width buffers. Two inputs of equal priority are settled by the larger value.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quiltmap.functions.pixels import BANDS

RANKS = [f"{b}_rank" for b in BANDS]
PIXEL = ["zoom", "gx", "gy"]
HAS_DATA = f"greatest({', '.join(BANDS)}, 0) > 0"

NEEDED = "coalesce(cast(priority AS bigint), cast(raise_error('a pixel with data has no priority') AS bigint))"
TOP_BYTES = f"if({HAS_DATA}, shiftleft({NEEDED}, 8), null) AS _top"  # checked once for all bands
RANKED = [f"if({b} <> 0, _top | {b}, null) AS {b}_rank" for b in BANDS]
TOPS = [f"max({r}) AS {r}" for r in RANKS]
VALUES = [f"cast(coalesce({b}_rank & 255, 0) AS int) AS {b}" for b in BANDS]
TOP_PRIORITY = f"shiftright(greatest({', '.join(RANKS)}), 8) AS priority"

PARENT = ["shiftright(gx, 1) AS gx", "shiftright(gy, 1) AS gy"]
SUMS = [s for b in BANDS for s in (f"sum({b}) FILTER (WHERE {b} <> 0) AS {b}_sum", f"count_if({b} <> 0) AS {b}_count")]
CARRIED = f"max(priority) FILTER (WHERE {HAS_DATA}) AS carried"
MEANS = {b: f"(2 * {b}_sum + {b}_count) div nullif(2 * {b}_count, 0)" for b in BANDS}
HALVED = [f"cast(coalesce({mean}, 0) AS int) AS {b}" for b, mean in MEANS.items()]


def aggregates(expressions: list[str]):
    return [F.expr(e) for e in expressions]


def ranked(pixels: DataFrame) -> DataFrame:
    return pixels.selectExpr(*PIXEL, *BANDS, TOP_BYTES).selectExpr(*PIXEL, *RANKED)


def merge_ranked(ranks: DataFrame) -> DataFrame:
    """One row per pixel, still with a priority per band, so it can meet further inputs.

    One hash aggregate with map-side partials: a pixel covered by a third of the table still
    leaves each task as one row.
    """
    return ranks.groupBy(*PIXEL).agg(*aggregates(TOPS))


def finished(ranks: DataFrame) -> DataFrame:
    """Band bytes, and one priority per pixel: that of the highest input holding data there."""
    return ranks.selectExpr(*PIXEL, *VALUES, TOP_PRIORITY)


def mosaic_merge(pixels: DataFrame) -> DataFrame:
    """Per pixel and band, the non-zero value of the input with the highest priority."""
    return finished(merge_ranked(ranked(pixels)))


def zoom_up(merged: DataFrame) -> DataFrame:
    """Four pixels to one: the rounded mean (half up) of the data, under the highest priority."""
    parents = merged.selectExpr("zoom - 1 AS zoom", *PARENT, *BANDS, "priority")
    return parents.groupBy(*PIXEL).agg(*aggregates([*SUMS, CARRIED])).selectExpr(*PIXEL, *HALVED, "carried AS priority")


def order_down(merged: DataFrame) -> DataFrame:
    """The priority a parent pixel takes over from its children; null where none holds data."""
    parents = merged.selectExpr("zoom - 1 AS zoom", *PARENT, *BANDS, "priority")
    return parents.groupBy(*PIXEL).agg(F.expr(CARRIED)).withColumnRenamed("carried", "priority")


def finish_level(ranks: list[DataFrame]) -> DataFrame:
    """One finished level of ``px, py, gx, gy, r, g, b, priority`` from ranked rows that are already merged per side.

    Rows are partitioned by their parent pixel. That is enough to merge them, and enough to halve
    the level afterwards, so what moves from level to level is a quarter of each.
    """
    rows = union_inputs([r.select("gx", "gy", *RANKS) for r in ranks])
    level = rows.repartition(F.shiftright("gx", 1), F.shiftright("gy", 1)).selectExpr(
        "shiftright(gx, 1) AS px", "shiftright(gy, 1) AS py", "gx", "gy", *RANKS
    )
    if len(ranks) > 1:
        level = level.groupBy("px", "py", "gx", "gy").agg(*aggregates(TOPS))
    return level.selectExpr("px", "py", "gx", "gy", *VALUES, TOP_PRIORITY)


def halve_level(level: DataFrame) -> DataFrame:
    """A finished level as ranked rows of the next one up; no shuffle after ``finish_level``."""
    sums = level.groupBy("px", "py").agg(*aggregates([*SUMS, CARRIED]))
    return sums.selectExpr("px AS gx", "py AS gy", *[f"shiftleft(carried, 8) | ({mean}) AS {b}_rank" for b, mean in MEANS.items()])


def union_inputs(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)

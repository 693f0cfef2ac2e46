"""From image rectangles to the tiles they cover, and how many there are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quiltmap.functions.grid import CHUNK_TILE, GridBounds, grid_size, scaled_grid_bounds, tile_affine, tile_path, world_clip
from quiltmap.functions.pixels import BANDS
from quiltmap.functions.ranking import with_position
from quiltmap.session import spread

BLOCK = 64  # a row of the cover fans out to at most BLOCK * BLOCK tiles


def row_bounds() -> GridBounds:
    return GridBounds(F.col("col_min"), F.col("row_min"), F.col("col_max"), F.col("row_max"))


def _spans(first: Column, last: Column, step: int) -> Column:
    return F.sequence(first, last, F.lit(step))


def explode_bounds(rects: DataFrame, keep: list[str], block: int = BLOCK) -> DataFrame:
    """One row per tile of each non-empty rectangle: ``keep`` columns plus ``col, row``.

    ``rects`` has ``col_min, row_min, col_max, row_max``. Rectangles up to ``block * block`` tiles
    fan out where they are. Larger ones are first cut into blocks, which are shuffled, so that one
    image covering half the world is spread over the cluster instead of one task.
    """
    b = row_bounds()
    sized = rects.withColumn("_size", grid_size(b)).where(F.col("_size") > 0)
    small = sized.where(F.col("_size") <= block * block).select(*keep, *b)
    large = sized.where(F.col("_size") > block * block)
    stripes = large.select(*keep, *b, F.explode(_spans(b.col_min, b.col_max, block)).alias("_c"))
    blocks = spread(stripes.select(*keep, *b, "_c", F.explode(_spans(b.row_min, b.row_max, block)).alias("_r")), *keep, "_c", "_r")
    cut = blocks.select(
        *keep,
        F.col("_c").alias("col_min"),
        F.col("_r").alias("row_min"),
        F.least(F.col("_c") + block - 1, b.col_max).alias("col_max"),
        F.least(F.col("_r") + block - 1, b.row_max).alias("row_max"),
    )
    columns = small.unionByName(cut).select(*keep, "row_min", "row_max", F.explode(F.sequence("col_min", "col_max")).alias("col"))
    return columns.select(*keep, "col", F.explode(F.sequence("row_min", "row_max")).alias("row"))


def tile_cover(sources: DataFrame, keep: list[str], folder: str, tile_dim: int = CHUNK_TILE) -> DataFrame:
    """Every chunk key an image covers, clipped to the world, with its transform and path."""
    clipped = sources.select(*dict.fromkeys([*keep, folder, "zoom"]), *world_clip(row_bounds(), "zoom").named())
    keys = explode_bounds(clipped, list(dict.fromkeys([*keep, folder, "zoom"])))
    return keys.select(
        *dict.fromkeys([*keep, "zoom"]),
        "col",
        "row",
        F.struct(*tile_affine("col", "row", "zoom", tile_dim).named()).alias("transform"),
        tile_path(folder, "zoom", "col", "row", "tif").alias("path"),
    )


def lowered(rects: DataFrame, min_zoom: int) -> DataFrame:
    """Each rectangle that is not empty at its own zoom and at every zoom above it down to ``min_zoom``."""
    levels = rects.where(grid_size(row_bounds()) > 0).select(
        "zoom", *row_bounds(), F.explode(F.sequence(F.col("zoom"), F.lit(min_zoom), F.lit(-1))).alias("_at")
    ).where(F.col("_at") >= min_zoom)
    return levels.select(F.col("_at").alias("zoom"), *scaled_grid_bounds(row_bounds(), F.col("_at") - F.col("zoom")).named())


def tile_counts_unmerged(rects: DataFrame, min_zoom: int = 2) -> DataFrame:
    """Tiles per zoom, overlaps counted each time."""
    return lowered(rects.where(F.col("zoom") >= min_zoom), min_zoom).groupBy("zoom").agg(F.sum(grid_size(row_bounds())).alias("tiles"))


def tile_counts_merged(rects: DataFrame, min_zoom: int = 2) -> DataFrame:
    """Distinct tiles per zoom: the area of the union, summed over strips; no row stands for a tile."""
    strips = with_columns(*union_strips(lowered(rects.where(F.col("zoom") >= min_zoom), min_zoom)))
    return strips.groupBy("zoom").agg(F.sum(grid_size(row_bounds())).alias("tiles"))


def distinct_tiles(rects: DataFrame) -> DataFrame:
    """The distinct tile keys of overlapping rectangles."""
    return explode_bounds(rects.select("zoom", *row_bounds()), ["zoom"]).distinct()


def distinct_bounds(rects: DataFrame) -> DataFrame:
    """Overlapping rectangles as rectangles without overlaps that cover the same tiles.

    The result is canonical: the maximal row intervals of each column, joined over neighbouring columns that have
    the same one. Its size depends on how the rectangles meet, not on how large they are. Rectangles without a zoom
    are covered among themselves: inside a struct, a null meets its like in a join.
    """
    strips, edges = union_strips(rects.withColumn("zoom", F.struct("zoom")))
    same = Window.partitionBy("zoom", "row_min", "row_max").orderBy("strip")
    runs = strips.withColumn("_run", F.col("strip") - F.row_number().over(same))
    joined = runs.groupBy("zoom", "row_min", "row_max", "_run").agg(F.min("strip").alias("strip"), (F.max("strip") + 1).alias("_end"))
    placed = with_columns(joined.drop("_run"), edges, "_end").withColumns({c: F.col(c).cast("int") for c in ("col_min", "col_max")})
    return placed.select("zoom.zoom", *row_bounds())


def union_strips(rects: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The union of rectangles as row intervals of vertical strips: ``zoom, strip, row_min, row_max``, and the strips' edges.

    A sweep over columns: the distinct edges of a zoom are numbered, a strip lies between two neighbouring ones, and
    a rectangle becomes one interval in each strip it spans. Rectangles that span many strips are cut and spread
    first; intervals that begin at one row leave each task as one row. Within a strip, intervals are joined by a
    running maximum over their sorted beginnings.
    """
    some = rects.select("zoom", *row_bounds()).where(grid_size(row_bounds()) > 0).distinct()
    ends = some.select("zoom", F.explode(F.array(F.col("col_min").cast("bigint"), F.col("col_max").cast("bigint") + 1)).alias("col"))
    edges = with_position(ends.distinct(), "zoom", "col", position="strip").select("zoom", "col", "strip")
    left = edges.withColumnsRenamed({"col": "_left", "strip": "_lo"})
    right = edges.withColumnsRenamed({"col": "_right", "strip": "_hi"})
    placed = some.withColumns({"_left": F.col("col_min").cast("bigint"), "_right": F.col("col_max").cast("bigint") + 1})
    numbered = placed.join(left, ["zoom", "_left"]).join(right, ["zoom", "_right"]).select("zoom", "_lo", "_hi", "row_min", "row_max")
    own = ["zoom", "row_min", "row_max"]
    short = numbered.where(F.col("_hi") - F.col("_lo") <= BLOCK * BLOCK)
    long = numbered.where(F.col("_hi") - F.col("_lo") > BLOCK * BLOCK)
    cut = spread(long.select(*own, "_hi", F.explode(_spans(F.col("_lo"), F.col("_hi") - 1, BLOCK * BLOCK)).alias("_lo")), *own, "_lo")
    cut = cut.withColumn("_hi", F.least(F.col("_hi"), F.col("_lo") + BLOCK * BLOCK))
    spanned = short.unionByName(cut).select("zoom", "row_min", "row_max", F.explode(_spans(F.col("_lo"), F.col("_hi") - 1, 1)).alias("strip"))
    intervals = spanned.groupBy("zoom", "strip", "row_min").agg(F.max("row_max").alias("row_max"))
    ordered = Window.partitionBy("zoom", "strip").orderBy("row_min")
    reached = F.max(F.col("row_max").cast("bigint")).over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    begun = intervals.withColumn("_new", F.when(F.col("row_min") <= reached + 1, 0).otherwise(1))
    islands = begun.withColumn("_island", F.sum("_new").over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    strips = islands.groupBy("zoom", "strip", "_island").agg(F.min("row_min").alias("row_min"), F.max("row_max").alias("row_max"))
    return strips.drop("_island"), edges


def with_columns(strips: DataFrame, edges: DataFrame, end: str | None = None) -> DataFrame:
    """Strips with ``col_min, col_max``: from the edge numbered ``strip`` to before the next one, or the one numbered ``end``.

    Both are bigints: the edge after the last column of zoom 31 is no int.
    """
    until = F.col(end) if end else F.col("strip") + 1
    first = edges.select("zoom", "strip", F.col("col").alias("col_min"))
    last = edges.select("zoom", F.col("strip").alias("_until"), (F.col("col") - 1).alias("col_max"))
    return strips.withColumn("_until", until).join(first, ["zoom", "strip"]).join(last, ["zoom", "_until"])


def nonempty_chunks(chunk_pixels: DataFrame, keys: list[str], bands=BANDS) -> DataFrame:
    """Chunks in which any band of any pixel is not zero."""
    lit = F.greatest(*[F.col(b) for b in bands], F.lit(0))
    return chunk_pixels.groupBy(*keys).agg(F.max(lit).alias("_top")).where(F.col("_top") > 0).select(*keys)


def valid_sources(sources: DataFrame, nonempty: DataFrame, *keys: str) -> DataFrame:
    """Sources with at least one non-empty chunk."""
    return sources.join(nonempty.select(*keys).distinct(), list(keys), "left_semi")


def chunk_stats(cover: DataFrame, key: str) -> DataFrame:
    return cover.groupBy(key).agg(F.count(F.lit(1)).alias("chunks"))

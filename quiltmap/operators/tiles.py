"""Tile form: the same operators on packed tiles, for bulk work at 256 and 1024 pixels."""

from __future__ import annotations

from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quiltmap.functions.grid import EARTH_RADIUS, RETILE_WINDOW, WORLD_WIDTH
from quiltmap.functions.pixels import BANDS
from quiltmap.operators import kernels
from quiltmap.session import spread

KEY = ["zoom", "col", "row"]
MERGED = "zoom int, col int, row int, priority bigint, bands array<binary>, palette array<bigint>, orders array<binary>"
HELD = 64
PARTITION_BYTES = 1 << 28


def arrow_schema(schema: StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def kept_and(df: DataFrame, keep: list[str], ddl: str) -> StructType:
    """The schema of some columns of a frame followed by new ones."""
    return StructType([*[df.schema[k] for k in keep], *StructType.fromDDL(ddl)])


def ints(names) -> str:
    return ", ".join(f"{name} int" for name in names)


def as_merged(tiles: DataFrame) -> DataFrame:
    """Input tiles in the columns of a merged one."""
    return tiles.select(*KEY, "priority", "bands", F.lit(None).cast("array<bigint>").alias("palette"), F.lit(None).cast("array<binary>").alias("orders"))


class Load(NamedTuple):
    """What a tile table holds at one zoom."""

    zoom: int
    tiles: int


def tile_load(tiles: DataFrame) -> list[Load]:
    """One entry per zoom, deepest first. Reads the zoom alone; sizes the work on the rest."""
    per_zoom = tiles.groupBy("zoom").agg(F.count(F.lit(1)).alias("tiles"))
    return [Load(*row) for row in per_zoom.orderBy(F.desc("zoom")).collect()]


def partitions_for(tiles: int, dim: int) -> int:
    """Partitions of about a quarter gigabyte of pixels."""
    return tiles * len(BANDS) * dim * dim // PARTITION_BYTES


def combined(tiles: DataFrame, held: int = HELD) -> DataFrame:
    """Merges inputs of one key where they are read, before anything is shuffled.

    A task holds the tiles of the ``held`` keys it met last. A key that a third of all inputs fall on is always
    among them and leaves each task as one tile; merging is a maximum, so neither order nor grouping shows.
    Every tile is read once, and tiles without another one near pass as they are.
    """
    return tiles.mapInArrow(kernels.combine_each(held), MERGED)


def mosaic_merge_tiles(tiles: DataFrame, dim: int, held: int = HELD) -> DataFrame:
    """One finished tile per key: the highest priority's non-zero value per pixel and band."""
    size = partitions_for(sum(z.tiles for z in tile_load(tiles)), dim)
    return spread(combined(as_merged(tiles), held), *KEY, at_least=size).groupBy(*KEY).applyInArrow(kernels.merge_group(per_band=False), MERGED)


def fold_levels(tiles: DataFrame, hi: int, lo: int, dim: int, partitions: int = 0, orders: bool = True, carry: bool = False) -> DataFrame:
    """Finishes levels ``hi`` to ``lo`` with one shuffle: all tiles under one ancestor at ``lo`` meet.

    Tiles of the level below ``hi`` come halved; with ``carry`` those of ``lo`` are given out halved too, under ``-lo``.

    A task holds at most 4^(hi-lo) tiles of the deepest level and streams what is drawn on them.
    """
    placed = tiles.select("*", *[F.expr(f"shiftright({axis}, zoom - {lo})").alias(f"_{axis}") for axis in ("col", "row")])
    groups = spread(placed, "_col", "_row", at_least=partitions).groupBy("_col", "_row")
    return groups.applyInArrow(kernels.fold_group(hi, lo, dim, orders, carry), MERGED)


def zoom_up_tiles(merged: DataFrame, dim: int) -> DataFrame:
    """Parents of merged tiles. Tiles are halved before the shuffle, so a quarter of their pixels moves."""
    parent = [F.shiftright(axis, 1).alias(f"_{axis}") for axis in ("col", "row")]
    placed = halve_tiles(merged, dim).select("*", *parent)
    return spread(placed, "zoom", "_col", "_row").groupBy("zoom", "_col", "_row").applyInArrow(kernels.quarters_group(dim), MERGED)


def halve_tiles(merged: DataFrame, dim: int) -> DataFrame:
    """The quarter of its parent that each tile fills, ``dim / 2`` pixels wide, still under the tile's key."""
    return merged.select(*KEY, "priority", "bands", "palette", "orders").mapInArrow(kernels.halve_each(dim), MERGED)


def split_packed(tiles: DataFrame, across: int) -> DataFrame:
    return tiles.mapInArrow(kernels.split_each(across, arrow_schema(tiles.schema)), tiles.schema)


def tile_explode(tiles: DataFrame, keep: list[str], dim: int, names=BANDS) -> DataFrame:
    """Packed tiles to pixel rows; transparent pixels have none."""
    out = kept_and(tiles, keep, f"priority bigint, gx int, gy int, {ints(names)}")
    needed = [*dict.fromkeys([*keep, "priority", "col", "row", "bands"])] + [c for c in ("palette", "orders") if c in tiles.columns]
    return tiles.select(*needed).mapInArrow(kernels.explode_each(dim, list(names), arrow_schema(out)), out)


def tile_assemble(pixels: DataFrame, keep: list[str], dim: int, names=BANDS) -> DataFrame:
    """Pixel rows to packed tiles, one per ``keep`` and key: a task sorts its pixels by tile and draws many at a time."""
    placed = pixels.select(
        *keep,
        F.floor(F.col("gx") / dim).cast("int").alias("col"),
        F.floor(F.col("gy") / dim).cast("int").alias("row"),
        F.pmod("gx", F.lit(dim)).cast("int").alias("x"),
        F.pmod("gy", F.lit(dim)).cast("int").alias("y"),
        *names,
    )
    keys = [*keep, "col", "row"]
    out = kept_and(placed, keys, "bands array<binary>")
    return spread(placed, *keys).sortWithinPartitions(*keys).mapInArrow(kernels.assemble_runs(dim, list(names), keys, arrow_schema(out)), out)


def nonempty_tiles(tiles: DataFrame, dim: int) -> DataFrame:
    """Drops tiles whose bands are all zero bytes; a byte comparison inside the JVM."""
    blank = F.lit(bytearray(dim * dim))
    return tiles.where(F.exists("bands", lambda band: band != blank))


DEGREES = ["lon0", "lat0", "deg", "res"]
SHAPE = ["x0", "y0", "width", "height", "bands"]


def retile_blocks(blocks: DataFrame, keep: list[str], window: int = RETILE_WINDOW, reproject: bool = False) -> DataFrame:
    """Stored blocks of an image to windows: a block is cut where it straddles, then parts are pasted.

    With ``reproject`` the blocks that have ``lon0, lat0, deg, res`` are warped first, in the same pass.
    """
    place = ints(["piece_col", "piece_row", "x0", "y0", "width", "height"])
    out = kept_and(blocks, keep, f"{place}, bands array<binary>")
    arrow = arrow_schema(out)
    needed = blocks.select(*dict.fromkeys([*keep, *(DEGREES if reproject else []), *SHAPE]))
    if reproject:
        cut = kernels.warp_fragments(EARTH_RADIUS, window, arrow_schema(needed.schema), arrow)
    else:
        cut = kernels.fragment_each(window, arrow)
    keys = [*keep, "piece_col", "piece_row"]
    parts = spread(needed.mapInArrow(cut, out), *keys).sortWithinPartitions(*keys)
    return parts.mapInArrow(kernels.paste_runs(window, keys, arrow), out)


def reproject_blocks(blocks: DataFrame, keep: list[str]) -> DataFrame:
    """Blocks of an EPSG:4326 image (``lon0, lat0, deg, res``) to blocks of its EPSG:3857 grid, plus alpha."""
    needed = blocks.select(*dict.fromkeys([*keep, *DEGREES, *SHAPE]))
    return needed.mapInArrow(kernels.warp_each(EARTH_RADIUS, arrow_schema(needed.schema)), needed.schema)


def sample_pieces(pieces: DataFrame, keep: list[str], dim: int) -> DataFrame:
    """Pieces (``left, top, res, width, height, zoom, bands``) to the non-empty chunks they fall on.

    With ``x0, y0`` a piece is a window of an image whose corner is ``left, top``.
    """
    out = kept_and(pieces, keep, f"{ints(KEY)}, bands array<binary>")
    corner = [c for c in ("x0", "y0") if c in pieces.columns]
    needed = dict.fromkeys([*keep, "left", "top", *corner, "res", "width", "height", "zoom", "bands"])
    return pieces.select(*needed).mapInArrow(kernels.sample_each(dim, WORLD_WIDTH, arrow_schema(out)), out)


def piece_pixels(pieces: DataFrame, keep: list[str], names=BANDS) -> DataFrame:
    """Pieces (``x0, y0, width, height, bands``) to rows of the pixels that hold data, placed in the image."""
    out = kept_and(pieces, keep, ints(["x", "y", *names]))
    needed = pieces.select(*keep, "x0", "y0", "width", "bands")
    return needed.mapInArrow(kernels.piece_pixels_each(list(names), arrow_schema(out)), out)

"""Web-map grid arithmetic. Everything here is a Column in, Column out."""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the tile scheme.
EARTH_RADIUS = 6378137.0
CHUNK_TILE = 1024
OUTPUT_TILE = 256
RETILE_WINDOW = 2048
ZOOM_ROUND_UP = 0.20

WORLD_WIDTH = 2 * math.pi * EARTH_RADIUS


class GridBounds(NamedTuple):
    """An inclusive rectangle of tiles."""

    col_min: Column
    row_min: Column
    col_max: Column
    row_max: Column

    def named(self) -> list[Column]:
        return [c.cast("int").alias(n) for n, c in self._asdict().items()]


class Extent(NamedTuple):
    """A rectangle in degrees or in metres."""

    xmin: Column
    ymin: Column
    xmax: Column
    ymax: Column

    def named(self) -> list[Column]:
        return [c.alias(n) for n, c in self._asdict().items()]


class Affine(NamedTuple):
    """x = a*col + b*row + c, y = d*col + e*row + f."""

    a: Column
    b: Column
    c: Column
    d: Column
    e: Column
    f: Column

    def named(self) -> list[Column]:
        return [v.alias(n) for n, v in self._asdict().items()]


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tiles_across(zoom: Column | str) -> Column:
    """How many tiles a whole row of the world has at this zoom."""
    return F.pow(F.lit(2.0), col(zoom))


def natural_zoom(resolution: Column | str, tile_dim: int) -> Column:
    """The zoom whose pixels are closest in size; rounds up past a fifth of a level."""
    exact = F.ln(F.lit(WORLD_WIDTH) / (col(resolution) * F.lit(tile_dim))) / F.ln(F.lit(2.0))
    whole = exact.cast("int")
    return F.when(exact - whole > ZOOM_ROUND_UP, whole + 1).otherwise(whole)


def pixel_resolution(a: Column | str, e: Column | str) -> Column:
    return F.greatest(F.abs(col(a)), F.abs(col(e)))


def tile_col(lon: Column | str, zoom: Column | str) -> Column:
    return F.floor((col(lon) + 180.0) / 360.0 * tiles_across(zoom)).cast("int")


def tile_row(lat: Column | str, zoom: Column | str) -> Column:
    phi = F.radians(col(lat))
    up = F.ln(F.tan(phi) + F.lit(1.0) / F.cos(phi)) / F.lit(math.pi)
    return F.floor((F.lit(1.0) - up) / 2.0 * tiles_across(zoom)).cast("int")


def lonlat_to_tile(lon, lat, zoom) -> tuple[Column, Column]:
    return tile_col(lon, zoom), tile_row(lat, zoom)


def tile_lon(column: Column | str, zoom: Column | str) -> Column:
    return col(column) / tiles_across(zoom) * 360.0 - 180.0


def tile_lat(row: Column | str, zoom: Column | str) -> Column:
    return F.degrees(F.atan(F.sinh(F.lit(math.pi) * (F.lit(1.0) - F.lit(2.0) * col(row) / tiles_across(zoom)))))


def tile_upper_left(column, row, zoom) -> tuple[Column, Column]:
    """Longitude and latitude of the north-west corner."""
    return tile_lon(column, zoom), tile_lat(row, zoom)


def tile_extent(column, row, zoom) -> Extent:
    return Extent(
        tile_lon(column, zoom),
        tile_lat(col(row) + 1, zoom),
        tile_lon(col(column) + 1, zoom),
        tile_lat(row, zoom),
    )


def mercator_x(lon: Column | str) -> Column:
    return F.lit(EARTH_RADIUS) * F.radians(col(lon))


def mercator_y(lat: Column | str) -> Column:
    return F.lit(EARTH_RADIUS) * F.ln(F.tan(F.lit(math.pi / 4) + F.radians(col(lat)) / 2.0))


def mercator_lon(x: Column | str) -> Column:
    return F.degrees(col(x) / F.lit(EARTH_RADIUS))


def mercator_lat(y: Column | str) -> Column:
    return F.degrees(F.atan(F.sinh(col(y) / F.lit(EARTH_RADIUS))))


def mercator_extent(e: Extent) -> Extent:
    return Extent(mercator_x(e.xmin), mercator_y(e.ymin), mercator_x(e.xmax), mercator_y(e.ymax))


def lonlat_extent(e: Extent) -> Extent:
    return Extent(mercator_lon(e.xmin), mercator_lat(e.ymin), mercator_lon(e.xmax), mercator_lat(e.ymax))


def affine_from_bounds(e: Extent, width, height) -> Affine:
    zero = F.lit(0.0)
    w = width if isinstance(width, Column) else F.lit(width)
    h = height if isinstance(height, Column) else F.lit(height)
    return Affine((e.xmax - e.xmin) / w, zero, e.xmin, zero, (e.ymin - e.ymax) / h, e.ymax)


def tile_affine(column, row, zoom, tile_dim: int) -> Affine:
    """Pixel-to-metres transform of one tile."""
    return affine_from_bounds(mercator_extent(tile_extent(column, row, zoom)), tile_dim, tile_dim)


def image_grid_bounds(e: Extent, zoom) -> GridBounds:
    """Tiles from the one under the north-west corner to the one under the south-east corner."""
    return GridBounds(tile_col(e.xmin, zoom), tile_row(e.ymax, zoom), tile_col(e.xmax, zoom), tile_row(e.ymin, zoom))


def world_clip(b: GridBounds, zoom) -> GridBounds:
    """Cut the far edge at the last tile of the world."""
    last = (tiles_across(zoom) - 1).cast("int")
    return b._replace(col_max=F.least(b.col_max, last), row_max=F.least(b.row_max, last))


def grid_size(b: GridBounds) -> Column:
    """Number of tiles in the rectangle, 0 if it is empty."""
    across = F.greatest(b.col_max.cast("bigint") - b.col_min + 1, F.lit(0))
    down = F.greatest(b.row_max.cast("bigint") - b.row_min + 1, F.lit(0))
    return across * down


def scaled_grid_bounds(b: GridBounds, levels: Column | str | int) -> GridBounds:
    """The same ground that many levels deeper (or higher when negative)."""
    d = F.lit(levels) if isinstance(levels, int) else col(levels)
    n = F.pow(F.lit(2.0), F.abs(d)).cast("bigint")

    def low(v):
        return F.when(d >= 0, v * n).otherwise(F.floor(v / n)).cast("int")

    def high(v):
        return F.when(d >= 0, (v + 1) * n - 1).otherwise(F.floor(v / n)).cast("int")

    return GridBounds(low(b.col_min), low(b.row_min), high(b.col_max), high(b.row_max))


def zoom_offset(tile_size: Column | str, output_tile: int = OUTPUT_TILE) -> Column:
    """Levels between a big tile and the output tile; anything but a power of two times it fails."""
    size = col(tile_size)
    levels = F.round(F.log2(size / F.lit(float(output_tile)))).cast("int")
    exact = F.pow(F.lit(2.0), levels) * output_tile == size
    return F.when((size >= output_tile) & exact, levels).otherwise(
        F.raise_error(F.concat(F.lit(f"tileSize must be {output_tile} times a power of two, got "), size.cast("string"))).cast("int")
    )


def parent_key(column, row) -> tuple[Column, Column]:
    return F.shiftright(col(column), 1), F.shiftright(col(row), 1)


SPREAD_BITS = [(16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)]


def morton_key(column, row) -> Column:
    """The bits of column and row by turns: keys near each other in this order are near each other on the map."""

    def spaced(v):
        bits = col(v).cast("bigint")
        for step, mask in SPREAD_BITS:
            bits = bits.bitwiseOR(F.shiftleft(bits, step)).bitwiseAND(F.lit(mask))
        return bits

    return spaced(column).bitwiseOR(F.shiftleft(spaced(row), 1))


def child_quadrant(column, row) -> tuple[Column, Column]:
    """(0|1, 0|1): right half, lower half of the parent."""
    return F.pmod(col(column), F.lit(2)), F.pmod(col(row), F.lit(2))


def extent_intersects(a: Extent, b: Extent) -> Column:
    return (a.xmin <= b.xmax) & (b.xmin <= a.xmax) & (a.ymin <= b.ymax) & (b.ymin <= a.ymax)


def tile_path(folder, zoom, column, row, extension: str) -> Column:
    return F.concat(
        F.concat_ws("/", col(folder), col(zoom).cast("string"), col(column).cast("string"), col(row).cast("string")),
        F.lit("." + extension),
    )

"""Resampling a source raster onto the tile grid, nearest neighbour.

The rule is stated from the target's side: a target pixel takes the source pixel its centre
falls in. The work is done from the source's side, because a source pixel touches only a few
target pixels next to it: each one lists the targets around it and keeps those whose centre
really falls inside. No target grid is generated, nothing is joined, and nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quiltmap.functions.grid import (
    Extent,
    GridBounds,
    WORLD_WIDTH,
    affine_from_bounds,
    col,
    image_grid_bounds,
    lonlat_extent,
    mercator_lat,
    mercator_lon,
    mercator_x,
    mercator_y,
    natural_zoom,
    pixel_resolution,
)


def target_resolution(zoom: Column | str, tile_dim: int) -> Column:
    """Metres per pixel of the tile grid."""
    return F.lit(WORLD_WIDTH) / (F.pow(F.lit(2.0), col(zoom)) * tile_dim)


def _around(low: Column, high: Column) -> Column:
    """Whole numbers that could have their centre between two edges, one to spare on each side."""
    return F.sequence(F.floor(low).cast("int") - 1, F.floor(high).cast("int") + 1)


def chunk_sample(source: DataFrame, keep: list[str], zoom: Column | str, tile_dim: int) -> DataFrame:
    """Source pixels in EPSG:3857 to pixels of the tile grid at ``zoom``.

    ``source`` has ``sx, sy`` (column and row in its image) and the image's ``left, top, res``.
    """
    res = target_resolution(zoom, tile_dim)
    half = WORLD_WIDTH / 2
    x0 = F.col("left") + F.col("sx") * F.col("res")
    y0 = F.col("top") - F.col("sy") * F.col("res")
    placed = source.withColumn("_res", res)
    xs = placed.withColumn("gx", F.explode(_around((x0 + half) / F.col("_res"), (x0 + F.col("res") + half) / F.col("_res"))))
    centre_x = (F.col("gx") + 0.5) * F.col("_res") - half
    xs = xs.where((F.floor((centre_x - F.col("left")) / F.col("res")) == F.col("sx")) & in_world("gx", zoom, tile_dim))
    ys = xs.withColumn("gy", F.explode(_around((F.lit(half) - y0) / F.col("_res"), (half - y0 + F.col("res")) / F.col("_res"))))
    centre_y = F.lit(half) - (F.col("gy") + 0.5) * F.col("_res")
    ys = ys.where((F.floor((F.col("top") - centre_y) / F.col("res")) == F.col("sy")) & in_world("gy", zoom, tile_dim))
    return ys.select(*keep, "gx", "gy", "r", "g", "b")


def in_world(g: str, zoom: Column | str, tile_dim: int) -> Column:
    return (F.col(g) >= 0) & (F.col(g) < F.pow(F.lit(2.0), col(zoom)) * tile_dim)


def reproject_image(source: DataFrame, keep: list[str]) -> DataFrame:
    """Source pixels in EPSG:4326 to an EPSG:3857 grid, with an alpha band.

    ``source`` has ``sx, sy`` and its image's ``lon0, lat0`` (north-west corner) and ``deg`` (degrees
    per pixel). The target grid starts at the projected corner with square pixels of ``res`` metres.
    """
    deg, res, left, top = F.col("deg"), F.col("res"), F.col("_left"), F.col("_top")
    placed = source.withColumn("_left", mercator_x("lon0")).withColumn("_top", mercator_y("lat0"))
    west = F.col("lon0") + F.col("sx") * deg
    north = F.col("lat0") - F.col("sy") * deg
    xs = placed.withColumn("tx", F.explode(_around((mercator_x(west) - left) / res, (mercator_x(west + deg) - left) / res)))
    lon = mercator_lon(left + (F.col("tx") + 0.5) * res)
    xs = xs.where((F.col("tx") >= 0) & (F.floor((lon - F.col("lon0")) / deg) == F.col("sx")))
    ys = xs.withColumn("ty", F.explode(_around((top - mercator_y(north)) / res, (top - mercator_y(north - deg)) / res)))
    lat = mercator_lat(top - (F.col("ty") + 0.5) * res)
    ys = ys.where((F.col("ty") >= 0) & (F.floor((F.col("lat0") - lat) / deg) == F.col("sy")))
    return ys.select(*keep, "tx", "ty", "r", "g", "b", F.lit(255).alias("alpha"))


def describe_image(sources: DataFrame, keep: list[str], tile_dim: int) -> DataFrame:
    """Metric bounds and size to degrees, resolution, natural zoom and tile rectangle.

    ``sources`` has ``left, bottom, right, top`` in EPSG:3857 and ``width, height`` in pixels.
    """
    metres = Extent(F.col("left"), F.col("bottom"), F.col("right"), F.col("top"))
    affine = affine_from_bounds(metres, F.col("width"), F.col("height"))
    degrees = sources.select(
        *keep, *lonlat_extent(metres).named(), pixel_resolution(affine.a, affine.e).alias("resolution")
    ).withColumn("zoom", natural_zoom("resolution", tile_dim))
    box = Extent(F.col("xmin"), F.col("ymin"), F.col("xmax"), F.col("ymax"))
    bounds: GridBounds = image_grid_bounds(box, "zoom")
    return degrees.select("*", *bounds.named())


def warped_grid(images: DataFrame) -> DataFrame:
    """Adds the EPSG:3857 grid of an EPSG:4326 image: its corner ``left, top`` and square ``res``.

    The resolution keeps the number of pixels along the diagonal.
    """
    left, top = mercator_x("lon0"), mercator_y("lat0")
    across = mercator_x(F.col("lon0") + F.col("width") * F.col("deg")) - left
    down = top - mercator_y(F.col("lat0") - F.col("height") * F.col("deg"))
    return images.select("*", left.alias("left"), top.alias("top"), (F.hypot(across, down) / F.hypot("width", "height")).alias("res"))

"""Every operator, run on the whole test tables. Keys match ``oracle.sql``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quiltmap import fixtures as fx
from quiltmap.functions import grid, pixels as px, ranking, uris
from quiltmap.operators import cover, inputs, mosaic, regrid, sample, tiles
from quiltmap.plans import pyramid as plans
from quiltmap.session import scratch_path
from quiltmap.sinks import documents as out_docs
from quiltmap.sinks.tiles import write_chunks
from quiltmap.sources import documents as in_docs
from quiltmap.sources import tiles as in_tiles

Query = Callable[[SparkSession, str], DataFrame]

JOB_IMAGES = 50  # images per job in the fixture
WINDOW = 10  # re-tiling window in pixels
DIGITS = 6

QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def rounded(c: Column, name: str, digits: int = DIGITS) -> Column:
    return F.round(c, digits).alias(name)


def rounded_all(t, digits: int = DIGITS) -> list[Column]:
    return [rounded(c, n, digits) for n, c in t._asdict().items()]


def rects(spark: SparkSession, sf: str) -> DataFrame:
    """Images with named bounds, a job, a source and a folder."""
    image = F.col("image_id").cast("string")
    job = F.floor(F.col("image_id") / JOB_IMAGES)
    return fx.images(spark, sf).select(
        "image_id",
        F.concat(F.lit("job-"), job.cast("string")).alias("job_id"),
        "ord",
        "priority",
        "zoom",
        *fx.grid_bounds().named(),
        F.concat(F.lit("s3://imagery/scene-"), image, F.lit(".tif")).alias("source_uri"),
        F.concat(F.lit("s3://workspace/scene-"), image).alias("folder"),
    )


def local_pixels(spark: SparkSession, sf: str) -> DataFrame:
    """Pixels with their place in the image, and the image's corner."""
    return fx.pixels(spark, sf, with_corner=True)


def covered(spark: SparkSession, sf: str) -> DataFrame:
    return cover.tile_cover(rects(spark, sf), ["image_id"], "folder", fx.TILE)


def chunk_pixels(spark: SparkSession, sf: str) -> DataFrame:
    key = [F.floor(F.col(g) / fx.TILE).cast("int").alias(n) for g, n in (("gx", "col"), ("gy", "row"))]
    return fx.pixels(spark, sf).select("image_id", "zoom", *key, "r", "g", "b")


def packed(spark: SparkSession, sf: str) -> DataFrame:
    """The pixel fixture as packed tiles."""
    return tiles.tile_assemble(fx.pixels(spark, sf), ["image_id", "priority", "zoom"], fx.TILE)


def stored(chunks: DataFrame, path: str | None = None) -> DataFrame:
    """Chunks as the chunk step leaves them: a table partitioned by zoom."""
    path = path or scratch_path(chunks.sparkSession, "chunks")
    write_chunks(chunks, path)
    return chunks.sparkSession.read.schema(chunks.schema).parquet(path)


# Sources


@query
def request_images(spark, sf):
    listed = rects(spark, sf).groupBy("job_id").agg(F.array_sort(F.collect_list(F.struct("ord", "source_uri"))).alias("i"))
    request = F.struct(
        F.col("job_id").alias("jobId"),
        F.concat(F.lit("s3://tiles/"), "job_id").alias("target"),
        F.transform("i", lambda i: i.source_uri).alias("images"),
        F.concat(F.lit("s3://workspace/"), "job_id").alias("workspace"),
    )
    return in_docs.request_images(listed.select(F.to_json(request).alias("value")))


def manifest_sources(spark, sf, job: Column) -> DataFrame:
    b = cover.row_bounds()
    nw, se = grid.tile_extent(b.col_min, b.row_min, "zoom"), grid.tile_extent(b.col_max, b.row_max, "zoom")
    extent = grid.Extent(nw.xmin, se.ymin, se.xmax, nw.ymax)
    placed = rects(spark, sf).select(job.alias("job_id"), "ord", "source_uri", "folder", "zoom", *b, *rounded_all(extent))
    return placed.select("*", F.lit("s3://tiles/out").alias("target"), F.lit(fx.TILE).alias("tile_size"))


@query
def manifest_inputs(spark, sf):
    return in_docs.manifest_inputs(out_docs.manifest_json(manifest_sources(spark, sf, F.lit("job"))))


@query
def manifest_json(spark, sf):
    records = out_docs.manifest_json(manifest_sources(spark, sf, F.col("job_id")))
    read = F.from_json("value", "position bigint, totalInputs bigint, input struct<sourceUri: string, zoom: int, tiles: string>")
    return records.select("job_id", read.alias("r")).select(
        "job_id", "r.position", F.col("r.totalInputs").alias("total"), F.col("r.input.sourceUri").alias("source_uri"), "r.input.zoom", "r.input.tiles"
    )


def stored_paths(spark, sf) -> DataFrame:
    """Paths as a listing shows them: each image's chunks, the level above, and folder markers."""
    own = covered(spark, sf).select("image_id", F.col("zoom").alias("image_zoom"), "path")
    above = rects(spark, sf).select(
        "image_id",
        F.col("zoom").alias("image_zoom"),
        (F.col("zoom") - 1).alias("zoom"),
        "folder",
        *grid.scaled_grid_bounds(cover.row_bounds(), -1).named(),
    )
    above = cover.tile_cover(above, ["image_id", "image_zoom"], "folder", fx.TILE).select("image_id", "image_zoom", "path")
    folders = rects(spark, sf).select("image_id", F.col("zoom").alias("image_zoom"), F.concat("folder", F.lit("/")).alias("path"))
    return mosaic.union_inputs([own, above, folders])


@query
def tile_index(spark, sf):
    return in_tiles.tile_index(stored_paths(spark, sf), 11, ["image_id"])


@query
def zoom_filter(spark, sf):
    return in_tiles.tile_index(stored_paths(spark, sf), F.col("image_zoom"), ["image_id"])


@query
def no_directories(spark, sf):
    return in_tiles.no_directories(stored_paths(spark, sf))


@query
def tile_scan(spark, sf):
    path = scratch_path(spark, "chunks")
    schema = stored(packed(spark, sf), path).schema
    return tiles.tile_explode(in_tiles.tile_scan(spark, path, schema, 11), ["image_id", "zoom"], fx.TILE)


REGION = (1024, 768, 1040, 799)


@query
def region_scan(spark, sf):
    path = scratch_path(spark, "chunks")
    schema = stored(packed(spark, sf), path).schema
    return tiles.tile_explode(in_tiles.region_scan(spark, path, schema, 11, REGION), ["image_id", "zoom"], fx.TILE)


# Scalar functions


@query
def natural_zoom(spark, sf):
    return fx.resolutions(spark, sf).select("p_partkey", grid.natural_zoom("res", grid.CHUNK_TILE).alias("zoom"))


@query
def pixel_resolution(spark, sf):
    res = F.col("res")
    e = F.when(F.col("p_partkey") % 2 == 0, -res * 1.5).otherwise(-res * 0.5)
    return fx.resolutions(spark, sf).select("p_partkey", rounded(grid.pixel_resolution(res, e), "resolution"))


@query
def lonlat_to_tile(spark, sf):
    c, r = grid.lonlat_to_tile("lon", "lat", F.lit(12))
    return fx.points(spark, sf).select("event_id", c.alias("col"), r.alias("row"))


@query
def tile_upper_left(spark, sf):
    lon, lat = grid.tile_upper_left("col_min", "row_min", "zoom")
    return fx.images(spark, sf).select("image_id", rounded(lon, "lon"), rounded(lat, "lat"))


@query
def tile_extent(spark, sf):
    return fx.images(spark, sf).select("image_id", *rounded_all(grid.tile_extent("col_min", "row_min", "zoom")))


@query
def lonlat_to_mercator(spark, sf):
    return fx.points(spark, sf).select(
        "event_id", rounded(grid.mercator_x("lon"), "x", 3), rounded(grid.mercator_y("lat"), "y", 3)
    )


@query
def tile_affine(spark, sf):
    return fx.images(spark, sf).select("image_id", *rounded_all(grid.tile_affine("col_min", "row_min", "zoom", 256), 4))


@query
def image_grid_bounds(spark, sf):
    box = grid.Extent(F.col("lon"), F.col("lat") - 0.5, F.col("lon") + 0.5, F.col("lat"))
    return fx.points(spark, sf).select("event_id", *grid.image_grid_bounds(box, F.lit(10)).named())


@query
def parent_key(spark, sf):
    c, r = grid.parent_key("col", "row")
    return covered(spark, sf).select("image_id", "col", "row", c.alias("parent_col"), r.alias("parent_row"))


@query
def morton_key(spark, sf):
    return covered(spark, sf).select("image_id", "col", "row", grid.morton_key("col", "row").alias("key"))


@query
def child_quadrant(spark, sf):
    c, r = grid.child_quadrant("col", "row")
    return covered(spark, sf).select("image_id", "col", "row", c.alias("right"), r.alias("lower"))


@query
def zoom_offset(spark, sf):
    size = (F.lit(256) * F.pow(F.lit(2), F.col("image_id") % 4)).cast("int")
    return fx.images(spark, sf).select("image_id", size.alias("tile_size"), grid.zoom_offset(size).alias("offset"))


@query
def scaled_grid_bounds(spark, sf):
    levels = (F.col("image_id") % 5 - 2).cast("int")
    return rects(spark, sf).select("image_id", levels.alias("levels"), *grid.scaled_grid_bounds(cover.row_bounds(), levels).named())


@query
def byte_normalize(spark, sf):
    value = F.col("r")
    signed = F.when((F.col("gx") + F.col("gy")) % 7 == 0, F.lit(None)).otherwise(F.when(value > 127, value - 256).otherwise(value))
    return fx.pixels(spark, sf).select("image_id", "gx", "gy", px.byte_normalize(signed).alias("value"))


@query
def rgba_pack(spark, sf):
    return mosaic.mosaic_merge(fx.pixels(spark, sf)).select("zoom", "gx", "gy", px.rgba_pack().alias("rgba"))


@query
def tile_path(spark, sf):
    return covered(spark, sf).select("image_id", grid.tile_path(F.lit("out"), "zoom", "col", "row", "png").alias("path"))


@query
def uri_parts(spark, sf):
    name = uris.uri_name("url")
    return fx.table(spark, sf, "pages").select(
        "page_id",
        name.alias("name"),
        uris.base_name(name).alias("base"),
        uris.piece_name("url", F.col("page_id") % 3, F.col("page_id") % 5).alias("piece"),
    )


@query
def remote_read_path(spark, sf):
    rest = F.regexp_replace("url", "^https?://", "")
    kind = F.col("page_id") % 3
    uri = F.when(kind == 0, F.concat(F.lit("s3://"), rest)).when(kind == 1, F.concat(F.lit("/data/"), rest)).otherwise(F.col("url"))
    return fx.table(spark, sf, "pages").select("page_id", uris.remote_read_path(uri).alias("path"))


@query
def grid_size(spark, sf):
    return rects(spark, sf).select("image_id", grid.grid_size(cover.row_bounds()).alias("tiles"))


# Filters and joins


@query
def nonempty_chunks(spark, sf):
    return cover.nonempty_chunks(chunk_pixels(spark, sf), ["image_id", "zoom", "col", "row"])


@query
def nonempty_tiles(spark, sf):
    return tiles.nonempty_tiles(packed(spark, sf), fx.TILE).select("image_id", "zoom", "col", "row")


@query
def world_clip(spark, sf):
    edge = (F.pow(F.lit(2), F.col("zoom")) - 1 - F.col("image_id") % 3).cast("int")
    at_edge = rects(spark, sf).select(
        "image_id",
        "zoom",
        edge.alias("col_min"),
        edge.alias("row_min"),
        (edge + F.col("col_max") - F.col("col_min")).alias("col_max"),
        (edge + F.col("row_max") - F.col("row_min")).alias("row_max"),
    )
    return at_edge.select("image_id", *grid.world_clip(cover.row_bounds(), "zoom").named())


@query
def extent_intersects(spark, sf):
    """Each covered tile against the parent of its image's first tile."""
    first = rects(spark, sf).select(
        "image_id", F.shiftright("col_min", 1).alias("pc"), F.shiftright("row_min", 1).alias("pr")
    )
    child = grid.tile_extent("col", "row", "zoom")
    parent = grid.tile_extent("pc", "pr", F.col("zoom") - 1)
    return covered(spark, sf).join(first, "image_id").select(
        "image_id", "col", "row", grid.extent_intersects(parent, child).alias("touches")
    )


@query
def valid_sources(spark, sf):
    chunks = cover.nonempty_chunks(chunk_pixels(spark, sf), ["image_id", "zoom", "col", "row"])
    return cover.valid_sources(rects(spark, sf), chunks, "image_id").select("image_id", "source_uri")


# Sampling


def metric_source(image_columns: DataFrame) -> DataFrame:
    """A raster in metres whose pixels are a quarter wider than the tile grid's, a little off its corner."""
    res = sample.target_resolution("zoom", fx.TILE)
    half = grid.WORLD_WIDTH / 2
    return image_columns.select(
        "*",
        ((F.col("col_min") * fx.TILE + 0.3) * res - half).alias("left"),
        (half - (F.col("row_min") * fx.TILE + 0.3) * res).alias("top"),
        (res * 1.25).alias("res"),
    )


@query
def chunk_sample(spark, sf):
    return sample.chunk_sample(metric_source(local_pixels(spark, sf)), ["image_id", "zoom"], "zoom", fx.TILE)


def image_blocks(spark, sf) -> DataFrame:
    """Each image's own tiles as stored blocks."""
    corner = fx.images(spark, sf).select("image_id", "col_min", "row_min")
    return packed(spark, sf).join(corner, "image_id").select(
        "image_id",
        "zoom",
        "col_min",
        "row_min",
        ((F.col("col") - F.col("col_min")) * fx.TILE).alias("x0"),
        ((F.col("row") - F.col("row_min")) * fx.TILE).alias("y0"),
        F.lit(fx.TILE).alias("width"),
        F.lit(fx.TILE).alias("height"),
        "bands",
    )


@query
def chunk_sample_tiles(spark, sf):
    windows = tiles.retile_blocks(image_blocks(spark, sf), ["image_id", "zoom", "col_min", "row_min"], WINDOW)
    chunks = tiles.sample_pieces(metric_source(windows), ["image_id"], fx.TILE)
    drawn = tiles.tile_explode(chunks.withColumn("priority", F.lit(0).cast("bigint")), ["image_id", "zoom"], fx.TILE)
    return drawn.drop("priority")


def degree_source(image_columns: DataFrame) -> DataFrame:
    """A raster in degrees from the image's corner, pixels a tenth wider than the tile grid's."""
    lon, lat = grid.tile_upper_left("col_min", "row_min", "zoom")
    return image_columns.select(
        "*",
        lon.alias("lon0"),
        lat.alias("lat0"),
        (F.lit(360.0) / F.pow(F.lit(2.0), "zoom") / fx.TILE * 1.1).alias("deg"),
        sample.target_resolution("zoom", fx.TILE).alias("res"),
    )


@query
def reproject_image(spark, sf):
    return sample.reproject_image(degree_source(local_pixels(spark, sf)), ["image_id"])


@query
def reproject_tiles(spark, sf):
    warped = tiles.reproject_blocks(degree_source(image_blocks(spark, sf)), ["image_id"])
    drawn = tiles.piece_pixels(warped, ["image_id"], ["r", "g", "b", "alpha"]).where(px.has_data())
    return drawn.withColumnsRenamed({"x": "tx", "y": "ty"})


@query
def describe_image(spark, sf):
    res = 0.5 + F.col("event_id") % 400 / 4.0
    shaped = fx.points(spark, sf).select(
        "event_id",
        grid.mercator_x("lon").alias("left"),
        grid.mercator_y("lat").alias("top"),
        (1000 + F.col("event_id") % 1000).alias("width"),
        (800 + F.col("event_id") % 900).alias("height"),
        res.alias("res"),
    )
    placed = shaped.withColumn("right", F.col("left") + F.col("width") * F.col("res")).withColumn(
        "bottom", F.col("top") - F.col("height") * F.col("res")
    )
    described = sample.describe_image(placed, ["event_id"], grid.CHUNK_TILE)
    return described.select(
        "event_id",
        *[rounded(F.col(c), c) for c in ("xmin", "ymin", "xmax", "ymax", "resolution")],
        "zoom",
        "col_min",
        "row_min",
        "col_max",
        "row_max",
    )


# Generators


@query
def tile_cover(spark, sf):
    return covered(spark, sf).select(
        "image_id", "zoom", "col", "row", "path", rounded(F.col("transform.c"), "left", 3), rounded(F.col("transform.f"), "top", 3)
    )


def with_uri(df: DataFrame) -> DataFrame:
    return df.withColumn("source_uri", F.concat(F.lit("s3://imagery/scene-"), F.col("image_id").cast("string"), F.lit(".tif")))


@query
def retile(spark, sf):
    return regrid.retile(with_uri(local_pixels(spark, sf)), ["image_id"], "source_uri", WINDOW)


@query
def retile_tiles(spark, sf):
    windows = tiles.retile_blocks(image_blocks(spark, sf), ["image_id"], WINDOW)
    return tiles.piece_pixels(windows, ["image_id", "piece_col", "piece_row"], ["r", "g", "b"])


@query
def split_tiles(spark, sf):
    return regrid.split_tiles(fx.pixels(spark, sf), ["image_id"], 2, fx.TILE // 2)


@query
def split_tiles_packed(spark, sf):
    small = tiles.split_packed(packed(spark, sf), 2)
    side = fx.TILE // 2
    return tiles.tile_explode(small, ["image_id", "zoom"], side).select(
        "image_id",
        "zoom",
        F.floor(F.col("gx") / side).cast("int").alias("col"),
        F.floor(F.col("gy") / side).cast("int").alias("row"),
        F.pmod("gx", F.lit(side)).alias("x"),
        F.pmod("gy", F.lit(side)).alias("y"),
        "r",
        "g",
        "b",
    )


@query
def tile_explode(spark, sf):
    rows = tiles.tile_explode(fx.packed_tiles(spark, sf), ["image_id"], fx.TILE, ["value"])
    return rows.select("image_id", "gx", "gy", "value")


@query
def tile_assemble(spark, sf):
    rows = tiles.tile_explode(fx.packed_tiles(spark, sf), ["image_id"], fx.TILE, ["value"])
    return tiles.tile_assemble(rows, ["image_id"], fx.TILE, ["value"]).select(
        "image_id", "col", "row", F.lower(F.hex(F.col("bands")[0])).alias("bytes")
    )


# Aggregations


@query
def mosaic_merge(spark, sf):
    return mosaic.mosaic_merge(fx.pixels(spark, sf))


@query
def mosaic_merge_tiles(spark, sf):
    return tiles.tile_explode(tiles.mosaic_merge_tiles(stored(packed(spark, sf)), fx.TILE), ["zoom"], fx.TILE)


@query
def zoom_up(spark, sf):
    return mosaic.zoom_up(mosaic.mosaic_merge(fx.pixels(spark, sf)))


@query
def zoom_up_tiles(spark, sf):
    merged = tiles.mosaic_merge_tiles(stored(packed(spark, sf)), fx.TILE)
    return tiles.tile_explode(tiles.zoom_up_tiles(merged, fx.TILE), ["zoom"], fx.TILE)


@query
def order_down(spark, sf):
    return mosaic.order_down(mosaic.mosaic_merge(fx.pixels(spark, sf)))


@query
def pyramid(spark, sf):
    return plans.pyramid(fx.pixels(spark, sf))


@query
def pyramid_tiles(spark, sf):
    return tiles.tile_explode(plans.pyramid_tiles(stored(packed(spark, sf)), fx.TILE), ["zoom"], fx.TILE)


@query
def tile_counts_unmerged(spark, sf):
    return cover.tile_counts_unmerged(rects(spark, sf))


@query
def tile_counts_merged(spark, sf):
    return cover.tile_counts_merged(rects(spark, sf))


@query
def chunk_stats(spark, sf):
    return cover.chunk_stats(covered(spark, sf), "image_id")


@query
def collect_image_sources(spark, sf):
    pieces = rects(spark, sf).select("image_id", "source_uri", F.explode(F.sequence("col_min", "col_max")).alias("c"), "row_min", "row_max")
    halves = pieces.select("image_id", "source_uri", F.col("c").alias("col_min"), "row_min", F.col("c").alias("col_max"), "row_max")
    return inputs.collect_image_sources(halves, ["image_id", "source_uri"])


@query
def group_by_zoom(spark, sf):
    return inputs.group_by_zoom(rects(spark, sf))


@query
def distinct_sources(spark, sf):
    return inputs.distinct_sources(with_uri(chunk_pixels(spark, sf)))


@query
def max_zoom(spark, sf):
    return inputs.max_zoom(rects(spark, sf))


@query
def zoom_plan(spark, sf):
    return plans.zoom_plan(rects(spark, sf))


@query
def order_inputs(spark, sf):
    return inputs.order_inputs(rects(spark, sf)).select("job_id", "ord", "source_uri")


@query
def priority_rank(spark, sf):
    return inputs.priority_rank(rects(spark, sf).drop("priority")).select("job_id", "ord", "position", "priority")


@query
def carried_rank(spark, sf):
    windows = F.col("row") % 97 * ranking.PIECES_ACROSS + F.col("col") % 89
    pieces = covered(spark, sf).join(rects(spark, sf).select("image_id", "ord"), "image_id").select("image_id", "ord", "col", "row", windows.alias("piece_index"))
    return pieces.select("image_id", "col", "row", "piece_index", ranking.carried_rank("ord", "piece_index").alias("rank"))


@query
def union_inputs(spark, sf):
    source = fx.pixels(spark, sf)
    native = source.select("zoom", "gx", "gy", "r", "g", "b", "priority")
    return mosaic.union_inputs([native, mosaic.zoom_up(mosaic.mosaic_merge(source))])


@query
def distinct_tiles(spark, sf):
    return cover.distinct_tiles(rects(spark, sf))


@query
def distinct_bounds(spark, sf):
    return cover.distinct_bounds(rects(spark, sf))


@query
def job_status(spark, sf):
    kind = F.col("event_type")
    status = F.when(kind == "error", "FAILED").when(kind == "purchase", "FINISHED").otherwise("STARTED")
    step = F.when(F.col("event_id") % 2 == 0, "chunk").otherwise("mosaic")
    records = fx.table(spark, sf, "events").select(
        F.col("user_id").alias("job_id"), step.alias("stage"), status.alias("status"), "ts", "event_id"
    )
    return out_docs.latest_status(records, ["job_id", "stage"], ["ts", "event_id"], ["status", "event_id"])

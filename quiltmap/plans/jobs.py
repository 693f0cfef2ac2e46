"""The two steps end to end: chunk a request's images, mosaic the chunks, or both.

Rasters enter as two tables. ``images``: one row per image, ``source_uri, crs, width, height`` with
``left, top, res`` (EPSG:3857) or ``lon0, lat0, deg`` (EPSG:4326). ``blocks``: any cutting of its
pixels, ``source_uri, x0, y0, width, height, bands``, each block small enough for one row.
"""

from __future__ import annotations

import traceback
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quiltmap.functions.grid import CHUNK_TILE, OUTPUT_TILE, RETILE_WINDOW
from quiltmap.functions.ranking import PIECES_ACROSS, carried_rank, with_position
from quiltmap.functions.uris import piece_name
from quiltmap.operators.cover import valid_sources
from quiltmap.operators.sample import describe_image, warped_grid
from quiltmap.operators.tiles import retile_blocks, sample_pieces
from quiltmap.plans.pyramid import pyramid_tiles
from quiltmap.session import job_folder, removed, resolved, scratch_path, written_at
from quiltmap.sinks.documents import append_images, append_status, write_manifest
from quiltmap.sinks.tiles import pyramid_export, write_chunks
from quiltmap.sources.documents import manifest_inputs, read_documents, read_manifest, request_images

CHUNKS = (
    "source_uri string, folder string, ord bigint, piece_index bigint, "
    "zoom int, col int, row int, bands array<binary>, job_id string"
)
COLOURS = 3


def one_job(frame: DataFrame, *names: str, none: str):
    """The one job of a frame; a call runs one, and says so where there are more."""
    found = frame.select(*names).distinct().take(2)
    if not found:
        raise ValueError(none)
    if len(found) > 1:
        raise ValueError(f"one job at a time: got {', '.join(r[0] for r in found)}")
    return found[0]


@contextmanager
def stage(spark: SparkSession, status: str | None, job_id: str, name: str, target: str):
    """Records the start and the end of a step, if a job_status table is given."""
    if status is None:
        yield
        return
    append_status(spark, status, job_id, name, "STARTED")
    try:
        yield
    except Exception as e:
        append_status(spark, status, job_id, name, "FAILED", error=f"{type(e).__name__}: {e}", stack=traceback.format_exc())
        raise
    append_status(spark, status, job_id, name, "FINISHED", target=target)


def check_images(requested: DataFrame, images: DataFrame) -> None:
    """Refuses a request that lists an image without a raster, with two, or in a system that is not supported."""
    for row in requested.join(images, "source_uri", "left_semi").select("source_uri").distinct().join(images.groupBy("source_uri").count(), "source_uri").where("count > 1").take(1):
        raise ValueError(f"two rasters for {row.source_uri}")
    found = requested.join(images.select("source_uri", "crs"), "source_uri", "left")
    supported = F.coalesce(F.col("crs").isin("EPSG:3857", "EPSG:4326"), F.lit(False))
    for row in found.where(~supported).select("source_uri", "crs").take(1):
        raise ValueError(f"no raster for {row.source_uri}" if row.crs is None else f"unsupported crs {row.crs} of {row.source_uri}")


def pieces_of(requested: DataFrame, images: DataFrame, blocks: DataFrame, window: int) -> DataFrame:
    """The requested images in metres, cut into windows. The blocks are read once."""
    known = requested.join(images, "source_uri")
    metric = known.where(F.col("crs") == "EPSG:3857").withColumns({c: F.lit(None).cast("double") for c in ("lon0", "lat0", "deg")})
    degrees = warped_grid(known.where(F.col("crs") == "EPSG:4326").drop("left", "top", "res"))
    keep = ["job_id", "ord", "source_uri", "left", "top", "res"]
    placed = metric.select(*keep, "lon0", "lat0", "deg").unionByName(degrees.select(*keep, "lon0", "lat0", "deg"))
    few = F.raise_error(F.concat(F.lit("fewer than three bands in "), "source_uri")).cast("array<binary>")
    drawn = blocks.join(placed, "source_uri").withColumn("bands", F.when(F.size("bands") >= COLOURS, F.col("bands")).otherwise(few))
    pieces = retile_blocks(drawn, keep, window, reproject=True)
    return pieces.select(
        "job_id",
        "ord",
        (F.col("piece_row") * F.lit(PIECES_ACROSS).cast("bigint") + F.col("piece_col")).alias("piece_index"),
        "source_uri",
        piece_name("source_uri", "piece_row", "piece_col").alias("folder"),
        "left",
        "top",
        "x0",
        "y0",
        "res",
        "width",
        "height",
        "bands",
    )


def chunk(
    requests: DataFrame,
    images: DataFrame,
    blocks: DataFrame,
    tile_dim: int = CHUNK_TILE,
    window: int = RETILE_WINDOW,
    status: str | None = None,
) -> str:
    """Runs one request (JSON in ``value``); writes its chunks and manifest below its workspace, in folders of the job.

    Returns the manifest's path. A second run of the job replaces both; other jobs of the workspace stay.
    """
    spark = requests.sparkSession
    requested = request_images(requests)
    job = one_job(requested, "job_id", "target", "workspace", none="the request lists no images")
    chunks_path, manifest = job_folder(f"{job.workspace}/chunks", job.job_id), job_folder(f"{job.workspace}/manifest", job.job_id)
    with stage(spark, status, job.job_id, "chunk", job.target):
        listed = requested.select("job_id", "ord", "source_uri")
        check_images(listed, images)
        scratch = scratch_path(spark, "pieces")
        pieces = written_at(pieces_of(listed, images, blocks, window), scratch)
        own = ["job_id", "ord", "piece_index", "source_uri", "folder"]
        corner = {
            "left": F.col("left") + F.col("x0") * F.col("res"),
            "top": F.col("top") - F.col("y0") * F.col("res"),
            "right": F.col("left") + (F.col("x0") + F.col("width")) * F.col("res"),
            "bottom": F.col("top") - (F.col("y0") + F.col("height")) * F.col("res"),
        }
        placed = pieces.withColumns({"image_left": F.col("left"), "image_top": F.col("top"), **corner})
        sources = describe_image(placed.drop("bands"), own, tile_dim)
        zoomed = describe_image(placed, [*own, "image_left", "image_top", "x0", "y0", "res", "width", "height", "bands"], tile_dim)
        sampled = zoomed.drop("left", "top").withColumnsRenamed({"image_left": "left", "image_top": "top"})
        write_chunks(sample_pieces(sampled, own[1:], tile_dim), chunks_path)
        filled = spark.read.schema(CHUNKS).parquet(chunks_path)
        kept = valid_sources(sources, filled, "source_uri", "folder").select("*", F.lit(job.target).alias("target"), F.lit(tile_dim).alias("tile_size"))
        write_manifest(kept, manifest, tie="piece_index")
        removed(spark, scratch)
    return manifest


def read_chunks(spark: SparkSession, workspace: str) -> DataFrame:
    """The chunks of all jobs of a workspace."""
    return spark.read.schema(CHUNKS).parquet(f"{workspace}/chunks")


def with_priority(chunks: DataFrame, inputs: DataFrame) -> DataFrame:
    """Chunks of the manifest's inputs, at the inputs' zoom, each with at least three bands.

    Chunks carry their place in the request. Where the manifest lists them all in that order, as the chunk step
    writes it, the place is the priority and no band is moved; that is settled on the chunks' keys alone. A
    manifest that was changed is joined instead. An input without chunks fails the job.
    """
    spark = chunks.sparkSession
    ranks = inputs.select("job_id", "source_uri", F.col("tiles").alias("folder"), "zoom", "position", "priority")
    key = ["job_id", "source_uri", "folder", "zoom"]
    scratch = scratch_path(spark, "chunk-keys")
    pieces = written_at(chunks.select(*key, "ord", "piece_index").distinct(), scratch)
    for row in ranks.join(pieces, key, "left_anti").take(1):
        removed(spark, scratch)
        raise ValueError(f"no chunks for {row.source_uri} in {row.folder} at zoom {row.zoom}")
    as_listed = in_request_order(pieces, ranks, key)
    removed(spark, scratch)
    few = F.raise_error(F.concat(F.lit("fewer than three bands in "), "folder")).cast("array<binary>")
    bands = F.when(F.size("bands") >= COLOURS, F.col("bands")).otherwise(few)
    ranked = chunks.withColumn("priority", carried_rank("ord", "piece_index")) if as_listed else chunks.join(ranks.drop("position"), key)
    return ranked.withColumn("bands", bands)


def in_request_order(pieces: DataFrame, ranks: DataFrame, key: list[str]) -> bool:
    """Whether the manifest lists every piece once, in the order of ``ord, piece_index``."""
    placed = with_position(pieces, "job_id", "ord", "piece_index", position="request_place", total="request_size")
    agrees = (F.col("request_place") == F.col("position")) & carried_rank("ord", "piece_index").isNotNull()
    same = placed.join(ranks, key).agg(F.count_if(agrees).alias("n")).first().n
    return same == pieces.count() == ranks.count()


def mosaic(
    manifest: DataFrame,
    chunks: DataFrame,
    output_tile: int = OUTPUT_TILE,
    export: bool = True,
    status: str | None = None,
) -> DataFrame:
    """Runs one job's manifest (JSON in ``value``); saves the pyramid and its PNG files below the target.

    Both replace what an earlier run left there, the pyramid only once it is complete and files only once all are
    written. A run that was interrupted is taken up where it stopped, unless its chunks were written anew.
    """
    spark = manifest.sparkSession
    inputs = manifest_inputs(manifest)
    job = one_job(inputs, "job_id", "target", "tile_size", none="the manifest lists no inputs")
    across, rest = divmod(job.tile_size, output_tile)
    if rest or across < 1 or across & (across - 1):
        raise ValueError(f"tileSize must be {output_tile} times a power of two, got {job.tile_size}")
    with stage(spark, status, job.job_id, "mosaic", job.target):
        colours = F.slice("bands", 1, COLOURS).alias("bands")
        own = chunks.where(F.col("job_id") == job.job_id)
        tiles = with_priority(own, inputs).select("zoom", "col", "row", "priority", colours)
        version = inputs.agg(F.bit_xor(F.xxhash64("source_uri", "tiles", "zoom", "position"))).first()[0]
        levels = pyramid_tiles(tiles, output_tile, across, path=f"{job.target}/levels", orders=False, version=version)
        if export:
            pyramid_export(levels, resolved(spark, f"{job.target}/png"), output_tile)
        if status is not None:
            append_images(inputs, status)
    return levels


def run(
    spark: SparkSession,
    request: str,
    images: DataFrame,
    blocks: DataFrame,
    tile_dim: int = CHUNK_TILE,
    output_tile: int = OUTPUT_TILE,
    window: int = RETILE_WINDOW,
    export: bool = True,
    status: str | None = None,
) -> DataFrame:
    """Both steps for the request document at a path."""
    manifest = chunk(read_documents(spark, request), images, blocks, tile_dim, window, status)
    chunks = read_chunks(spark, manifest.rpartition("/manifest/")[0])
    return mosaic(read_manifest(spark, manifest), chunks, output_tile, export, status)

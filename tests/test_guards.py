"""What operators refuse, and sizes of what they move."""

import numpy as np
import pytest

from quiltmap.functions import uris
from quiltmap.functions.grid import WORLD_WIDTH
from quiltmap.operators import kernels, mosaic, tiles
from quiltmap.plans.pyramid import pyramid_tiles

TILES = "zoom int, col int, row int, priority bigint, bands array<binary>"


def test_a_chunk_at_zoom_zero_has_its_place(spark):
    df = spark.createDataFrame([(0, 0, 0, 1, [bytes([9]) * 64] * 3)], TILES)
    assert {r.zoom for r in pyramid_tiles(df, 2, across=4).collect()} == {1, 2}
    with pytest.raises(ValueError, match="zoom 0"):
        pyramid_tiles(df, 8)


def test_halved_tiles_are_a_quarter_of_their_size(spark):
    df = spark.createDataFrame([(5, 3, 2, 1, [bytes([9]) * 64] * 3)], TILES)
    (row,) = tiles.halve_tiles(tiles.as_merged(df), 8).collect()
    assert (row.zoom, row.col, row.row) == (5, 3, 2) and {len(b) for b in row.bands} == {16}
    (up,) = tiles.zoom_up_tiles(tiles.as_merged(df), 8).collect()
    assert (up.zoom, up.col, up.row) == (4, 1, 1) and {len(b) for b in up.bands} == {64}


def test_busy_keys_are_merged_where_they_are_read(spark):
    rows = [(9, 5, 5, i, [bytes([1 + i % 200]) * 16] * 3) for i in range(600)] + [(9, c, 1, 7, [bytes([c]) * 16] * 3) for c in range(1, 40)]
    df = spark.createDataFrame(rows, TILES).repartition(4)
    left = tiles.combined(tiles.as_merged(df), held=8)
    assert left.where("col = 5 AND row = 5").count() <= 4 and left.where("row = 1").count() == 39
    merged = tiles.mosaic_merge_tiles(df, 4, held=8)
    plan = merged._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 1 and "Join" not in plan and "Union" not in plan
    got = {(r.col, r.row): r.bands[0][0] for r in merged.collect()}
    assert got == {(5, 5): 1 + 599 % 200} | {(c, 1): c for c in range(1, 40)}


@pytest.mark.parametrize("inputs, size", [(3, 1), (200, 1), (300, 2), (1 << 16, 2)])
def test_orders_take_one_or_two_bytes_a_pixel(inputs, size):
    dim = 256
    rng = np.random.default_rng(inputs)
    priority = rng.integers(0, inputs, (1, dim * dim)) * 7919
    priority[0, : min(inputs, dim * dim - 9)] = np.arange(min(inputs, dim * dim - 9)) * 7919
    canvas = np.where(np.arange(dim * dim) < dim * dim - 5, priority << 8 | 9, kernels.EMPTY).repeat(3, axis=0)
    tile = kernels.merged_tile((5, 1, 1), canvas)
    assert [len(o) for o in tile["orders"]] == [size * dim * dim]
    assert (kernels.ranked(tile) == canvas).all()


def test_far_apart_priorities_keep_their_places():
    canvas = np.array([[(1 << 50) << 8 | 1, 3 << 8 | 2, kernels.EMPTY, (1 << 50) << 8 | 3]])
    tile = kernels.merged_tile((5, 1, 1), canvas)
    assert (kernels.ranked(tile) == canvas).all() and len(tile["orders"][0]) == 4


def test_data_needs_a_priority_in_both_forms(spark):
    df = spark.createDataFrame([(5, 3, 2, None, [bytes([9]) * 16] * 3), (5, 3, 2, 1, [bytes([8]) * 16] * 3)], TILES)
    with pytest.raises(Exception, match="no priority"):
        tiles.mosaic_merge_tiles(df, 4).collect()
    pixels = spark.createDataFrame([(5, 0, 0, 1, 2, 3, None)], "zoom int, gx int, gy int, r int, g int, b int, priority bigint")
    with pytest.raises(Exception, match="no priority"):
        mosaic.mosaic_merge(pixels).collect()


def test_tiles_of_different_bands_do_not_mix(spark):
    df = spark.createDataFrame([(5, 3, 2, 2, [bytes([9]) * 16] * 3), (5, 3, 2, 1, [bytes([8]) * 16])], TILES)
    with pytest.raises(Exception, match="differ in bands"):
        tiles.mosaic_merge_tiles(df, 4).collect()


def test_pixels_past_32_bits_are_refused(spark):
    df = spark.createDataFrame([(30, 1 << 29, 0, 1, [bytes([9]) * 64] * 3)], TILES)
    with pytest.raises(Exception, match="32 bits"):
        tiles.tile_explode(df, ["zoom"], 8).collect()


@pytest.mark.parametrize("uri", ["file:/data/x.tif", "hdfs:/a/b.tif", "ftp://h/x.tif"])
def test_unknown_schemes_fail(spark, uri):
    with pytest.raises(Exception, match="Unsupported scheme"):
        spark.createDataFrame([(uri,)], "u string").select(uris.remote_read_path("u")).collect()


@pytest.mark.parametrize("shift", [0.5, 0.25, 1 / 3])
def test_windows_of_an_image_claim_each_pixel_once(spark, shift):
    """Windows cut from one image give the tiles of the uncut image, also where centres fall on their edges."""
    dim, size, window = 8, 23, 5
    target = WORLD_WIDTH / (2.0**9 * dim)
    left, top = -WORLD_WIDTH / 2 + (100 * dim + shift) * target, WORLD_WIDTH / 2 - (90 * dim + shift) * target
    values = np.random.default_rng(1).integers(1, 256, (3, size, size), dtype=np.uint8)
    shape = "zoom int, left double, top double, x0 int, y0 int, res double, width int, height int, bands array<binary>"

    def pieces(step):
        for y in range(0, size, step):
            for x in range(0, size, step):
                part = values[:, y : y + step, x : x + step]
                yield 9, left, top, x, y, target, part.shape[2], part.shape[1], [np.ascontiguousarray(b).tobytes() for b in part]

    def pixels(step):
        cut = tiles.sample_pieces(spark.createDataFrame(list(pieces(step)), shape), [], dim)
        rows = tiles.tile_explode(cut.selectExpr("zoom", "col", "row", "1L AS priority", "bands"), ["zoom"], dim)
        return sorted((r.gx, r.gy, r.r, r.g, r.b) for r in rows.collect())

    assert pixels(window) == pixels(size)

"""One test per rule on which the original was ambiguous, wrong or silent."""


import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import brute
from quiltmap.functions import grid, pixels as px, uris
from quiltmap.operators import cover, mosaic, tiles
from quiltmap.plans.pyramid import pyramid, pyramid_tiles, zoom_plan
from quiltmap.sources.documents import manifest_inputs, request_images
from quiltmap.sources.tiles import tile_index
from test_reference_cases import as_documents, manifest

PIXELS = "image_id bigint, priority bigint, zoom int, gx int, gy int, r int, g int, b int"
COLUMNS = ["zoom", "gx", "gy", "r", "g", "b", "priority"]


def frame(spark, rows, zoom=3):
    """(gx, gy, bands, priority) rows of one zoom"""
    return spark.createDataFrame([(i, p, zoom, gx, gy, *c) for i, (gx, gy, c, p) in enumerate(rows)], PIXELS)


def collected(df):
    return {tuple(r) for r in df.select(*COLUMNS).collect()}


def both_merges(spark, rows):
    df = frame(spark, rows)
    packed = tiles.tile_assemble(df, ["image_id", "priority", "zoom"], 4)
    pixel = {r for r in collected(mosaic.mosaic_merge(df)) if any(r[3:6])}
    tile = collected(tiles.tile_explode(tiles.mosaic_merge_tiles(packed, 4), ["zoom"], 4))
    assert pixel == tile
    return pixel


def test_equal_priority_takes_the_larger_value(spark):
    assert both_merges(spark, [(0, 0, (5, 0, 9), 1), (0, 0, (7, 2, 3), 1)]) == {(3, 0, 0, 7, 2, 9, 1)}


def test_bands_merge_separately(spark):
    rows = [(1, 1, (9, 9, 9), 0), (1, 1, (5, 5, 5), 1), (1, 1, (7, 7, 0), 2)]
    assert both_merges(spark, rows) == {(3, 1, 1, 7, 7, 5, 2)}


def test_blank_pixel_stays_blank(spark):
    assert collected(mosaic.mosaic_merge(frame(spark, [(0, 0, (0, 0, 0), 4)]))) == {(3, 0, 0, 0, 0, 0, None)}


def test_parent_is_rounded_mean_of_data_under_top_priority(spark):
    rows = [(0, 0, (1, 10, 0), 3), (1, 0, (2, 0, 0), 8), (0, 1, (0, 0, 0), 9)]
    up = mosaic.zoom_up(mosaic.mosaic_merge(frame(spark, rows)))
    assert collected(up) == {(2, 0, 0, 2, 10, 0, 8)}


def test_deeper_tile_keeps_one_priority_per_pixel(spark):
    """The level above sees the pixel under one priority, even where its bands came from two inputs."""
    deep = frame(spark, [(2, 2, (9, 0, 0), 5), (2, 2, (0, 8, 8), 1)], zoom=4)
    own = frame(spark, [(1, 1, (4, 4, 4), 3)], zoom=3)
    want = brute.pyramid({4: [(2, 2, (9, 0, 0), 5), (2, 2, (0, 8, 8), 1)], 3: [(1, 1, (4, 4, 4), 3)]})
    assert want[3][1, 1] == ((9, 8, 8), 5)
    both = deep.unionByName(own)
    expected = {(z, x, y, *c, p) for z, level in want.items() for (x, y), (c, p) in level.items()}
    assert collected(pyramid(both)) == collected(pyramid(both, stage=False)) == expected
    packed = tiles.tile_assemble(both, ["image_id", "priority", "zoom"], 4)
    assert collected(tiles.tile_explode(pyramid_tiles(packed, 4), ["zoom"], 4)) == expected


def test_split_bounds_go_deeper(spark):
    b = grid.GridBounds(F.lit(3), F.lit(5), F.lit(4), F.lit(5))
    assert spark.range(1).select(*grid.scaled_grid_bounds(b, 2).named()).first() == (12, 20, 19, 23)
    assert spark.range(1).select(*grid.scaled_grid_bounds(b, -1).named()).first() == (1, 2, 2, 2)


def test_zoom_one_is_kept_and_zoom_zero_refused(spark):
    assert collected(pyramid(frame(spark, [(0, 0, (1, 2, 3), 0)], zoom=1))) == {(1, 0, 0, 1, 2, 3, 0)}
    with pytest.raises(ValueError, match="zoom 0"):
        pyramid(frame(spark, [(0, 0, (1, 2, 3), 0)], zoom=0))
    zooms = spark.createDataFrame([(12,), (7,), (12,)], "zoom int")
    assert {tuple(r) for r in zoom_plan(zooms).collect()} == {(12, 7), (7, 1)}


@pytest.mark.parametrize("field", ["jobId", "target", "tileSize", "input"])
def test_manifest_needs_its_fields(spark, field):
    doc = manifest()
    del doc[field]
    with pytest.raises(PySparkException, match="a manifest needs"):
        manifest_inputs(as_documents(spark, doc)).count()


@pytest.mark.parametrize("field", ["sourceUri", "zoom", "gridBounds", "tiles"])
def test_manifest_input_needs_its_fields(spark, field):
    doc = manifest()
    del doc["input"][1][field]
    inputs = manifest_inputs(as_documents(spark, doc))
    for use in (inputs, inputs.where("tiles is not null and zoom > 0"), inputs.join(spark.range(9).withColumnRenamed("id", "zoom"), "zoom")):
        with pytest.raises(PySparkException, match="a manifest input needs"):
            use.count()


def test_request_order_and_fields(spark):
    good = {"jobId": "j", "target": "/t", "images": ["a", "b"], "workspace": "/w"}
    assert [(r.ord, r.source_uri) for r in request_images(as_documents(spark, good)).collect()] == [(0, "a"), (1, "b")]
    with pytest.raises(PySparkException, match="a job request needs"):
        request_images(as_documents(spark, {k: v for k, v in good.items() if k != "images"})).count()
    with pytest.raises(PySparkException, match="a job request needs"):
        request_images(spark.createDataFrame([("not json",)], "value string")).count()


def test_non_empty_counts_alpha(spark):
    rows = [(0, 0, 0, 0, 0, 255), (0, 1, 0, 0, 0, 0), (0, 2, 0, 3, 0, 0)]
    df = spark.createDataFrame(rows, "image_id int, col int, r int, g int, b int, alpha int")
    kept = lambda bands: {r.col for r in cover.nonempty_chunks(df, ["image_id", "col"], bands).collect()}
    assert kept(("r", "g", "b")) == {2}
    assert kept(("r", "g", "b", "alpha")) == {0, 2}
    packed = spark.createDataFrame([(i, [bytes(3) + bytes([v])] * 3) for i, v in enumerate([0, 7])], "i int, bands array<binary>")
    assert [r.i for r in tiles.nonempty_tiles(packed, 2).collect()] == [1]


def test_black_is_transparent(spark):
    df = spark.createDataFrame([(0, 0, 0), (255, 1, 0), (0, 0, 1)], "r int, g int, b int")
    assert [r[0] for r in df.select(px.rgba_pack()).collect()] == [0, 0xFF0100FF, 0x000001FF]


def test_signed_bytes(spark):
    df = spark.createDataFrame([(-1,), (-128,), (0,), (127,), (None,)], "v int")
    assert [r[0] for r in df.select(px.byte_normalize("v")).collect()] == [255, 128, 0, 127, 128]


def test_schemes(spark):
    uri = ["s3://bucket/a/b.tif", "http://h/x.tif", "https://h/x.tif", "/local/x.tif"]
    df = spark.createDataFrame([(u,) for u in uri], "u string")
    assert [r[0] for r in df.select(uris.remote_read_path("u")).collect()] == [
        "/vsicurl/http://bucket.s3.amazonaws.com/a/b.tif",
        "/vsicurl/http://h/x.tif",
        "/vsicurl/https://h/x.tif",
        "/local/x.tif",
    ]
    with pytest.raises(PySparkException, match="Unsupported scheme: ftp"):
        spark.createDataFrame([("ftp://h/x",)], "u string").select(uris.remote_read_path("u")).collect()


def test_names(spark):
    cases = {
        "s3://bucket/a/b.tif": "bucket/a/b",
        "http://host.example.com/a.b/c": "host.example.com/a.b/c",
        "http://host/a/.hidden": "host/a/.hidden",
        "http://host/x.tar.gz?q=1.2#f": "host/x.tar",
        "/data/x.TIF": "data/x",
        "http://host.example.com": "host.example.com/",
    }
    df = spark.createDataFrame([(u,) for u in cases], "u string")
    assert [r[0] for r in df.select(uris.uri_name("u")).collect()] == list(cases.values())


def test_natural_zoom_threshold(spark):
    base = grid.WORLD_WIDTH / 1024
    res = [base / 2**z for z in (10.0, 10.19, 10.21, 10.99, 0.1)]
    df = spark.createDataFrame([(r,) for r in res], "r double")
    assert [r[0] for r in df.select(grid.natural_zoom("r", 1024)).collect()] == [10, 10, 11, 11, 0]


@pytest.mark.parametrize("size", [128, 300, 768])
def test_tile_size_must_fit(spark, size):
    with pytest.raises(PySparkException, match="tileSize must be"):
        spark.range(1).select(grid.zoom_offset(F.lit(size))).collect()


def test_paths_of_other_folders_and_zooms_do_not_match(spark):
    paths = ["a/1/12/3/4.tif", "a/1/11/3/4.tif", "a/1/12/x/4.tif", "a/1/12/3/", "12/3/4.png"]
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    assert {tuple(r) for r in tile_index(df, 12).collect()} == {(12, 3, 4, "a/1/12/3/4.tif")}


def test_a_second_run_replaces_the_first(spark, tmp_path):
    df = frame(spark, [(5, 6, (1, 2, 3), 0)], zoom=6)
    packed = tiles.tile_assemble(df, ["image_id", "priority", "zoom"], 4)
    for _ in range(2):
        assert pyramid(df, path=str(tmp_path / "pixels")).count() == 6
        assert pyramid_tiles(packed, 4, path=str(tmp_path / "tiles")).count() == 6
    assert pyramid(df, min_zoom=7).count() == pyramid_tiles(packed, 4, min_zoom=7).count() == 0

"""The cases the original's own specs describe."""

import json

import pytest
from pyspark.sql import functions as F

import brute
from quiltmap.operators import cover, tiles
from quiltmap.plans.pyramid import pyramid, pyramid_tiles
from quiltmap.sources.documents import manifest_inputs

RECTS = "zoom int, col_min int, row_min int, col_max int, row_max int"


def manifest(**changes):
    entry = {
        "sourceUri": "s3://b/one.tif",
        "tiles": "/w/one",
        "zoom": 18,
        "gridBounds": {"colMin": 193040, "rowMin": 109836, "colMax": 193078, "rowMax": 109878},
        "extent": {"xmin": 85.1, "ymin": 27.9, "xmax": 85.2, "ymax": 28.0},
    }
    other = {
        **entry,
        "sourceUri": "s3://b/two.tif",
        "zoom": 12,
        "gridBounds": {"colMin": 2986, "rowMin": 1709, "colMax": 3013, "rowMax": 1736},
    }
    return {"jobId": "j", "target": "/t", "tileSize": 1024, "input": [entry, other], **changes}


def as_documents(spark, *docs):
    return spark.createDataFrame([(json.dumps(d),) for d in docs], "value string")


def test_manifest_sample(spark):
    rows = manifest_inputs(as_documents(spark, manifest())).collect()
    assert {(r.col_min, r.row_min, r.col_max, r.row_max) for r in rows} == {
        (2986, 1709, 3013, 1736),
        (193040, 109836, 193078, 109878),
    }
    assert {r.source_uri: r.priority for r in rows} == {"s3://b/one.tif": 1, "s3://b/two.tif": 0}


def test_tile_counts(spark):
    rects = spark.createDataFrame([(5, 100, 106, 120, 126), (4, 50, 53, 60, 73)], RECTS)
    merged = {r.zoom: r.tiles for r in cover.tile_counts_merged(rects).collect()}
    unmerged = {r.zoom: r.tiles for r in cover.tile_counts_unmerged(rects).collect()}
    assert merged[5] == 441 and unmerged[5] == 441
    assert unmerged[4] == 352 and merged[4] == 231


@pytest.fixture(scope="module")
def squares():
    """Constant-colour images around tile (205, 306) of zoom 10, later ones on top, 12-pixel tiles."""
    dim, x, y = 12, 205 * 12, 306 * 12
    corners = [(x - 6, y - 6, x + 18, y + 18), (x + 2, y + 2, x + 6, y + 6), (x + 4, y + 4, x + 8, y + 8), (x + 6, y + 6, x + 10, y + 10)]
    rows = []
    for i, (x0, y0, x1, y1) in enumerate(corners):
        colour = (10 * i + 10, 10 * i + 11, 10 * i + 12)
        rows += [(gx, gy, colour, i) for gx in range(x0, x1) for gy in range(y0, y1)]
    return dim, rows


def test_constant_colour_squares(spark, squares):
    dim, rows = squares
    pixels = spark.createDataFrame(
        [(p, p, 10, gx, gy, *c) for gx, gy, c, p in rows],
        "image_id bigint, priority bigint, zoom int, gx int, gy int, r int, g int, b int",
    )
    want = {
        (z, gx, gy, *bands, p) for z, level in brute.pyramid({10: rows}).items() for (gx, gy), (bands, p) in level.items()
    }
    columns = ["zoom", "gx", "gy", "r", "g", "b", "priority"]
    assert {tuple(r) for r in pyramid(pixels).select(*columns).collect()} == want
    packed = tiles.tile_assemble(pixels, ["image_id", "priority", "zoom"], dim)
    built = tiles.tile_explode(pyramid_tiles(packed, dim), ["zoom"], dim)
    assert {tuple(r) for r in built.select(*columns).collect()} == want
    greens = {(gx, gy): bands[1] for (gx, gy), (bands, _) in brute.pyramid({10: rows})[10].items()}
    assert greens[205 * 12 + 7, 306 * 12 + 7] == 41 and greens[205 * 12 + 5, 306 * 12 + 5] == 31
    assert pyramid(pixels).where(F.col("zoom") == 1).count() >= 1

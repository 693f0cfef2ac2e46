import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import brute
from quiltmap.operators import cover, kernels, mosaic, tiles
from quiltmap.plans.pyramid import pyramid, pyramid_tiles

PIXELS = "image_id bigint, priority bigint, zoom int, gx int, gy int, r int, g int, b int"
COLUMNS = ["zoom", "gx", "gy", "r", "g", "b", "priority"]
SPARK = settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

byte = st.sampled_from([0, 0, 1, 2, 100, 255])
pixel = st.tuples(st.integers(0, 15), st.integers(0, 15), st.tuples(byte, byte, byte), st.integers(0, 6))


def tile(values, priority, key=(5, 3, 2)):
    return dict(zip(("zoom", "col", "row"), key), bands=[bytes(v) for v in values], priority=priority, orders=None)


bands = st.lists(st.lists(byte, min_size=16, max_size=16), min_size=3, max_size=3)


@given(st.lists(st.tuples(bands, st.integers(0, 5)), min_size=1, max_size=6), st.randoms())
def test_kernel_merge_ignores_order_and_grouping(inputs, rng):
    ranked = [kernels.ranked(tile(b, p)) for b, p in inputs]
    whole = np.maximum.reduce(ranked)
    rng.shuffle(ranked)
    cut = rng.randrange(len(ranked)) + 1
    left = kernels.merged_tile((5, 3, 2), np.maximum.reduce(ranked[:cut]), per_band=True)
    parts = [kernels.ranked(left), *ranked[cut:]]
    assert (np.maximum.reduce(parts) == whole).all()
    assert (np.maximum(whole, kernels.ranked(tile(np.zeros((3, 16), np.uint8), 99))) == whole).all()


@given(bands, st.integers(0, 3))
def test_kernel_halves_like_the_rule(values, priority):
    quarter = kernels.halved(kernels.ranked(tile(values, priority)), 4)
    assert quarter.shape == (3, 4)
    rows = [(12 + i % 4, 8 + i // 4, tuple(v[i] for v in values), priority) for i in range(16)]
    want = {(gx, gy): (b, p) for gx, gy, b, p in brute.halve(brute.merge(rows))}
    got = {}
    for i in np.flatnonzero((quarter != kernels.EMPTY).any(axis=0)):
        at = (6 + int(i) % 2, 4 + int(i) // 2)
        got[at] = (tuple(int(v) for v in quarter[:, i] & 255), int((quarter[:, i] >> 8).max()))
    assert got == want


@SPARK
@given(st.lists(st.tuples(st.integers(2, 4), pixel), min_size=1, max_size=60), st.integers(1, 5))
def test_pyramids_match_brute_force(spark, inputs, per_job):
    unique = {(z, gx, gy, p): c for z, (gx, gy, c, p) in inputs}
    by_zoom = {}
    for (z, gx, gy, p), c in unique.items():
        by_zoom.setdefault(z, []).append((gx, gy, c, p))
    want = {(z, x, y, *c, p) for z, level in brute.pyramid(by_zoom).items() for (x, y), (c, p) in level.items()}
    df = spark.createDataFrame([(p, p, z, gx, gy, *c) for (z, gx, gy, p), c in unique.items()], PIXELS)
    for staged in (True, False):
        built = pyramid(df, stage=staged, levels_per_job=per_job).where("r + g + b > 0")
        assert {tuple(r) for r in built.select(*COLUMNS).collect()} == want
    packed = tiles.tile_assemble(df, ["image_id", "priority", "zoom"], 4)
    built = tiles.tile_explode(pyramid_tiles(packed, 4, levels_per_job=per_job), ["zoom"], 4)
    assert {tuple(r) for r in built.select(*COLUMNS).collect()} == want


@SPARK
@given(st.lists(pixel, min_size=1, max_size=40, unique_by=lambda p: (p[0], p[1], p[3])))
def test_split_then_explode_is_explode(spark, rows):
    df = spark.createDataFrame([(p, p, 4, gx, gy, *c) for gx, gy, c, p in rows], PIXELS)
    packed = tiles.tile_assemble(df, ["image_id", "priority", "zoom"], 8)
    small = tiles.split_packed(packed, 4)
    pixels = lambda t, dim: sorted(tuple(r) for r in tiles.tile_explode(t, ["image_id"], dim).collect())
    assert pixels(packed, 8) == pixels(small, 2)
    assert {r.zoom for r in small.select("zoom").collect()} == {6}
    assert (mosaic.mosaic_merge(df.repartition(5)).exceptAll(mosaic.mosaic_merge(df.coalesce(1)))).count() == 0


@SPARK
@given(st.lists(st.tuples(st.integers(0, 200), st.integers(0, 200), st.integers(-1, 90), st.integers(-1, 90)), min_size=1, max_size=5))
def test_cover_lists_each_tile_once_whatever_the_block(spark, rects):
    rows = [(i, 7, c, r, c + w, r + h, "f") for i, (c, r, w, h) in enumerate(rects)]
    df = spark.createDataFrame(rows, "image_id int, zoom int, col_min int, row_min int, col_max int, row_max int, folder string")
    want = sorted(
        (i, c, r) for i, _, c0, r0, c1, r1, _ in rows for c in range(c0, min(c1, 127) + 1) for r in range(r0, min(r1, 127) + 1)
    )
    got = cover.tile_cover(df, ["image_id"], "folder", 8).select("image_id", "col", "row")
    assert sorted(tuple(x) for x in got.collect()) == want
    clipped = df.withColumn("col_max", F.least("col_max", F.lit(127))).withColumn("row_max", F.least("row_max", F.lit(127)))
    small_blocks = cover.explode_bounds(clipped, ["image_id"], block=7)
    assert sorted(tuple(x) for x in small_blocks.collect()) == want

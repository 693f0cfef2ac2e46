"""Tiles and windows drawn from sorted rows, however batches cut them, and without a call per tile."""

import random

import numpy as np
import pyarrow as pa
import pytest

from quiltmap.operators import kernels, tiles

DIM, NAMES, KEEP = 4, ["r", "g"], ["image_id", "col", "row"]
SCHEMA = pa.schema([("image_id", pa.string()), ("col", pa.int32()), ("row", pa.int32()), ("bands", pa.list_(pa.binary()))])


@pytest.mark.parametrize("size, most", [(1, 1 << 22), (3, 32), (7, 96), (10_000, 64), (10_000, 1 << 22)])
def test_a_tile_may_lie_in_any_number_of_batches(monkeypatch, size, most):
    monkeypatch.setattr(kernels, "ASSEMBLED_BYTES", most)
    draw = random.Random(size)
    pixels = [(draw.choice([None, "a", "b"]), draw.randrange(3), draw.randrange(2), draw.randrange(DIM), draw.randrange(DIM), draw.randrange(256), draw.randrange(256)) for _ in range(300)]
    pixels.sort(key=lambda p: (p[0] or "", p[1], p[2]))
    want = {}
    for i, c, r, x, y, *values in pixels:
        canvas = want.setdefault((i, c, r), np.zeros((2, DIM * DIM), np.uint8))
        canvas[:, y * DIM + x] = np.maximum(canvas[:, y * DIM + x], values)
    types = [pa.string(), *[pa.int32()] * 6]
    table = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*pixels), types, strict=True)], [*KEEP, "x", "y", *NAMES])
    batches = [table.slice(at, size) for at in range(0, len(pixels), size)]
    got = [t for b in kernels.assemble_runs(DIM, NAMES, KEEP, SCHEMA)(iter([table.slice(0, 0), *batches])) for t in b.to_pylist()]
    assert [(t["image_id"], t["col"], t["row"]) for t in got] == list(want)
    assert [t["bands"] for t in got] == [[band.tobytes() for band in canvas] for canvas in want.values()]
    assert not list(kernels.assemble_runs(DIM, NAMES, KEEP, SCHEMA)(iter([])))


def test_no_call_for_each_tile_or_window(spark):
    pixels = spark.createDataFrame([], "image_id long, gx int, gy int, r int, g int, b int")
    blocks = spark.createDataFrame([], "image_id long, x0 int, y0 int, width int, height int, bands array<binary>")
    for df in (tiles.tile_assemble(pixels, ["image_id"], 8), tiles.retile_blocks(blocks, ["image_id"], 10)):
        assert df.count() == 0
        assert "FlatMapGroups" not in df._jdf.queryExecution().executedPlan().toString()


def test_pixels_of_many_tiles_leave_in_one_batch():
    schema = pa.schema([(n, pa.int64() if n == "priority" else pa.int32()) for n in ("priority", "gx", "gy", "r")])
    some = pa.RecordBatch.from_pylist([{"priority": 0, "col": i, "row": 0, "bands": [bytes([i % 255 + 1]) * 16]} for i in range(500)])
    out = list(kernels.explode_each(4, ["r"], schema)(iter([some])))
    assert len(out) == 1 and out[0].num_rows == 500 * 16
    assert out[0].column("r").to_pylist() == [i % 255 + 1 for i in range(500) for _ in range(16)]

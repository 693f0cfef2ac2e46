"""Files in and out, and both steps end to end against plain Python."""

import json
import math
import os

import numpy as np
import pytest

import brute
from quiltmap.functions.grid import EARTH_RADIUS, WORLD_WIDTH
from quiltmap.operators import tiles
from quiltmap.plans import jobs
from quiltmap.sinks.documents import append_status, latest_status, read_images, read_status, write_manifest
from quiltmap.sinks.tiles import encode_png, pyramid_export, write_chunks
from quiltmap.sources.documents import manifest_inputs, read_documents, read_manifest, request_images
from quiltmap.sources.tiles import tile_files, tile_index, tile_scan

DIM, OUT, WINDOW = 16, 8, 20
IMAGES = (
    "source_uri string, crs string, width int, height int, left double, top double, res double, "
    "lon0 double, lat0 double, deg double"
)
BLOCKS = "source_uri string, x0 int, y0 int, width int, height int, bands array<binary>"


def image(seed, width, height):
    rng = np.random.default_rng(seed)
    values = rng.integers(1, 256, (3, height, width), dtype=np.uint8)
    values[:, rng.random((height, width)) < 0.2] = 0
    values[1, rng.random((height, width)) < 0.2] = 0
    return values


def blocks_of(uri, values, size=13):
    _, height, width = values.shape
    for y in range(0, height, size):
        for x in range(0, width, size):
            part = values[:, y : y + size, x : x + size]
            yield uri, x, y, part.shape[2], part.shape[1], [np.ascontiguousarray(b).tobytes() for b in part]


def zoom_of(res):
    exact = math.log(WORLD_WIDTH / (res * DIM)) / math.log(2)
    return int(exact) + 1 if exact - int(exact) > 0.2 else int(exact)


def sampled(values, left, top, res, priority):
    """Target pixels by looking every one of them up."""
    zoom = zoom_of(res)
    target = WORLD_WIDTH / (2**zoom * DIM)
    half = WORLD_WIDTH / 2
    _, height, width = values.shape
    rows = []
    for gx in range(int((left + half) / target) - 1, int((left + half + width * res) / target) + 2):
        for gy in range(int((half - top) / target) - 1, int((half - top + height * res) / target) + 2):
            sx = math.floor(((gx + 0.5) * target - half - left) / res)
            sy = math.floor((top - (half - (gy + 0.5) * target)) / res)
            if 0 <= sx < width and 0 <= sy < height:
                rows.append((gx, gy, tuple(int(v) for v in values[:, sy, sx]), priority))
    return zoom + int(math.log2(DIM // OUT)), rows


def warped(values, lon0, lat0, deg):
    _, height, width = values.shape
    x = lambda lon: EARTH_RADIUS * math.radians(lon)
    y = lambda lat: EARTH_RADIUS * math.log(math.tan(math.pi / 4 + math.radians(lat) / 2))
    left, top = x(lon0), y(lat0)
    across, down = x(lon0 + width * deg) - left, top - y(lat0 - height * deg)
    res = math.hypot(across, down) / math.hypot(width, height)
    out = np.zeros((3, math.ceil(down / res) + 1, math.ceil(across / res) + 1), np.uint8)
    for ty in range(out.shape[1]):
        for tx in range(out.shape[2]):
            sx = math.floor((math.degrees((left + (tx + 0.5) * res) / EARTH_RADIUS) - lon0) / deg)
            lat = math.degrees(math.atan(math.sinh((top - (ty + 0.5) * res) / EARTH_RADIUS)))
            sy = math.floor((lat0 - lat) / deg)
            if 0 <= sx < width and 0 <= sy < height:
                out[:, ty, tx] = values[:, sy, sx]
    return out, left, top, res


@pytest.fixture(scope="module")
def rasters(spark):
    res = WORLD_WIDTH / (2**9 * DIM) * 1.07
    left, top = -WORLD_WIDTH / 2 + 100.3 * DIM * res, WORLD_WIDTH / 2 - 90.7 * DIM * res
    lon0 = math.degrees((left + 30 * res) / EARTH_RADIUS)
    lat0 = math.degrees(math.atan(math.sinh((top - 10 * res) / EARTH_RADIUS)))
    deg = math.degrees(res * 3.1 / EARTH_RADIUS)
    a, b, blank = image(1, 47, 39), image(2, 21, 17), np.zeros((3, 9, 9), np.uint8)
    meta = [
        ("http://h/a.tif", "EPSG:3857", 47, 39, left, top, res, None, None, None),
        ("s3://k/b.tif", "EPSG:4326", 21, 17, None, None, None, lon0, lat0, deg),
        ("/d/blank.tif", "EPSG:3857", 9, 9, left, top, res, None, None, None),
        ("/d/odd.tif", "EPSG:32633", 9, 9, left, top, res, None, None, None),
    ]
    stored = [*blocks_of("http://h/a.tif", a), *blocks_of("s3://k/b.tif", b), *blocks_of("/d/blank.tif", blank)]
    inputs = {}
    for zoom, rows in (sampled(*warped(b, lon0, lat0, deg), priority=1), sampled(a, left, top, res, priority=0)):
        inputs.setdefault(zoom, []).extend(rows)
    return spark.createDataFrame(meta, IMAGES), spark.createDataFrame(stored, BLOCKS), brute.pyramid(inputs)


def request_file(folder, images, job="job", out="out"):
    path = folder / "request.json"
    doc = {"jobId": job, "target": str(folder / out), "images": images, "workspace": str(folder / "work")}
    path.write_text(json.dumps(doc, indent=2))
    return str(path)


def test_both_steps(spark, tmp_path, rasters):
    images, blocks, want = rasters
    assert len({z for z in want if want[z]}) > 5
    request = request_file(tmp_path, ["s3://k/b.tif", "http://h/a.tif", "/d/blank.tif"])
    status = str(tmp_path / "status")
    levels = jobs.run(spark, request, images, blocks, DIM, OUT, WINDOW, status=status)
    built = {}
    for r in tiles.tile_explode(levels, ["zoom"], OUT).collect():
        built.setdefault(r.zoom, {})[r.gx, r.gy] = (r.r, r.g, r.b)
    assert built == {z: {k: bands for k, (bands, _) in level.items()} for z, level in want.items()}

    for zoom, level in built.items():
        shown = {}
        for folder, _, names in os.walk(tmp_path / "out" / "png" / str(zoom)):
            for name in names:
                assert name.endswith(".png")
                width, height, pixels = brute.read_png(open(os.path.join(folder, name), "rb").read())
                assert (width, height) == (OUT, OUT)
                col, row = int(os.path.basename(folder)), int(name[:-4])
                for (x, y), rgba in pixels.items():
                    assert rgba[3] == (255 if any(rgba[:3]) else 0)
                    if rgba[3]:
                        shown[col * OUT + x, row * OUT + y] = rgba[:3]
        assert shown == level

    inputs = manifest_inputs(read_manifest(spark, str(tmp_path / "work" / "manifest" / "job_id=job")))
    rows = inputs.orderBy("position").collect()
    assert [r.position for r in rows] == list(range(len(rows))) and [r.priority for r in rows] == list(range(len(rows)))[::-1]
    uris = [r.source_uri for r in rows]
    assert set(uris) == {"s3://k/b.tif", "http://h/a.tif"} and uris == sorted(uris, reverse=True)
    assert {tuple(r) for r in read_images(spark, status).collect()} == {("job", u) for u in uris}
    last = latest_status(read_status(spark, status), ["jobId", "stage"], ["at"], ["status", "target"])
    assert {(r.stage, r.status, r.updates) for r in last.collect()} == {("chunk", "FINISHED", 2), ("mosaic", "FINISHED", 2)}


def test_images_whose_names_collide_stay_apart(spark, tmp_path):
    """The extension is not part of a folder's name; the image below must not come out on top."""
    res = WORLD_WIDTH / (2**9 * DIM)
    corner = (-WORLD_WIDTH / 2 + 100 * DIM * res, WORLD_WIDTH / 2 - 90 * DIM * res)
    uris = ["s3://k/x.tif", "s3://k/x.jp2"]
    images = spark.createDataFrame([(u, "EPSG:3857", DIM, DIM, *corner, res, None, None, None) for u in uris], IMAGES)
    blocks = spark.createDataFrame(
        [(u, 0, 0, DIM, DIM, [bytes([10 * i + 5]) * (DIM * DIM)] * 3) for i, u in enumerate(uris)], BLOCKS
    )
    for order, shown in ((uris, 5), (uris[::-1], 15)):
        levels = jobs.run(spark, request_file(tmp_path, order), images, blocks, DIM, OUT, WINDOW, export=False)
        drawn = tiles.tile_explode(levels, ["zoom"], OUT).select("r", "g", "b").distinct().collect()
        assert [tuple(r) for r in drawn] == [(shown,) * 3]


@pytest.mark.parametrize("uri, reason", [("/d/none.tif", "no raster for"), ("/d/odd.tif", "unsupported crs")])
def test_bad_image_fails_the_job(spark, tmp_path, rasters, uri, reason):
    images, blocks, _ = rasters
    status = str(tmp_path / "status")
    with pytest.raises(ValueError, match=reason):
        jobs.run(spark, request_file(tmp_path, ["http://h/a.tif", uri]), images, blocks, DIM, OUT, WINDOW, status=status)
    failed = read_status(spark, status).where("status = 'FAILED'").collect()
    assert len(failed) == 1 and reason in failed[0].error and "Traceback" in failed[0].stack


def test_mosaic_refuses_a_tile_size_that_does_not_fit(spark, rasters):
    doc = {"jobId": "j", "target": "/t", "tileSize": 24, "input": []}
    entry = {"sourceUri": "u", "zoom": 3, "tiles": "f", "gridBounds": {"colMin": 0, "rowMin": 0, "colMax": 0, "rowMax": 0}}
    manifest = spark.createDataFrame([(json.dumps({**doc, "input": [entry]}),)], "value string")
    with pytest.raises(ValueError, match="tileSize must be"):
        jobs.mosaic(manifest, spark.createDataFrame([], jobs.CHUNKS), OUT)


def test_manifest_has_one_record_per_input(spark, tmp_path):
    rows = [("j", "t", 8, 10 * (i // 3), i % 3, f"u{i}", f"f{i}", 4, i, i, i, i, 0.0, 0.0, 1.0, 1.0) for i in range(25)]
    df = spark.createDataFrame(
        rows,
        "job_id string, target string, tile_size int, ord bigint, piece bigint, source_uri string, folder string, zoom int, "
        "col_min int, row_min int, col_max int, row_max int, xmin double, ymin double, xmax double, ymax double",
    )
    for some in (df, df.where("ord < 20")):
        write_manifest(some.repartition(4), str(tmp_path / "m"), tie="piece")
        records = read_manifest(spark, str(tmp_path / "m"))
        n = some.count()
        assert records.count() == n
        got = manifest_inputs(records).orderBy("position").collect()
        assert [r.source_uri for r in got] == [f"u{i}" for i in range(n)]
        assert [r.priority for r in got] == list(range(n - 1, -1, -1))


def test_a_whole_manifest_is_read_and_a_second_document_refused(spark):
    entry = {"sourceUri": "u", "zoom": 3, "tiles": "f", "gridBounds": {"colMin": 0, "rowMin": 0, "colMax": 0, "rowMax": 0}}
    doc = json.dumps({"jobId": "j", "target": "/t", "tileSize": 16, "input": [entry, {**entry, "sourceUri": "v"}]})
    got = manifest_inputs(spark.createDataFrame([(doc,)], "value string")).orderBy("position").collect()
    assert [(r.source_uri, r.priority) for r in got] == [("u", 1), ("v", 0)]
    request = json.dumps({"jobId": "j", "target": "t", "images": ["a"], "workspace": "w"})
    assert request_images(spark.createDataFrame([(request + "\n",)], "value string")).count() == 1
    for read, text in ((manifest_inputs, doc + doc), (request_images, request + request)):
        with pytest.raises(Exception, match="needs"):
            read(spark.createDataFrame([(text,)], "value string")).collect()


def square(spark, uri, value, size=DIM, bands=3, at=100):
    res = WORLD_WIDTH / (2**9 * DIM)
    left, top = -WORLD_WIDTH / 2 + at * DIM * res, WORLD_WIDTH / 2 - 90 * DIM * res
    images = spark.createDataFrame([(uri, "EPSG:3857", size, size, left, top, res, None, None, None)], IMAGES)
    return images, spark.createDataFrame([(uri, 0, 0, size, size, [bytes([value]) * (size * size)] * bands)], BLOCKS)


def drawn(levels):
    return {r.r for r in tiles.tile_explode(levels, ["zoom"], OUT).select("r").distinct().collect()}


def test_jobs_of_one_workspace_keep_apart_and_reruns_replace(spark, tmp_path):
    first, second = square(spark, "/d/a.tif", 7, size=3 * DIM), square(spark, "/d/b.tif", 9)
    jobs.chunk(read_documents(spark, request_file(tmp_path, ["/d/a.tif"], "one")), *first, DIM, WINDOW)
    jobs.run(spark, request_file(tmp_path, ["/d/b.tif"], "two", "out2"), *second, DIM, OUT, WINDOW, export=False)
    chunks = jobs.read_chunks(spark, str(tmp_path / "work"))
    assert {r.job_id for r in chunks.select("job_id").distinct().collect()} == {"one", "two"}
    manifest = read_manifest(spark, str(tmp_path / "work" / "manifest" / "job_id=one"))
    status = str(tmp_path / "status")
    assert drawn(jobs.mosaic(manifest, chunks, OUT, status=status)) == {7}
    count = lambda: sum(len(names) for _, _, names in os.walk(tmp_path / "out" / "png"))
    many = count()
    smaller = square(spark, "/d/a.tif", 5)
    levels = jobs.run(spark, request_file(tmp_path, ["/d/a.tif"], "one"), *smaller, DIM, OUT, WINDOW, status=status)
    assert drawn(levels) == {5} and 0 < count() < many
    assert [tuple(r) for r in read_images(spark, status).collect()] == [("one", "/d/a.tif")]
    assert not (tmp_path / "out" / "levels-building").exists()


def test_what_a_job_refuses(spark, tmp_path):
    images, blocks = square(spark, "/d/a.tif", 7)
    request = json.loads(open(request_file(tmp_path, ["/d/a.tif"])).read())
    two = spark.createDataFrame([(json.dumps(request),), (json.dumps({**request, "jobId": "other"}),)], "value string")
    with pytest.raises(ValueError, match="one job at a time"):
        jobs.chunk(two, images, blocks, DIM, WINDOW)
    one = two.limit(1)
    with pytest.raises(ValueError, match="two rasters"):
        jobs.chunk(one, images.union(images), blocks, DIM, WINDOW)
    with pytest.raises(Exception, match="fewer than three bands"):
        jobs.chunk(one, images, square(spark, "/d/a.tif", 7, bands=1)[1], DIM, WINDOW)
    manifest = jobs.chunk(one, images, blocks, DIM, WINDOW)
    chunks = jobs.read_chunks(spark, str(tmp_path / "work"))
    with pytest.raises(ValueError, match="no chunks for /d/a.tif"):
        jobs.mosaic(read_manifest(spark, manifest), chunks.where("job_id = 'none'"), OUT, export=False)


def test_tile_files(spark, tmp_path):
    for name in ("7/1/2.tif", "7/1/3.TIFF", "6/1/2.TIF", "7/1/4.png", "7/x/4.tif", "notes.txt"):
        path = tmp_path / "a" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"x")
    other = tmp_path / "ab" / "7" / "9"
    other.mkdir(parents=True)
    (other / "9.tif").write_bytes(b"x")
    found = tile_index(tile_files(spark, str(tmp_path / "a")), 7)
    assert {(r.zoom, r.col, r.row) for r in found.collect()} == {(7, 1, 2), (7, 1, 3)}


def test_chunks_round_trip_and_prune(spark, tmp_path):
    chunks = spark.createDataFrame(
        [(1, z, z * 10, z * 20, [bytes([z] * 4)] * 3) for z in (3, 4, 5)], "image_id int, zoom int, col int, row int, bands array<binary>"
    )
    write_chunks(chunks, str(tmp_path / "c"))
    one = tile_scan(spark, str(tmp_path / "c"), chunks.schema, 4)
    assert one.select(*chunks.columns).collect() == chunks.where("zoom = 4").collect()
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(zoom" in plan


def test_blank_tiles_are_written_unless_skipped(spark, tmp_path):
    df = spark.createDataFrame(
        [(2, 1, 1, [bytes(16)] * 3), (2, 1, 2, [bytes(16), bytes(15) + b"\x05", bytes(16)])],
        "zoom int, col int, row int, bands array<binary>",
    )
    assert encode_png(df, 4).count() == 2 and encode_png(df, 4, skip_blank=True).count() == 1
    for _ in range(2):
        pyramid_export(df, str(tmp_path), 4)
    names = sorted(os.listdir(tmp_path / "2" / "1"))
    assert names == ["1.png", "2.png"]
    assert brute.read_png((tmp_path / "2" / "1" / "2.png").read_bytes())[2][3, 3] == (0, 5, 0, 255)


def test_status_keeps_quotes(spark, tmp_path):
    append_status(spark, str(tmp_path / "s"), 'a "job"', "chunk", "FAILED", error='say "no"\n')
    row = read_status(spark, str(tmp_path / "s")).first()
    assert row.jobId == 'a "job"' and row.error == 'say "no"\n'

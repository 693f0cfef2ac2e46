"""Runs that stop half-way, and what a second one makes of what they left."""

import os

import pytest
from pyspark.sql import functions as F

from quiltmap.functions.ranking import PIECES_ACROSS, carried_rank
from quiltmap.operators import tiles
from quiltmap.plans import jobs
from quiltmap.plans import pyramid as plans
from quiltmap.sinks.tiles import pyramid_export, write_chunks
from quiltmap.sources.tiles import region_scan, tile_scan

TILES = "zoom int, col int, row int, priority bigint, bands array<binary>"


class Stopped(Exception):
    pass


def some_tiles(spark, value=9):
    rows = [(z, z * 3 + i % 3, z * 2 + i // 3, i, [bytes([value + i]) * 16] * 3) for z in (8, 6) for i in range(6)]
    return spark.createDataFrame(rows, TILES)


def stop_at(monkeypatch, number):
    """Fails before the job of that number is saved; returns the list of saved levels."""
    saved, save = [], plans.save_job

    def counted(levels, built):
        if len(saved) == number:
            raise Stopped
        saved.append(built)
        save(levels, built)

    monkeypatch.setattr(plans, "save_job", counted)
    return saved


def pixels(levels):
    return sorted(map(tuple, tiles.tile_explode(levels, ["zoom"], 4).collect()))


def test_a_pyramid_goes_on_where_it_stopped(spark, tmp_path, monkeypatch):
    source, path = str(tmp_path / "in"), str(tmp_path / "levels")
    write_chunks(some_tiles(spark), source)
    stored = spark.read.schema(TILES).parquet(source)
    want = pixels(plans.pyramid_tiles(stored, 4))
    stop_at(monkeypatch, 1)
    with pytest.raises(Stopped):
        plans.pyramid_tiles(stored, 4, path=path)
    assert not os.path.exists(path)
    monkeypatch.undo()
    saved = stop_at(monkeypatch, 99)
    assert pixels(plans.pyramid_tiles(stored, 4, path=path)) == want
    assert len(saved) == len(plans.level_jobs([8], 1, 3)) - 1
    assert sorted(os.listdir(tmp_path)) == ["in", "levels"] and not [f for f in os.listdir(path) if "=-" in f]


def test_a_pyramid_of_other_inputs_starts_anew(spark, tmp_path, monkeypatch):
    source, path = str(tmp_path / "in"), str(tmp_path / "levels")
    write_chunks(some_tiles(spark), source)
    stop_at(monkeypatch, 1)
    with pytest.raises(Stopped):
        plans.pyramid_tiles(spark.read.schema(TILES).parquet(source), 4, path=path)
    monkeypatch.undo()
    write_chunks(some_tiles(spark, value=90), source)
    stored = spark.read.schema(TILES).parquet(source)
    saved = stop_at(monkeypatch, 99)
    assert pixels(plans.pyramid_tiles(stored, 4, path=path)) == pixels(plans.pyramid_tiles(stored, 4))
    assert len(saved) == 2 * len(plans.level_jobs([8], 1, 3))


def test_another_version_starts_anew(spark, tmp_path, monkeypatch):
    source, path = str(tmp_path / "in"), str(tmp_path / "levels")
    write_chunks(some_tiles(spark), source)
    stored = spark.read.schema(TILES).parquet(source)
    stop_at(monkeypatch, 1)
    with pytest.raises(Stopped):
        plans.pyramid_tiles(stored, 4, path=path, version=1)
    monkeypatch.undo()
    saved = stop_at(monkeypatch, 99)
    plans.pyramid_tiles(stored, 4, path=path, version=2)
    assert len(saved) == len(plans.level_jobs([8], 1, 3))


def test_an_earlier_pyramid_stays_until_the_new_one_is_whole(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "levels")
    before = pixels(plans.pyramid_tiles(some_tiles(spark), 4, path=path))
    stop_at(monkeypatch, 2)
    with pytest.raises(Stopped):
        plans.pyramid_tiles(some_tiles(spark, value=90), 4, path=path)
    assert pixels(spark.read.schema(tiles.MERGED).parquet(path)) == before


def test_no_inputs_replace_an_earlier_pyramid(spark, tmp_path):
    path, flat = str(tmp_path / "levels"), str(tmp_path / "pixels")
    plans.pyramid_tiles(some_tiles(spark), 4, path=path)
    assert plans.pyramid_tiles(some_tiles(spark).limit(0), 4, path=path).count() == 0
    assert spark.read.schema(tiles.MERGED).parquet(path).count() == 0
    drawn = tiles.tile_explode(some_tiles(spark), ["zoom"], 4)
    plans.pyramid(drawn, path=flat)
    assert plans.pyramid(drawn.limit(0), path=flat).count() == spark.read.schema(plans.PIXELS_OUT).parquet(flat).count() == 0


def test_levels_without_orders_have_the_same_pixels(spark):
    df = some_tiles(spark)
    plain = plans.pyramid_tiles(df, 4, orders=False)
    assert plain.where("orders IS NOT NULL OR palette IS NOT NULL OR priority IS NOT NULL").count() == 0
    bare = lambda levels: sorted(map(tuple, tiles.tile_explode(levels, ["zoom"], 4).drop("priority").collect()))
    assert bare(plain) == bare(plans.pyramid_tiles(df, 4))


def files_below(folder):
    return {os.path.relpath(os.path.join(at, n), folder): open(os.path.join(at, n), "rb").read() for at, _, names in os.walk(folder) for n in names if n.endswith(".png")}


def test_an_export_that_fails_removes_nothing(spark, tmp_path):
    df, target = some_tiles(spark).where("zoom = 8"), str(tmp_path / "png")
    assert pyramid_export(df, target, 4) == 6
    before = files_below(target)
    # the last tile cannot be encoded
    broken = df.where("col < 26").withColumn("bands", F.when(F.col("row") == 17, F.array(F.lit(b"x"))).otherwise(F.col("bands"))).coalesce(1)
    with pytest.raises(Exception, match="PythonException|reshape|Error"):
        pyramid_export(broken, target, 4)
    assert files_below(target).keys() == before.keys()
    with open(os.path.join(target, "8", "24", "16.png.0f.part"), "wb") as part:
        part.write(b"x")
    with open(os.path.join(target, "notes.txt"), "w") as other:
        other.write("stays")
    assert pyramid_export(df.where("col < 26"), target, 4) == 4
    assert files_below(target) == {k: v for k, v in before.items() if not k.startswith("8/26/")}
    assert os.path.exists(os.path.join(target, "notes.txt")) and not os.path.exists(os.path.join(target, "8", "24", "16.png.0f.part"))


def test_a_region_lies_in_few_files(spark, tmp_path):
    """64 x 64 tiles, far more than a file's worth: a region of 8 x 8 is in one or two files, and outside ones are pruned by bounds."""
    chunks = spark.range(64 * 64).repartition(16).selectExpr(
        "9 AS zoom", "int(id % 64) AS col", "int(id div 64) AS row", "id AS priority", "array(unhex(array_join(transform(sequence(1, 64), i -> sha2(cast(id * 64 + i AS string), 256)), ''))) AS bands"
    )
    path = str(tmp_path / "c")
    size = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        write_chunks(chunks, path)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", size)
    whole = tile_scan(spark, path, chunks.schema, 9)
    region = region_scan(spark, path, chunks.schema, 9, (8, 16, 15, 23))
    name = F.input_file_name().alias("file")
    assert region.count() == 64
    assert whole.select(name).distinct().count() >= 4 and region.select(name).distinct().count() <= 2
    plan = region._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(col), IsNotNull(row), GreaterThanOrEqual(col,8), LessThanOrEqual(col,15)" in plan
    assert sorted(map(tuple, whole.select("col", "row", "priority").collect())) == sorted(map(tuple, chunks.select("col", "row", "priority").collect()))


def as_inputs(spark, places):
    rows = [("j", f"u{ord}", f"f{ord}/{piece}", 5, i, len(places) - 1 - i) for i, (ord, piece) in enumerate(places)]
    return spark.createDataFrame(rows, "job_id string, source_uri string, tiles string, zoom int, position bigint, priority bigint")


def as_chunks(spark, places):
    rows = [(f"u{ord}", f"f{ord}/{piece}", ord, piece, 5, i, 0, [b"\x01" * 4] * 3, "j") for i, (ord, piece) in enumerate(places)]
    return spark.createDataFrame(rows, jobs.CHUNKS)


def test_chunks_carry_their_priority(spark):
    places = [(0, 0), (0, 1), (0, PIECES_ACROSS), (2, 0), (7, 5)]
    size = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        ranked = jobs.with_priority(as_chunks(spark, places), as_inputs(spark, places))
        plan = ranked._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Join" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", size)
    order = [(r.ord, r.piece_index) for r in ranked.orderBy(F.desc("priority")).collect()]
    assert order == places


@pytest.mark.parametrize("change", ["reordered", "shortened"])
def test_a_changed_manifest_decides(spark, change):
    places = [(0, 0), (0, 1), (2, 0), (7, 5)]
    listed = places[::-1] if change == "reordered" else places[1:]
    ranked = jobs.with_priority(as_chunks(spark, places), as_inputs(spark, listed))
    assert [(r.ord, r.piece_index) for r in ranked.orderBy(F.desc("priority")).collect()] == listed


def test_places_beyond_their_bits_have_no_rank(spark):
    rows = [(1 << 24, 0), (0, 1 << 15), (0, (1 << 15) * PIECES_ACROSS), ((1 << 24) - 1, 0)]
    got = [r[0] for r in spark.createDataFrame(rows, "o bigint, p bigint").select(carried_rank("o", "p")).collect()]
    assert got[:3] == [None] * 3 and 0 <= got[3] < 1 << 55


def test_a_mosaic_reads_its_own_job_only(spark, tmp_path):
    path = str(tmp_path / "chunks")
    as_chunks(spark, [(0, 0)]).write.partitionBy("job_id", "zoom").parquet(path)
    own = spark.read.schema(jobs.CHUNKS).parquet(path).where(F.col("job_id") == "j")
    assert "PartitionFilters: [isnotnull(job_id" in own._jdf.queryExecution().executedPlan().toString()

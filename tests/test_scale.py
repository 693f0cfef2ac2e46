"""Hot keys, long jobs and huge rectangles; and what the plans must not contain."""

import glob
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from compare import connect, differences
from oracle.sql import ORACLE
from quiltmap import fixtures as fx
from quiltmap.functions.ranking import RANK_RANGE, with_position
from quiltmap.operators import cover, mosaic, sample, tiles
from quiltmap.queries import QUERIES


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("held", [2, 3, 32])
def test_a_third_of_all_tiles_on_one_key(spark, held):
    hot = spark.range(300).select(
        F.col("id").alias("image_id"),
        F.when(F.col("id") % 10 == 0, 7).otherwise(F.col("id")).alias("priority"),
        F.lit(6).alias("zoom"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 50).cast("int").alias("col"),
        F.lit(2).alias("row"),
        F.transform(
            F.array(F.lit(0), F.lit(1), F.lit(2)),
            lambda band: F.unhex(F.concat(*[F.lpad(F.hex((F.col("id") * (i + 3) + band * 31) % 5 * 50), 2, "0") for i in range(4)])),
        ).alias("bands"),
    )
    merged = tiles.tile_explode(tiles.mosaic_merge_tiles(hot, 2, held), ["zoom"], 2)
    pixels = tiles.tile_explode(hot, ["zoom"], 2)
    want = mosaic.mosaic_merge(pixels)
    columns = ["zoom", "gx", "gy", "r", "g", "b", "priority"]
    assert sorted(map(tuple, merged.select(*columns).collect())) == sorted(map(tuple, want.select(*columns).collect()))
    assert tiles.tile_load(hot) == [(6, 300)]


def test_positions_across_ranges(spark):
    """Ranks stay exact over range borders, with gaps, several jobs and ties."""
    step = RANK_RANGE // 3 + 1
    df = spark.range(200).select(
        F.when(F.col("id") % 4 == 0, "b").otherwise("a").alias("job"), (F.col("id") * step).alias("ord"), F.col("id").alias("n")
    )
    want = {}
    for n in range(200):
        want.setdefault("b" if n % 4 == 0 else "a", []).append(n)
    got = {(r.job, r.n): (r.position, r.total) for r in with_position(df, "job", "ord").collect()}
    assert got == {(j, n): (i, len(ns)) for j, ns in want.items() for i, n in enumerate(ns)}
    tied = df.withColumn("tie", F.col("ord") % 7 * RANK_RANGE + F.col("n") % 5).withColumn("ord", F.floor(F.col("n") / 9) * RANK_RANGE)
    rows = tied.collect()
    order = {j: sorted((r.ord, r.tie, r.n) for r in rows if r.job == j) for j in "ab"}
    keyed = {(j, n): i for j, ns in order.items() for i, (_, _, n) in enumerate(ns)}
    assert len({(r.job, r.ord, r.tie) for r in rows}) == 200
    assert {(r.job, r.n): r.position for r in with_position(tied, "job", "ord", "tie").collect()} == keyed


def test_one_image_over_a_million_tiles(spark):
    rects = spark.createDataFrame([(1, 14, 5, 7, 1004, 1006), (2, 14, 1, 1, 2, 2)], "image_id int, zoom int, col_min int, row_min int, col_max int, row_max int")
    tiles_ = cover.explode_bounds(rects, ["image_id"])
    assert {tuple(r) for r in tiles_.groupBy("image_id").count().collect()} == {(1, 1_000_000), (2, 4)}
    big = tiles_.where("image_id = 1")
    used = {r[0] for r in big.select(F.spark_partition_id()).distinct().collect()}
    assert len(used) > 2


def test_sampling_moves_no_rows(spark):
    source = spark.range(10).select(
        F.col("id").alias("image_id"),
        F.lit(3).alias("zoom"),
        *[F.lit(v).alias(n) for n, v in (("sx", 0), ("sy", 0), ("left", 0.0), ("top", 0.0), ("res", 1e5), ("r", 1), ("g", 1), ("b", 1))],
    )
    assert "Exchange" not in plan_of(sample.chunk_sample(source, ["image_id", "zoom"], "zoom", 8))


def test_merge_is_one_hash_aggregate(spark):
    pixels = spark.range(10).select(
        *[F.col("id").cast("int").alias(n) for n in ("zoom", "gx", "gy", "r", "g", "b")], F.col("id").alias("priority")
    )
    plan = plan_of(mosaic.mosaic_merge(pixels))
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("HashAggregate") == 2 and "SortAggregate" not in plan


def test_line_items_are_reduced_before_they_meet_the_images(spark, sf_dir):
    plan = plan_of(fx.pixels(spark, sf_dir))
    assert plan.index("Join") < plan.index("HashAggregate")
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint,l_linenumber:int,l_quantity:double>" in plan


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"pyramid", "pyramid_tiles", "tile_scan", "zoom_up_tiles", "mosaic_merge_tiles"}))
def test_no_cross_joins(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


@pytest.fixture(scope="module")
def hot_dir(sf_dir, tmp_path_factory):
    """The test tables with a third of all line items on one image, and a third of those on one pixel."""
    out = tmp_path_factory.mktemp("hot")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        os.symlink(path, out / os.path.basename(path)) if "lineitem" not in path else duckdb.sql(
            f"""COPY (SELECT * REPLACE (
                  CASE WHEN l_linenumber % 3 = 0 THEN 7 ELSE l_suppkey END AS l_suppkey,
                  CASE WHEN l_linenumber % 3 = 0 AND l_orderkey % 3 = 0 THEN 5 ELSE l_partkey END AS l_partkey,
                  CASE WHEN l_linenumber % 3 = 0 AND l_orderkey % 3 = 0 THEN 9 ELSE l_orderkey END AS l_orderkey)
                FROM read_parquet('{path}')) TO '{out}/lineitem.parquet' (FORMAT parquet)"""
        )
    return str(out)


@pytest.mark.parametrize(
    "name",
    ["mosaic_merge", "mosaic_merge_tiles", "pyramid", "pyramid_tiles", "nonempty_chunks", "valid_sources", "chunk_sample", "retile_tiles"],
)
def test_a_hot_image_and_pixel(spark, hot_dir, name):
    assert differences(QUERIES[name](spark, hot_dir), connect(hot_dir), ORACLE[name]) == []


def test_levels_share_their_shuffles(spark):
    pixels = spark.range(1000).selectExpr("9 AS zoom", "int(id % 32) AS gx", "int(id div 32) AS gy", "1 AS r", "2 AS g", "3 AS b", "id AS priority")
    carried = mosaic.merge_ranked(mosaic.ranked(pixels))
    for _ in range(3):
        carried = mosaic.halve_level(mosaic.finish_level([carried]))
    assert plan_of(carried).count("Exchange hashpartitioning") == 1 + 3


def test_partition_numbers():
    assert tiles.partitions_for(10**9, 256) == 10**9 * 3 * 256 * 256 // 2**28

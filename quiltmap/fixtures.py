"""Rasters made from the test tables: see FIXTURES.md for the same rules as SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quiltmap.functions.grid import GridBounds

TILE = 8
MIN_ZOOM, ZOOMS = 10, 3


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _ncols(image_id) -> Column:
    return (F.pmod(image_id, F.lit(3)) + 1).cast("int")


def _nrows(image_id) -> Column:
    return (F.pmod(image_id, F.lit(2)) + 1).cast("int")


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One image per supplier: a rectangle of tiles at zoom 10, 11 or 12 over one shared area."""
    supplier = table(spark, sf_dir, "supplier")
    how_many = supplier.agg(F.count(F.lit(1))).scalar()
    key, depth = F.col("s_suppkey"), F.pmod("s_nationkey", F.lit(ZOOMS))
    deeper = F.pow(F.lit(2), depth).cast("bigint")
    return supplier.select(
        key.alias("image_id"),
        key.alias("ord"),
        (how_many - 1 - key).alias("priority"),
        (MIN_ZOOM + depth).cast("int").alias("zoom"),
        ((512 + F.pmod(key, F.lit(16))) * deeper).cast("int").alias("col_min"),
        ((384 + F.pmod(key * 5, F.lit(16))) * deeper).cast("int").alias("row_min"),
        _ncols(key).alias("ncols"),
        _nrows(key).alias("nrows"),
    )


def grid_bounds() -> GridBounds:
    """Bounds of a row of ``images``."""
    c, r = F.col("col_min"), F.col("row_min")
    return GridBounds(c, r, c + F.col("ncols") - 1, r + F.col("nrows") - 1)


def pixels(spark: SparkSession, sf_dir: str, with_corner: bool = False) -> DataFrame:
    """One pixel per image cell that any line item falls on, on request with its image's corner and ``sx, sy``.

    An image has at most 24 x 16 cells, so line items are reduced to cells before they meet
    the image table: a supplier with a third of all line items sends a few hundred rows on.
    """
    supp, part, order = F.col("l_suppkey"), F.col("l_partkey"), F.col("l_orderkey")
    cells = (
        table(spark, sf_dir, "lineitem")
        .groupBy(
            supp.alias("image_id"),
            (part % (_ncols(supp) * TILE)).cast("int").alias("x"),
            (order % (_nrows(supp) * TILE)).cast("int").alias("y"),
        )
        .agg(
            F.max((F.col("l_quantity").cast("int") * 7 % 11 * 25).cast("int")).alias("r"),
            F.max(((F.col("l_linenumber") * 37 + part) % 256).cast("int")).alias("g"),
            F.max((order % 5 * 50).cast("int")).alias("b"),
        )
    )
    placed = images(spark, sf_dir).select("image_id", "priority", "zoom", "col_min", "row_min")
    corner = ["col_min", "row_min", F.col("x").alias("sx"), F.col("y").alias("sy")] if with_corner else []
    return cells.join(placed, "image_id").select(
        "image_id",
        "priority",
        "zoom",
        (F.col("col_min") * TILE + F.col("x")).alias("gx"),
        (F.col("row_min") * TILE + F.col("y")).alias("gy"),
        "r",
        "g",
        "b",
        *corner,
    )


def packed_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each embedding as an 8 x 8 tile of one band, bytes packed in a binary."""
    two_digits = lambda v: F.lpad(F.hex(F.floor((v.cast("double") + 1.0) * 127.5).cast("bigint")), 2, "0")
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("image_id"),
        F.col("vec_id").alias("priority"),
        F.lit(12).alias("zoom"),
        F.pmod("vec_id", F.lit(4096)).cast("int").alias("col"),
        F.floor(F.col("vec_id") / 4096).cast("int").alias("row"),
        F.array(F.unhex(F.concat_ws("", F.transform("embedding", two_digits)))).alias("bands"),
    )


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    event = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        "event_id",
        (event * 7919 % 36000 / 100.0 - 180.0).alias("lon"),
        (event * 104729 % 17000 / 100.0 - 85.0).alias("lat"),
    )


def resolutions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", (F.col("p_retailprice") / 1000.0).alias("res"))

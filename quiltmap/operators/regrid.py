"""Re-keying pixels: windows of an image, and big tiles to small ones. No row moves."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quiltmap.functions.grid import RETILE_WINDOW
from quiltmap.functions.uris import piece_name


def retile(pixels: DataFrame, keep: list[str], uri: str, window: int = RETILE_WINDOW) -> DataFrame:
    """Cuts an image into windows; ``sx, sy`` become the window's key and the place inside it."""
    return pixels.select(
        *keep,
        F.floor(F.col("sx") / window).cast("int").alias("piece_col"),
        F.floor(F.col("sy") / window).cast("int").alias("piece_row"),
        F.pmod("sx", F.lit(window)).cast("int").alias("x"),
        F.pmod("sy", F.lit(window)).cast("int").alias("y"),
        "r",
        "g",
        "b",
        uri,
    ).select("*", piece_name(uri, "piece_row", "piece_col").alias("piece")).drop(uri)


def split_tiles(pixels: DataFrame, keep: list[str], across: int, small_tile: int) -> DataFrame:
    """A tile of ``across * small_tile`` pixels to ``across * across`` small ones, deeper by log2(across)."""
    return pixels.select(
        *keep,
        (F.col("zoom") + F.round(F.log2(F.lit(float(across)))).cast("int")).alias("zoom"),
        F.floor(F.col("gx") / small_tile).cast("int").alias("col"),
        F.floor(F.col("gy") / small_tile).cast("int").alias("row"),
        F.pmod("gx", F.lit(small_tile)).cast("int").alias("x"),
        F.pmod("gy", F.lit(small_tile)).cast("int").alias("y"),
        "r",
        "g",
        "b",
    )

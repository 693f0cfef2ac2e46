"""Finding and reading tiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The path pattern and the extensions of tile files.
TILE_PATH = r".*/(\d+)/(\d+)/(\d+)\.\w+$"
TILE_GLOB = "*.{tif,TIF,tiff,TIFF}"


def tile_files(spark: SparkSession, folder: str) -> DataFrame:
    """Paths of the tile files below a folder; file contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", TILE_GLOB)
    return found.load(folder.rstrip("/") + "/").select("path")


def no_directories(paths: DataFrame, path: str = "path") -> DataFrame:
    return paths.where(~F.col(path).endswith("/"))


def tile_index(paths: DataFrame, zoom, keep: list[str] | None = None, path: str = "path") -> DataFrame:
    """Keys of the paths ending in ``/z/x/y.ext``, for the tiles of one zoom (a number or a column)."""
    parts = [F.regexp_extract(path, TILE_PATH, i) for i in (1, 2, 3)]
    wanted = zoom if not isinstance(zoom, int) else F.lit(zoom)
    return (
        paths.where(F.col(path).rlike(TILE_PATH))
        .where(parts[0].cast("int") == wanted)
        .select(*(keep or []), parts[0].cast("int").alias("zoom"), parts[1].cast("int").alias("col"), parts[2].cast("int").alias("row"), path)
    )


def region_scan(spark: SparkSession, path: str, schema, zoom: int, bounds: tuple[int, int, int, int]) -> DataFrame:
    """Tiles of one zoom from ``col_min, row_min`` to ``col_max, row_max``; parts of the table outside are skipped by their bounds."""
    col_min, row_min, col_max, row_max = bounds
    inside = F.col("col").between(col_min, col_max) & F.col("row").between(row_min, row_max)
    return tile_scan(spark, path, schema, zoom).where(inside)


def tile_scan(spark: SparkSession, path: str, schema, zoom: int) -> DataFrame:
    """Tiles of one zoom from a table partitioned by zoom; the other zooms are not touched."""
    return spark.read.schema(schema).parquet(path).where(F.col("zoom") == zoom)

"""Chunks as a table, finished tiles as PNG files."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quiltmap.functions.grid import morton_key
from quiltmap.operators import kernels
from quiltmap.operators.tiles import KEY, arrow_schema
from quiltmap.session import exists, removed, resolved, scratch_path, written_at

KEYS = "zoom int, col int, row int"
EXPORTED = r".*/(\d+)/(\d+)/(\d+)\.png(\.\w+\.part)?$"
PNG = "zoom int, col int, row int, png binary"


REGION_BITS = 6  # a region is 8 x 8 tiles


def write_chunks(chunks: DataFrame, path: str) -> None:
    """One folder per zoom, tiles along a space-filling curve; replaces what an earlier run wrote there.

    A region's tiles lie together: they are dealt by region and sorted by their key's place on the curve, so a file
    holds few regions and its parts have narrow bounds on ``col`` and ``row``, which a filter on either prunes by.
    Regions with very much are split, small ones share a file (both by size, at run time).
    """
    curve = chunks.withColumn("_curve", morton_key("col", "row")).withColumn("_region", F.shiftright("_curve", REGION_BITS))
    dealt = curve.hint("rebalance", F.col("zoom"), F.col("_region")).sortWithinPartitions("zoom", "_curve")
    dealt.drop("_curve", "_region").write.mode("overwrite").partitionBy("zoom").parquet(path)


def encode_png(tiles: DataFrame, dim: int, skip_blank: bool = False) -> DataFrame:
    schema = StructType.fromDDL(PNG)
    needed = tiles.select("zoom", "col", "row", "bands")
    return needed.mapInArrow(kernels.encode_each(dim, skip_blank, arrow_schema(schema)), schema)


def pyramid_export(tiles: DataFrame, target: str, dim: int, skip_blank: bool = False) -> int:
    """Writes ``target/z/x/y.png`` and returns how many, to a shared folder or any store the Arrow file systems know.

    Tiles are encoded and written where they are read: no image leaves its task but to its file. A tile's path
    depends on its key only, so a task that runs twice writes the same files again. Only when all are written are
    files of an earlier run removed whose keys are not among the new ones, and parts that a lost task left.
    """
    spark = tiles.sparkSession
    target = resolved(spark, target)
    needed = tiles.select("zoom", "col", "row", "bands")
    write = png_writer(target, kernels.encode_each(dim, skip_blank, arrow_schema(StructType.fromDDL(PNG))))
    scratch = scratch_path(spark, "exported")
    keys = written_at(needed.mapInArrow(write, KEYS), scratch)
    files, count = exported_files(spark, target), keys.count()
    if files is not None:
        stale = files.join(keys, KEY, "left_anti")
        stale.select("path").mapInArrow(file_remover, "removed bigint").agg(F.sum("removed")).collect()
    removed(spark, scratch)
    return count


def exported_files(spark: SparkSession, target: str) -> DataFrame | None:
    """``zoom, col, row, path`` of the tile files and unfinished parts below a folder; the key of a part is null."""
    if not exists(spark, target):
        return None
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.{png,part}").load(target)
    parts = [F.regexp_extract("path", EXPORTED, i) for i in range(1, 5)]
    key = [F.when(parts[3] == "", p.cast("int")).alias(name) for p, name in zip(parts, KEY, strict=False)]
    return found.where(F.col("path").rlike(EXPORTED)).select(*key, "path")


def file_remover(batches):
    from pyarrow import fs

    for batch in batches:
        for path in batch.column(0).to_pylist():
            store, at = fs.FileSystem.from_uri("file://" + path.removeprefix("file:") if path.startswith("file:/") and not path.startswith("file://") else path)
            if store.get_file_info(at).type == fs.FileType.File:
                store.delete_file(at)
        yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["removed"])


def png_writer(target: str, encode):
    def write(batches):
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(target)
        local, folders = isinstance(store, fs.LocalFileSystem), set()
        for batch in encode(batches):
            done = batch.to_pylist()
            for row in done:
                folder = f"{root}/{row['zoom']}/{row['col']}"
                path = f"{folder}/{row['row']}.png"
                if local and folder not in folders:  # stores have no folders
                    store.create_dir(folder, recursive=True)
                    folders.add(folder)
                part = f"{path}.{uuid.uuid4().hex}.part" if local else path
                with store.open_output_stream(part) as out:
                    out.write(row["png"])
                if local:
                    store.move(part, path)
            yield pa.RecordBatch.from_arrays([pa.array([row[name] for row in done], pa.int32()) for name in KEY], KEY)

    return write

"""The pyramid: every level from the deepest input zoom up to ``min_zoom``."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quiltmap.operators.mosaic import finish_level, halve_level, merge_ranked, ranked, union_inputs
from quiltmap.operators.tiles import MERGED, as_merged, combined, fold_levels, partitions_for, split_packed, tile_load
from quiltmap.session import exists, marked, removed, replaced, scratch_path, written_at

PIXELS_OUT = "zoom int, gx int, gy int, r int, g int, b int, priority bigint"
LEVELS_PER_JOB = 3


def input_zooms(inputs: DataFrame) -> list[int]:
    """The distinct zooms: at most a few dozen values."""
    zooms = sorted((row.zoom for row in inputs.select("zoom").distinct().collect()), reverse=True)
    refuse_zoom_zero(zooms)
    return zooms


def refuse_zoom_zero(zooms: list[int]) -> None:
    if zooms and min(zooms) < 1:
        raise ValueError("an input at zoom 0 has no place in the pyramid, whose top is zoom 1")


def zoom_plan(inputs: DataFrame, min_zoom: int = 1) -> DataFrame:
    """From each input zoom, the next one to stop at on the way up."""
    per_zoom = inputs.select("zoom").distinct()
    return per_zoom.select(
        F.col("zoom").alias("z1"), F.lead("zoom", 1, min_zoom).over(Window.orderBy(F.desc("zoom"))).alias("z2")
    )


def level_jobs(zooms: list[int], min_zoom: int, size: int) -> list[list[int]]:
    levels = list(range(zooms[0], min_zoom - 1, -1))
    return [levels[i : i + size] for i in range(0, len(levels), size)]


def save(levels: DataFrame, path: str, first: bool) -> None:
    """Adds finished levels to the table; the first job clears what an earlier run left there."""
    levels.write.mode("overwrite" if first else "append").partitionBy("zoom").parquet(path)


def pyramid(
    pixels: DataFrame,
    min_zoom: int = 1,
    path: str | None = None,
    stage: bool = True,
    levels_per_job: int = LEVELS_PER_JOB,
) -> DataFrame:
    """Builds and saves all levels as a table partitioned by zoom, and returns it.

    ``stage`` writes the inputs once, merged and partitioned by zoom, so that each level reads
    only its own. Turn it off when ``pixels`` already comes from such a table. A job covers a few
    levels; the levels inside it share their shuffles, and the next job starts from the written
    table, so a lost executor costs at most one job's work.
    """
    spark = pixels.sparkSession
    scratch = scratch_path(spark, "natives")
    natives = written_at(merge_ranked(ranked(pixels)), scratch, "zoom") if stage else None
    zooms = input_zooms(natives if stage else pixels)
    path, built = path or scratch_path(spark, "pyramid"), scratch_path(spark, "building") if path is None else f"{path}-building"
    saved = spark.read.schema(PIXELS_OUT)
    if not zooms or zooms[0] < min_zoom:
        removed(spark, scratch)
        return published(spark, built, path, PIXELS_OUT)
    carried = None
    for job in level_jobs(zooms, min_zoom, levels_per_job):
        levels = []
        for z in job:
            sides = [] if carried is None else [carried]
            if z in zooms and stage:
                sides.append(natives.where(F.col("zoom") == z))
            elif z in zooms:
                sides.append(merge_ranked(ranked(pixels.where(F.col("zoom") == z))))
            level = finish_level(sides)
            levels.append(level.selectExpr(f"{z} AS zoom", "gx", "gy", "r", "g", "b", "priority"))
            carried = halve_level(level)
        save(union_inputs(levels), built, first=job[0] == zooms[0])
        last = saved.parquet(built).where(F.col("zoom") == job[-1])
        carried = halve_level(last.selectExpr("shiftright(gx, 1) AS px", "shiftright(gy, 1) AS py", "r", "g", "b", "priority"))
    replaced(spark, built, path)
    removed(spark, scratch)
    return saved.parquet(path)


def published(spark: SparkSession, built: str, path: str, schema: str) -> DataFrame:
    """An empty pyramid in the place of an earlier one."""
    save(spark.createDataFrame([], schema), built, first=True)
    replaced(spark, built, path)
    return spark.read.schema(schema).parquet(path)


class Progress:
    """The finished jobs of a pyramid, marked beside its unfinished levels, so that a second run goes on from there.

    A run goes on only from one of the same plan over the same files. Inputs that do not come from files have no
    name that says whether they changed, so they start anew.
    """

    def __init__(self, tiles: DataFrame, built: str, plan: list):
        self.spark, self.built, self.log = tiles.sparkSession, built, f"{built}-log"
        files = sorted(tiles.inputFiles())
        self.kept = bool(files)
        self.mark = f"{self.log}/{hashlib.sha256(json.dumps([files, plan]).encode()).hexdigest()}"
        if not (self.kept and exists(self.spark, self.mark) and exists(self.spark, built)):
            self.clear()
            removed(self.spark, built)

    def clear(self) -> None:
        removed(self.spark, self.log)

    def done(self, job: list[int]) -> bool:
        return self.kept and exists(self.spark, f"{self.mark}/{job[0]}-{job[-1]}")

    def add(self, job: list[int]) -> None:
        if self.kept:
            marked(self.spark, f"{self.mark}/{job[0]}-{job[-1]}")


def pyramid_tiles(
    tiles: DataFrame,
    dim: int,
    across: int = 1,
    min_zoom: int = 1,
    path: str | None = None,
    levels_per_job: int = LEVELS_PER_JOB,
    orders: bool = True,
    version: int | str | None = None,
) -> DataFrame:
    """The same pyramid on packed tiles, normally a table partitioned by zoom.

    Input tiles ``across`` times as wide as ``dim`` are split on the way in, after the table's zoom
    filter. A job finishes a few levels with one shuffle and leaves its last level halved, a quarter of
    the pixels, for the next one; that is all that a job reads of those before it. Without ``orders`` the
    finished tiles carry no priorities. With ``path``, a run over the same files goes on after the last job
    that an interrupted one finished, if ``version`` (of what else the tiles were made from) is the same too.
    """
    spark = tiles.sparkSession
    offset = across.bit_length() - 1
    load = tile_load(tiles)
    zooms = [z.zoom + offset for z in load]
    refuse_zoom_zero(zooms)
    path, built = path or scratch_path(spark, "pyramid"), scratch_path(spark, "building") if path is None else f"{path}-building"
    saved = spark.read.schema(MERGED)
    if not zooms or zooms[0] < min_zoom:
        removed(spark, f"{built}-log")
        return published(spark, built, path, MERGED)
    progress = Progress(tiles, built, [dim, across, min_zoom, levels_per_job, orders, version, load])
    carried, quarters = 0, []
    for job in level_jobs(zooms, min_zoom, levels_per_job):
        hi, lo = job[0], job[-1]
        here = [z for z in load if lo <= z.zoom + offset <= hi]
        own = sum(z.tiles for z in here) * across * across
        if not progress.done(job):
            size = partitions_for(own + carried, dim)
            sides = []
            if here:
                natives = as_merged(tiles.where(F.col("zoom").between(lo - offset, hi - offset)))
                if across > 1:
                    natives = split_packed(natives, across)
                sides.append(combined(natives))
            if quarters:
                sides.append(saved.parquet(built).where(F.col("zoom") == -(hi + 1)).withColumn("zoom", F.lit(hi + 1)))
            save_job(fold_levels(union_inputs(sides), hi, lo, dim, size, orders, carry=lo > min_zoom), built)
            progress.add(job)
        if lo > min_zoom:
            quarters.append(lo)
        carried = (carried + own) // 4 ** (hi - lo)  # about what the last level holds
    for zoom in quarters:
        removed(spark, f"{built}/zoom={-zoom}")
    replaced(spark, built, path)
    progress.clear()
    return saved.parquet(path)


def save_job(levels: DataFrame, built: str) -> None:
    """Adds the levels of one job; what an interrupted run left of them is replaced."""
    levels.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("zoom").parquet(built)

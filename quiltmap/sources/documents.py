"""Job requests and manifests: JSON documents to one row per image."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quiltmap.schemas import MANIFEST_FIELDS, MANIFEST_LINE, REQUEST_FIELDS


def _required(df: DataFrame, record: str, names: list[str], what: str) -> DataFrame:
    """Fails the job where the record misses a field.

    The record itself is guarded, so that no filter on its fields can run before the check, and
    the rows are filtered by the same check, so that it runs even if no field is read.
    """
    missing = reduce(Column.__or__, [F.col(f"{record}.{n}").isNull() for n in names])
    report = F.raise_error(F.lit(f"{what} needs {', '.join(names)}"))
    guarded = F.when(missing, report.cast(df.schema[record].dataType)).otherwise(F.col(record))
    checked = df.where(F.when(missing, report.cast("boolean")).otherwise(F.lit(True)))
    return checked.withColumn(record, guarded)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Each file as one ``value``."""
    return spark.read.text(path, wholetext=True)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Each line, one record of a manifest, as one ``value``."""
    return spark.read.text(path)


def whole(value: str, schema: str) -> Column:
    """The one document of a text; null, which no reader takes, where there is more or less than one."""
    parsed = F.from_json(F.concat(F.lit("["), value, F.lit("]")), f"array<struct<{schema}>>", {"mode": "PERMISSIVE"})
    return F.when(F.size(parsed) == 1, parsed[0])


def request_images(documents: DataFrame) -> DataFrame:
    """Requests (JSON in ``value``, one each) to one row per image, numbered in request order."""
    parsed = documents.select(whole("value", REQUEST_FIELDS).alias("d"))
    checked = _required(parsed, "d", ["jobId", "target", "images", "workspace"], "a job request").select("d.*")
    return checked.select(
        F.col("jobId").alias("job_id"), "target", "workspace", F.posexplode("images").alias("ord", "source_uri")
    )


def manifest_inputs(documents: DataFrame) -> DataFrame:
    """Manifests to one row per input; the first input gets the highest priority.

    ``value`` is a whole manifest with its array of inputs, or one record per input with its position.
    """
    line = F.from_json("value", MANIFEST_LINE)
    parsed = documents.select("value", F.when(line.position.isNotNull(), line).alias("_line"))
    single = F.when(F.col("_line").isNull(), whole("value", MANIFEST_FIELDS))
    as_array = F.struct("_line.jobId", "_line.target", "_line.tileSize", F.array("_line.input").alias("input"))
    parsed = parsed.select("_line", F.when(F.col("_line").isNotNull(), as_array).otherwise(single).alias("d"))
    checked = _required(parsed, "d", ["jobId", "target", "tileSize", "input"], "a manifest").select("_line", "d.*")
    entries = checked.select(
        F.col("jobId").alias("job_id"),
        "target",
        F.col("tileSize").alias("tile_size"),
        F.coalesce("_line.position", F.lit(0)).alias("_first"),
        F.coalesce("_line.totalInputs", F.size("input").cast("bigint")).alias("_total"),
        F.posexplode("input").alias("_pos", "i"),
    )
    bounds = ["colMin", "rowMin", "colMax", "rowMax"]
    needed = ["sourceUri", "zoom", "tiles", *[f"gridBounds.{b}" for b in bounds]]
    entries = _required(entries, "i", needed, "a manifest input")
    position = F.col("_first") + F.col("_pos")
    return entries.select(
        "job_id",
        "target",
        "tile_size",
        position.alias("position"),
        (F.col("_total") - 1 - position).alias("priority"),
        F.col("i.sourceUri").alias("source_uri"),
        F.col("i.zoom").alias("zoom"),
        F.col("i.gridBounds.colMin").alias("col_min"),
        F.col("i.gridBounds.rowMin").alias("row_min"),
        F.col("i.gridBounds.colMax").alias("col_max"),
        F.col("i.gridBounds.rowMax").alias("row_max"),
        F.col("i.extent.xmin").alias("xmin"),
        F.col("i.extent.ymin").alias("ymin"),
        F.col("i.extent.xmax").alias("xmax"),
        F.col("i.extent.ymax").alias("ymax"),
        F.col("i.tiles").alias("tiles"),
    )

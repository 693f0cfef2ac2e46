"""Manifests and job records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quiltmap.functions.ranking import with_position
from quiltmap.schemas import JOB_STATUS
from quiltmap.session import job_folder


def manifest_entry() -> Column:
    bounds = F.struct(
        F.col("col_min").alias("colMin"), F.col("row_min").alias("rowMin"), F.col("col_max").alias("colMax"), F.col("row_max").alias("rowMax")
    )
    return F.struct(
        F.col("source_uri").alias("sourceUri"),
        F.struct("xmin", "ymin", "xmax", "ymax").alias("extent"),
        "zoom",
        bounds.alias("gridBounds"),
        F.col("folder").alias("tiles"),
    )


def manifest_json(sources: DataFrame, tie: str | None = None) -> DataFrame:
    """Image sources as JSON records, one per input, each with its place in request order (``ord``, then ``tie``).

    The form is the same for any number of inputs, and no row grows with the job.
    """
    record = F.struct(
        F.col("job_id").alias("jobId"),
        "target",
        F.col("tile_size").alias("tileSize"),
        "position",
        F.col("total").alias("totalInputs"),
        manifest_entry().alias("input"),
    )
    return with_position(sources, "job_id", "ord", tie).select("job_id", "position", F.to_json(record).alias("value"))


def write_manifest(sources: DataFrame, path: str, tie: str | None = None) -> None:
    """One line per input; replaces what an earlier run of the job wrote there."""
    manifest_json(sources, tie).select("value").write.mode("overwrite").text(path)


def append_status(spark: SparkSession, path: str, job_id: str, stage: str, status: str, **details: str) -> None:
    """Adds one record to the job_status table. ``details``: error, stack, target."""
    record = spark.range(1).select(
        F.lit(job_id).alias("jobId"),
        F.lit(stage).alias("stage"),
        F.lit(status).alias("status"),
        F.current_timestamp().cast("timestamp_ntz").alias("at"),
        *[F.lit(details.get(k)).cast("string").alias(k) for k in ("error", "stack", "target")],
    )
    record.write.mode("append").parquet(f"{path}/records")


def append_images(inputs: DataFrame, path: str) -> None:
    """Records the source images of a finished job, next to its records; a later run of the job replaces them."""
    for row in inputs.select("job_id").distinct().take(1):
        job_images(inputs).select("source_uri").write.mode("overwrite").parquet(job_folder(f"{path}/images", row.job_id))


def read_status(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(JOB_STATUS).parquet(f"{path}/records")


def read_images(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("source_uri string, job_id string").parquet(f"{path}/images").select("job_id", "source_uri")


def latest_status(records: DataFrame, by: list[str], at: list[str], values: list[str]) -> DataFrame:
    """The last record per job and stage."""
    last = F.max_by(F.struct(*values), F.struct(*at)).alias("_last")
    return records.groupBy(*by).agg(last, F.count(F.lit(1)).alias("updates")).select(*by, "_last.*", "updates")


def job_images(inputs: DataFrame) -> DataFrame:
    """The distinct source images of each job, for its finish record."""
    return inputs.select("job_id", "source_uri").distinct()

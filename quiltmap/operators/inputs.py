"""The list of inputs: grouping, ordering, ranking."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quiltmap.functions.grid import grid_size
from quiltmap.functions.ranking import with_position
from quiltmap.operators.cover import row_bounds


def order_inputs(inputs: DataFrame) -> DataFrame:
    return inputs.orderBy("job_id", "ord")


def priority_rank(inputs: DataFrame) -> DataFrame:
    """The first input of a job gets the highest priority, the last one 0."""
    return with_position(inputs, "job_id", "ord").withColumn("priority", F.col("total") - 1 - F.col("position")).drop("total")


def group_by_zoom(inputs: DataFrame) -> DataFrame:
    return inputs.groupBy("zoom").agg(F.count(F.lit(1)).alias("inputs"), F.sum(grid_size(row_bounds())).alias("tiles"))


def max_zoom(inputs: DataFrame) -> DataFrame:
    return inputs.agg(F.max("zoom").alias("zoom"))


def distinct_sources(inputs: DataFrame) -> DataFrame:
    return inputs.select("source_uri").distinct()


def collect_image_sources(pieces: DataFrame, by: list[str]) -> DataFrame:
    """Per image: how many pieces it was cut into, and the rectangle of tiles they cover together."""
    return pieces.groupBy(*by).agg(
        F.count(F.lit(1)).alias("pieces"),
        F.min("col_min").alias("col_min"),
        F.min("row_min").alias("row_min"),
        F.max("col_max").alias("col_max"),
        F.max("row_max").alias("row_max"),
    )

"""Session helpers: where intermediate tables go, and how they are written."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it gets one temporary folder for its lifetime.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that every executor can reach")
    own = tempfile.mkdtemp(prefix="quiltmap-")
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Writes the frame to a table in the shared folder and reads it back: lineage ends here."""
    return written_at(df, scratch_path(df.sparkSession, name), partition_by)


def written_at(df: DataFrame, path: str, partition_by: str | None = None) -> DataFrame:
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *keys: str, at_least: int = 0) -> DataFrame:
    """Hash-partitions work that is far larger than the rows that stand for it.

    Packed tiles and tile blocks are small for what a task does with them, so the number of
    partitions is fixed and not reduced by their bytes: the session's, or more where it is known
    how much there is.
    """
    return df.repartition(max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), at_least), *keys)


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path in it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def removed(spark: SparkSession, path: str) -> None:
    """Deletes a table or folder, if it is there."""
    store, at = file_system(spark, path)
    store.delete(at, True)


def exists(spark: SparkSession, path: str) -> bool:
    store, at = file_system(spark, path)
    return store.exists(at)


def marked(spark: SparkSession, path: str) -> None:
    """Leaves an empty file."""
    store, at = file_system(spark, path)
    store.create(at, True).close()


def replaced(spark: SparkSession, built: str, path: str) -> None:
    """Puts a finished table in the place of an older one, which is set aside until the new one is there."""
    store, at = file_system(spark, path)
    aside = file_system(spark, f"{path}-replaced")[1]
    store.mkdirs(at.getParent())
    if store.exists(at):
        store.delete(aside, True)
        if not store.rename(at, aside):
            raise OSError(f"{path} could not be set aside")
    if not store.rename(file_system(spark, built)[1], at):
        raise OSError(f"{built} could not be moved to {path}")
    store.delete(aside, True)


def resolved(spark: SparkSession, path: str) -> str:
    """A path that means the same on every executor: with its scheme, and not of one machine on a cluster."""
    store, at = file_system(spark, path)
    whole = at.makeQualified(store.getUri(), store.getWorkingDirectory()).toString()
    if whole.startswith("file:") and "://" not in path and not path.startswith("file:") and not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"{path} is a folder of each machine: name a shared one with its scheme")
    return "file://" + whole.removeprefix("file:") if whole.startswith("file:/") and not whole.startswith("file://") else whole


def job_folder(path: str, job_id: str) -> str:
    """The partition folder of a job, with the characters escaped that Spark escapes."""
    escaped = re.sub(r"""[\x00-\x1f"#%'*/:=?\\\x7f{\[\]^]""", lambda m: f"%{ord(m[0]):02X}", job_id)
    return f"{path}/job_id={escaped}"

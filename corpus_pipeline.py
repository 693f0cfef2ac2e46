"""The corpus pipeline: documents in, packed training sequences out.

Each stage is one operator of ``quiltmap.llm``. It takes the documents its predecessor kept, its result is
written as Parquet in the shared folder, and the next stage reads that. All stages but the last return the
columns of ``documents``.

Every stage takes null and empty texts, nulls in any column, texts of any length, repeated rows and an empty
table: documents without words are clean, hold one empty line, are near copies of nothing, weigh nothing in the
mix (they come along with their block) and are one end-of-text token when packed. Repeated rows are
documents of their own; columns beyond those of ``documents`` are carried along by all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quiltmap.llm import line_dedup as lines
from quiltmap.llm import minhash_dedup as near
from quiltmap.llm import mixing, packing
from quiltmap.llm import toxicity as tox
from quiltmap.llm.common import Scratch, load, owned


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns the lexicon from the labels of these documents and drops documents scored 0.5 or more."""
    lexicon = tox.learn(docs, load(spark, sf_dir, "labels"))
    return tox.score(docs, lexicon, into="__score").where(F.col("__score") < 0.5).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes lines that ten or more documents share but for their first occurrence, and documents that had no other."""
    out = lines.line_dedup(docs, keep="first")
    emptied = (F.col("n_dropped") > 0) & ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return out.where(~emptied).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the smallest id, as often as its row comes; those without an id stay."""
    kept = near.near_dedup(docs).where("kept").select(F.col("doc_id").alias("__id")).distinct()
    return docs.join(kept, F.col("doc_id").eqNullSafe(F.col("__id")), "left_semi")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Draws the sources towards their weights; a document comes once for each copy that the mix takes."""
    return mixing.mix(docs).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens: one row for each piece of a document."""
    return packing.digest(packing.pack(docs, path=packing.default_path(), added=True))


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mix", mix),
    ("pack", pack),
]

#: The stages learn, hash and tokenise, which SQL does not express; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. A stage's table is dropped once the next has been written, its operator's own at once."""
    scratch = Scratch(spark, "pipeline")
    docs, before = load(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        with owned():
            docs = scratch.write(stage(spark, docs, sf_dir), name)
        if before:
            scratch.drop(before)
        before = name
    return docs

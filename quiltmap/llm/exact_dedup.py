"""Exact dedup by sorting contents.

Each task first folds the copies of a batch into one unit (normalised bytes, best row, number of rows),
so a text that a third of the rows hold leaves a task once per batch. Splitters sampled from the units
range-partition the normalised bytes by their beginning, then their digest: a splitter is short however long
the texts are, and texts with one long beginning in common are split too. An external sort of the whole bytes
puts equals next to each other, and neighbouring full comparisons end each run with the row that stays. Rows
find their run by the digest of its bytes.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quiltmap.llm.common import SPACE, Scratch, load, partitions, texts

#: Bytes of a text's beginning that range-partition it, with its digest. Samples of both go to the driver.
PREFIX = 32

UNIT = "norm binary, digest binary, chars long, best {id}, n long, members array<{id}>"


def better(a: tuple, b: tuple) -> tuple:
    """Of two (code points, id): more code points, then the smaller id; a null id comes last."""
    return max(a, b, key=lambda x: (x[0], x[1] is not None, -x[1] if x[1] is not None else 0))


def fold_copies(batches):
    """One row per distinct normalised text of a batch."""
    for batch in batches:
        ids = batch.column(0).to_pylist()
        length = pc.utf8_length(batch.column(1).fill_null("")).to_pylist()
        units: dict[bytes, list] = {}
        for key, chars, text in zip(ids, length, texts(batch.column(1)), strict=True):
            norm = (text or b"").translate(None, SPACE)
            unit = units.get(norm)
            if unit is None:
                units[norm] = [(chars, key), [key]]
            else:
                unit[0] = better(unit[0], (chars, key))
                unit[1].append(key)
        values = list(units.values())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(list(units), pa.binary()),
                pa.array([hashlib.sha256(x).digest() for x in units], pa.binary()),
                pa.array([v[0][0] for v in values], pa.int64()),
                pa.array([v[0][1] for v in values], batch.column(0).type),
                pa.array([len(v[1]) for v in values], pa.int64()),
                pa.array([v[1] for v in values], pa.list_(batch.column(0).type)),
            ],
            ["norm", "digest", "chars", "best", "n", "members"],
        )


def end_runs(batches):
    """From units sorted by normalised bytes: one row per run of equals, compared byte by byte."""
    run = None
    for batch in batches:
        out: dict[str, list] = {"digest": [], "keep": [], "size": []}

        def close(run, out=out):
            out["digest"].append(run[1])
            out["keep"].append(run[2][1])
            out["size"].append(run[3])

        for norm, digest, chars, best, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if run is not None and run[0] == norm:
                run = (norm, digest, better(run[2], (chars, best)), run[3] + n)
            else:
                if run is not None:
                    close(run)
                run = (norm, digest, (chars, best), n)
        kind = batch.column(3).type
        yield _runs(out, kind)
    if run is not None:
        yield _runs({"digest": [run[1]], "keep": [run[2][1]], "size": [run[3]]}, kind)


def _runs(out, kind):
    return pa.RecordBatch.from_arrays([pa.array(out["digest"], pa.binary()), pa.array(out["keep"], kind), pa.array(out["size"], pa.int64())], ["digest", "keep", "size"])


def exact_dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``<id_col>, keep_id, group_size, kept, digest`` for every row, dropped ones too.

    Texts are equal when identical without white space (U+0020, U+0009 to U+000D); null counts as empty,
    so null, empty and blank texts form one group. The row with the most code points stays, then the
    smallest id; a null id comes last. Repeated rows with one id are one kept row each: ``kept`` says that
    the row's id is the group's ``keep_id``. An empty table gives an empty one. Ids are integers; texts of any
    length are compared whole, and other columns do not matter.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "exact-dedup")
    kind = docs.schema[id_col].dataType.simpleString()
    units = scratch.write(docs.select(id_col, text_col).mapInArrow(fold_copies, UNIT.format(id=kind)), "units")
    runs = (
        units.select("norm", "digest", "chars", "best", "n")
        .repartitionByRange(partitions(spark), F.substring("norm", 1, PREFIX), "digest")
        .sortWithinPartitions("norm")
        .mapInArrow(end_runs, f"digest binary, keep {kind}, size long")
    )
    rows = units.select("digest", F.explode("members").alias("member"))
    return rows.join(runs, "digest").select(
        F.col("member").alias(id_col),
        F.col("keep").alias("keep_id"),
        F.col("size").alias("group_size"),
        F.col("member").eqNullSafe(F.col("keep")).alias("kept"),
        "digest",
    )


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup(load(spark, sf_dir, "documents"))
    return out.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text,
         translate(coalesce(text, ''), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '') AS norm
  FROM documents
), g AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY norm ORDER BY length(text) DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY norm) AS group_size
  FROM t
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM g
"""

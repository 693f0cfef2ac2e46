"""Line dedup with two Bloom filters: keys met once and keys met twice.

Pass 1 hashes the line keys of each document into the two filters. In pass 2 only lines whose key is
in the second filter (suspected repeats) are shuffled, for an exact count over their full keys and the
choice of the first occurrence. Pass 3 removes the confirmed lines. The filters have a fixed largest
size: beyond it more lines are suspected, and results stay exact.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quiltmap.llm.common import FILTER, SPACE, Scratch, apart, chunks, filter_bits, holds, in_small_batches, load, merged, put_twice, texts, tidily

#: Lines of a document that the filters are sized for.
LINES_EXPECTED = 16
MIN_DOCS, MIN_CHARS = 10, 1


def key_of(line: bytes) -> bytes:
    """The line with white space (U+0020, U+0009 to U+000D) stripped at both ends, A-Z lower-cased."""
    return line.strip(SPACE).lower()


def long_enough(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode("utf-8", "replace")) >= min_chars)


def keys_of(text: bytes | None, min_chars: int) -> dict[bytes, int]:
    """The distinct keys of a text with the number of the first line that has each."""
    out: dict[bytes, int] = {}
    for number, line in enumerate((text or b"").split(b"\n")):
        key = key_of(line)
        if key not in out and long_enough(key, min_chars):
            out[key] = number
    return out


def hashed(keys) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64)


def repeat_filter(docs: DataFrame, text_col: str, min_chars: int) -> np.ndarray:
    """The second filter: every key that two documents share is in it."""
    spark = docs.sparkSession
    bits = filter_bits(docs.count() * LINES_EXPECTED)

    @tidily("lines")
    def build(batches):
        once, twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                found = [k for t in texts(batch.column(0).slice(start, 512)) for k in keys_of(t, min_chars)]
                put_twice(once, twice, hashed(found))
        yield from chunks(once, twice)

    # a filter per task: as many tasks as cores, not one per split
    parts = docs.select(text_col).coalesce(spark.sparkContext.defaultParallelism).mapInArrow(build, FILTER)
    return merged(parts, bits, "twice")


def suspects(docs: DataFrame, twice, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """``id, number, key`` of the lines that may repeat: the first line of each key in each document."""

    @tidily("lines")
    def pick(batches):
        for batch in batches:
            ids, owner, number, key = batch.column(0), [], [], []
            for row, text in enumerate(texts(batch.column(1))):
                for k, n in keys_of(text, min_chars).items():
                    owner.append(row)
                    number.append(n)
                    key.append(k)
            if not key:
                continue
            keep = np.flatnonzero(holds(twice.value, hashed(key)))
            take = pa.array(keep)
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(np.asarray(owner)[keep])), pa.array(number, pa.int32()).take(take), pa.array(key, pa.binary()).take(take)], ["id", "number", "key"])

    return docs.select(id_col, text_col).mapInArrow(pick, f"id {docs.schema[id_col].dataType.simpleString()}, number int, key binary")


def line_dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, keep: str = "none") -> DataFrame:
    """The documents with every column, lines of repeated keys removed, and the columns ``n_lines, n_dropped`` added.

    A key of at least ``min_chars`` code points found in at least ``min_docs`` rows is repeated. With
    ``keep="none"`` all its lines go; with ``keep="first"`` the first line of the row with the smallest id
    stays. Null and empty texts are one empty line and come back empty. Rows with equal or null ids each
    count as a document and each keep the first line if theirs is the smallest id (null ids last).
    An empty table gives an empty one. Names of other columns do not matter, but ``n_lines`` and
    ``n_dropped`` are replaced.
    """
    if keep not in ("none", "first"):
        raise ValueError("keep is none or first")
    spark = docs.sparkSession
    in_small_batches(spark)
    scratch = Scratch(spark, "line-dedup")
    twice = spark.sparkContext.broadcast(repeat_filter(docs, text_col, min_chars))
    found = scratch.write(suspects(docs, twice, id_col, text_col, min_chars), "suspects")
    # min_by skips rows whose id is null only if all are: a null id sorts last
    repeated = found.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first")).where(F.col("n") >= min_docs)
    first = F.col("id").eqNullSafe(F.col("first")) if keep == "first" else F.lit(False)
    verdicts = (
        found.join(apart(repeated), "key")
        .groupBy("id")
        .agg(F.collect_set(F.struct(F.col("key"), first.alias("first"))).alias("__repeated"))
        .withColumnRenamed("id", "__id")
    )
    own = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    joined = docs.select(*own).join(verdicts, F.col(id_col).eqNullSafe(F.col("__id")), "left").drop("__id")
    schema = docs.select(*own).schema.add("n_lines", "long").add("n_dropped", "long")
    at = own.index(text_col)

    @tidily("lines")
    def clean(batches):
        for batch in batches:
            out, lines, dropped = [], [], []
            for text, repeated in zip(texts(batch.column(at)), batch.column(len(own)).to_pylist(), strict=True):
                parts = (text or b"").split(b"\n")
                lines.append(len(parts))
                if repeated:
                    gone = {r["key"]: r["first"] for r in repeated}
                    kept = []
                    for line in parts:
                        key = key_of(line)
                        if key not in gone:
                            kept.append(line)
                        elif gone[key]:
                            gone[key] = False
                            kept.append(line)
                    parts = kept
                dropped.append(lines[-1] - len(parts))
                out.append(b"\n".join(parts))
            columns = [batch.column(i) for i in range(len(own))]
            columns[at] = pa.array(out, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())], [*own, "n_lines", "n_dropped"])

    return joined.mapInArrow(clean, schema)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup(docs).select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS number
  FROM documents
), k AS (
  SELECT doc_id, number, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l
), r AS (
  SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10
)
SELECT doc_id, count(*) AS n_lines, count(r.key) AS n_dropped,
       sha256(coalesce(string_agg(CASE WHEN r.key IS NULL THEN line END, chr(10) ORDER BY number), '')) AS kept_sha256
FROM k LEFT JOIN r USING (key)
GROUP BY doc_id
"""

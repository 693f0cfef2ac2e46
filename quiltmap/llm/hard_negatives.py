"""Hard-negative mining by a secondary-sort shuffle.

Rows are dealt into parts, anchors into blocks, both of bounded size, and each block meets each part once. A
block's scores against a part are one matrix product, of which a task keeps only what can still count: per
anchor its best positives, later its best negatives inside each positive's window. What is left travels as packed
keys (anchor, descending score, id), is dealt by anchor and sorted within partitions, and one pass over each
sorted stream reads the result off: a positive opens its window, negatives that come after it and fall inside are
given out until the window has enough. The stream holds the open windows of one anchor, nothing else of it.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quiltmap.llm.common import Scratch, load, partitions

POSITIVES, NEGATIVES = 5, 10
#: Negatives score between these percentages of their positive's score.
LOW, HIGH = 30, 90
#: Components of a part and of a block of anchors (about, at most), and parts at least.
PART_VALUES, BLOCK_VALUES, PARTS = 1 << 22, 1 << 22, 32
#: Scores computed in one go.
SCORES = 1 << 21
EXACT = 1 << 53

KEYED = "anchor binary, key binary"
CHOSEN = f"id long, twin long, score long, {KEYED}"
#: A sorted stream puts positives before negatives of the same score.
POSITIVE, NEGATIVE = 0, 1
SIGN = 1 << 63


def anchor_bytes(anchor: int, twin: int) -> bytes:
    """An anchor in 16 bytes that sort as its id, then its twin."""
    return struct.pack(">QQ", anchor + SIGN, twin + SIGN)


def anchor_of(packed: bytes) -> tuple[int, int]:
    anchor, twin = struct.unpack(">QQ", packed)
    return anchor - SIGN, twin - SIGN


def packed_keys(score: np.ndarray, kind: int, ids: np.ndarray, twins: np.ndarray) -> pa.Array:
    """``descending score, kind, id, twin`` in 25 bytes that sort in that order."""
    out = np.zeros((len(score), 25), np.uint8)
    put = lambda values: values.astype(">u8").view(np.uint8).reshape(-1, 8)
    out[:, :8] = put(~(score.view(np.uint64) + np.uint64(SIGN)))
    out[:, 8] = kind
    out[:, 9:17] = put(ids.view(np.uint64) + np.uint64(SIGN))
    out[:, 17:] = put(twins.view(np.uint64) + np.uint64(SIGN))
    return pa.Array.from_buffers(pa.binary(25), len(score), [None, pa.py_buffer(out.tobytes())]).cast(pa.binary())


def key_of(packed: bytes) -> tuple[int, int, int]:
    """``score, kind, id`` of a packed key."""
    score, kind, key = struct.unpack(">QBQ", packed[:17])
    return SIGN - 1 - score, kind, key - SIGN


def matrix(column: pa.Array) -> np.ndarray:
    """Lists of equal length as rows."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of the rows of two matrices; refused where 64 bits could not hold them."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    largest = max(-int(a.min()), int(a.max())) * max(-int(b.min()), int(b.max())) * a.shape[1]
    if largest < EXACT:  # exact in double arithmetic
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    if largest >= SIGN:
        raise OverflowError("inner products of these vectors do not fit in 64 bits")
    return a @ b.T


def best(scores: np.ndarray, ids: np.ndarray, twins: np.ndarray, allowed: np.ndarray, count: int) -> np.ndarray:
    """Places of the ``count`` allowed rows of highest score, ties by smaller id and twin."""
    at = np.flatnonzero(allowed)
    if len(at) > count:
        least = np.partition(scores[at], len(at) - count)[len(at) - count]
        at = at[scores[at] >= least]
    return at[np.lexsort((twins[at], ids[at], -scores[at]))][:count]


def sides(table: pa.Table):
    """Ids, twins, labels and vectors of one side of a group."""
    table = table.combine_chunks()
    ids, twins, labels = (table.column(name).to_numpy() for name in ("id", "twin", "label"))
    return ids, twins, labels, matrix(table.column("vector").chunk(0))


def keyed_rows(found: list[tuple[bytes, int, np.ndarray, np.ndarray, np.ndarray]]) -> pa.Table:
    """Anchors with the scores, ids and twins of what was kept for them, as packed rows."""
    if not found:
        return pa.table({"anchor": pa.array([], pa.binary()), "key": pa.array([], pa.binary())})
    anchors = pa.array([a for a, _, scores, _, _ in found for _ in range(len(scores))], pa.binary())
    keys = pa.concat_arrays([packed_keys(scores, kind, ids, twins) for _, kind, scores, ids, twins in found])
    return pa.table({"anchor": anchors, "key": keys})


def rows_of_scores(anchors: np.ndarray, vectors: np.ndarray):
    """Each anchor's number and its scores against all vectors, in bounded pieces."""
    step = max(1, SCORES // max(len(vectors), 1))
    for start in range(0, len(anchors), step):
        for i, row in enumerate(products(anchors[start : start + step], vectors)):
            yield start + i, row


def local_positives(count: int):
    """Of one block and one part: per anchor its best rows of the same label."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return keyed_rows([])
        anchor, own, label, a = sides(left)
        ids, twins, labels, b = sides(right)
        found = []
        for i, scores in rows_of_scores(a, b):
            at = best(scores, ids, twins, (labels == label[i]) & ((ids != anchor[i]) | (twins != own[i])), count)
            if at.size:
                found.append((anchor_bytes(int(anchor[i]), int(own[i])), POSITIVE, scores[at], ids[at], twins[at]))
        return keyed_rows(found)

    return run


def window(score: int, low: int, high: int) -> tuple[int, int]:
    """The least and the greatest score between two percentages of a score; empty below 0."""
    return -(-low * score // 100), high * score // 100


def local_negatives(count: int, low: int, high: int):
    """Of one block and one part: per anchor the best rows of other labels inside the window of each positive score."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return keyed_rows([])
        anchor, own, label, a = sides(left)
        ids, twins, labels, b = sides(right)
        positives = left.column("positive").to_pylist()
        found = []
        for i, scores in rows_of_scores(a, b):
            other, wanted = labels != label[i], []
            for score in set(positives[i]):
                least, most = window(score, low, high)
                if least <= most:
                    wanted.append(best(scores, ids, twins, other & (scores >= least) & (scores <= most), count))
            at = np.unique(np.concatenate(wanted)) if wanted else np.zeros(0, np.int64)
            if at.size:
                found.append((anchor_bytes(int(anchor[i]), int(own[i])), NEGATIVE, scores[at], ids[at], twins[at]))
        return keyed_rows(found)

    return run


def in_order(rows: DataFrame) -> DataFrame:
    """Packed rows dealt by anchor and sorted within partitions by anchor, descending score, kind and id."""
    return rows.repartition(partitions(rows.sparkSession), "anchor").sortWithinPartitions("anchor", "key")


def first_positives(count: int):
    """From a sorted stream: the first ``count`` rows of each anchor."""

    def run(batches):
        anchor, seen = None, 0
        for batch in batches:
            keep = []
            for i, name in enumerate(batch.column(0).to_pylist()):
                anchor, seen = name, seen + 1 if name == anchor else 1
                if seen <= count:
                    keep.append(i)
            kept = batch.take(pa.array(keep, pa.int64()))
            who, scores = map(anchor_of, kept.column(0).to_pylist()), [key_of(k)[0] for k in kept.column(1).to_pylist()]
            ids, twins = list(zip(*who, strict=True)) or ((), ())
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in (ids, twins, scores)), *kept.columns], [f.split(" ")[0] for f in CHOSEN.split(", ")])

    return run


MINED = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def mined(count: int, low: int, high: int):
    """From a sorted stream: every positive opens its window, and each negative inside goes out under it until it has ``count``."""

    def run(batches):
        anchor, windows = None, []
        for batch in batches:
            out = []
            for name, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if name != anchor:
                    anchor, windows, number = name, [], anchor_of(name)[0]
                score, kind, key = key_of(packed)
                if kind == POSITIVE:
                    least, most = window(score, low, high)
                    windows.append([least, most, 0, key, score])
                    continue
                for w in windows:
                    if w[0] <= score <= w[1] and w[2] < count:
                        w[2] += 1
                        out.append((number, w[3], w[2], key, w[4], score))
                windows = [w for w in windows if w[2] < count and w[0] <= score]
            names = MINED.split(", ")
            columns = list(zip(*out, strict=True)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if " int" in n else pa.int64()) for c, n in zip(columns, names, strict=True)], [n.split(" ")[0] for n in names])

    return run


def whole_vectors(rows: DataFrame, id_col: str, label_col: str, vector_col: str) -> DataFrame:
    """``id, twin, label, vector`` of the rows that take part, each once: components as floor(256 x)."""
    component = lambda x: F.floor(x.cast("double") * 256).cast("long")
    bad = F.exists(vector_col, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    whole = rows.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vector_col).isNotNull()).where(~bad)
    vectors = whole.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label"), F.transform(vector_col, component).alias("vector"))
    return vectors.distinct().select("id", F.xxhash64("label", "vector").alias("twin"), "label", "vector")


def hard_negatives(
    rows: DataFrame,
    is_anchor,
    *,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for the rows that ``is_anchor`` (a condition on ``id``) picks.

    Scores are inner products of floor(256 x), exact. An anchor's positives are its first ``positives`` other rows of
    its label, highest score first, ties by smaller id; under each come the first ``negatives`` rows of another label
    that score ``low`` to ``high`` percent of it. Rows with a null id, label or vector, or a null or non-finite
    component, take no part. Equal rows (id, label, vector) count once; different rows of one id each count, are each
    other's candidates, and tie by a hash; each as an anchor gives its own rows. Vectors meet those of their own
    length only. An anchor without positives, or a positive without negatives, gives no rows. Ids and labels are
    integers, other columns do not matter, and an empty table gives an empty one. Products beyond 64 bits are refused.
    """
    if not 0 <= low <= high <= 100:
        raise ValueError("0 <= low <= high <= 100")  # so that a window never lies before its positive
    spark = rows.sparkSession
    scratch = Scratch(spark, "hard-negatives")
    vectors = scratch.write(whole_vectors(rows, id_col, label_col, vector_col), "vectors")
    anchors = scratch.write(vectors.where(is_anchor), "anchors")
    values = lambda some: some.agg(F.coalesce(F.sum(F.greatest(F.size("vector"), F.lit(1))), F.lit(0))).first()[0]
    parts, blocks = max(PARTS, -(-values(vectors) // PART_VALUES)), max(1, -(-values(anchors) // BLOCK_VALUES))
    place = lambda many: F.pmod(F.xxhash64("id", "twin"), F.lit(many)).cast("int")
    every = lambda many, name: F.explode(F.sequence(F.lit(0), F.lit(many - 1))).alias(name)
    meet, dims = ["part", "block", "dims"], F.size("vector").alias("dims")

    def against(some: DataFrame, kept) -> DataFrame:
        blocked = some.select("*", place(blocks).alias("block"), dims, every(parts, "part"))
        parted = vectors.select("*", place(parts).alias("part"), dims, every(blocks, "block"))
        left, right = (side.repartition(partitions(spark), *meet).groupBy(*meet) for side in (blocked, parted))
        return left.cogroup(right).applyInArrow(kept, KEYED)

    chosen = scratch.write(in_order(against(anchors, local_positives(positives))).mapInArrow(first_positives(positives), CHOSEN), "positives")
    scores = chosen.groupBy("id", "twin").agg(F.collect_list("score").alias("positive"))
    found = against(anchors.join(scores, ["id", "twin"]), local_negatives(negatives, low, high))
    return in_order(chosen.select("anchor", "key").union(found)).mapInArrow(mined(negatives, low, high), MINED)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", moved), F.col("id") % 100 == 0)


SQL = r"""
WITH v AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.id AS anchor_id, b.id, a.label = b.label AS same, CAST(list_dot_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.id % 100 = 0 AND a.id <> b.id AND len(a.e) = len(b.e)
), p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
), n AS (
  SELECT p.*, s.id AS negative_id, s.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank
  FROM p JOIN s USING (anchor_id)
  WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""

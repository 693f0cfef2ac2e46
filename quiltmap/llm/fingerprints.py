"""Document fingerprints by a randomised edit embedding.

A walk reads a text and writes each character a random number of times, by coin flips that all texts share
for a step and a character. Texts that differ by few edits meet again soon after each, so the edit distance
becomes a Hamming distance of what the walks wrote. A fingerprint samples that at shared positions: as many
in each octave of positions, so that texts of any length have one and long ones are covered to their end.
Likeness is the weighted share of equal samples. Near texts are found by bands of samples and verified.
"""

from __future__ import annotations

import functools
import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quiltmap.llm.common import Scratch, apart, load, partitions
from quiltmap.llm.components import components

#: Coin flips repeat after PERIOD steps; characters fall into CLASSES; samples of an octave of positions.
PERIOD, CLASSES, SAMPLES = 4096, 64, 64
#: Texts and characters that walk together; below so many texts a plain loop is faster.
GROUP_TEXTS, GROUP_CHARS, FEW = 1024, 3_000_000, 16
COLUMN = 512
DIGITS = np.frombuffer(b"0123456789abcdef-", np.uint8)
BANDS, BAND = 16, 6
#: Places drawn for each digit of a band, as some lie beyond a text's end.
SPARE = 8
#: Members outside a band's largest component that one turn compares with the band, about.
OUTSIDERS = 64


def _strides() -> np.ndarray:
    """How many steps a character of a class takes from each step: up to its next head."""
    heads = np.random.default_rng(9).integers(0, 2, (CLASSES, PERIOD), dtype=np.uint8)
    out = np.zeros((CLASSES, PERIOD), np.uint8)
    ahead = np.zeros(CLASSES, np.int64)
    for step in range(2 * PERIOD - 1, -1, -1):
        ahead = np.where(heads[:, step % PERIOD] == 1, 1, ahead + 1)
        out[:, step % PERIOD] = np.minimum(ahead, 255)
    return out.ravel()


STRIDES = _strides()
_STRIDE_BYTES = STRIDES.tobytes()


@functools.cache
def sampled(octave: int) -> np.ndarray:
    """The sampled positions of an octave: all of the first, else SAMPLES of [SAMPLES * 2^(octave-1), SAMPLES * 2^octave)."""
    if octave == 0:
        return np.arange(SAMPLES)
    low = SAMPLES << (octave - 1)
    return np.sort(np.random.default_rng(octave).choice(low, SAMPLES, replace=False) + low)


def octaves(length: int) -> int:
    return max(0, math.ceil(math.log2(length / SAMPLES))) + 1 if length else 0


def walk(codes: list[np.ndarray]) -> list[tuple[np.ndarray, int]]:
    """For each text the step at which each character is first written, and the steps in all."""
    order = sorted(range(len(codes)), key=lambda i: -len(codes[i]))
    length = np.asarray([len(codes[i]) for i in order])
    rows = [((codes[i] * np.uint32(0x9E3779B1)) >> np.uint32(26)) * np.uint32(PERIOD) for i in order]
    steps = [np.empty(n, np.int64) for n in length]
    now = np.zeros(len(order), np.int64)
    start = 0
    while len(length) and (active := int((length > start).sum())) >= FEW:
        block = np.zeros((active, COLUMN), np.int64)
        for k in range(active):
            part = rows[k][start : start + COLUMN]
            block[k, : len(part)] = part
        block = np.ascontiguousarray(block.T)
        out = np.empty_like(block)
        ends = np.searchsorted(-length[:active], -(start + np.arange(COLUMN)), side="left")
        for t in range(COLUMN):
            a = int(ends[t])
            if not a:
                break
            j = now[:a]
            out[t, :a] = j
            j += STRIDES.take(block[t, :a] + (j & (PERIOD - 1)))
        out = np.ascontiguousarray(out.T)
        for k in range(active):
            n = min(COLUMN, int(length[k]) - start)
            steps[k][start : start + n] = out[k, :n]
        start += COLUMN
    for k in range(int((length > start).sum()) if len(length) else 0):
        j, tail = int(now[k]), []
        for c in rows[k][start:].tolist():
            tail.append(j)
            j += _STRIDE_BYTES[c + (j & (PERIOD - 1))]
        steps[k][start:] = tail
        now[k] = j
    found: list = [None] * len(codes)
    for k, i in enumerate(order):
        found[i] = (steps[k], int(now[k]))
    return found


def symbols(codes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A digit for the two characters from each place."""
    padded = np.concatenate([codes, np.zeros(1, np.uint32)]).astype(np.uint64)
    h = padded[at] * np.uint64(0x100000001B3) + padded[at + 1]
    return ((h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(60)).astype(np.int64)


def fingerprints(some: list[str]) -> list[str]:
    """A digit per sample, ``-`` beyond the end; an empty text has an empty one. Equal texts have equal ones."""
    codes = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for t in some]
    out = []
    for code, (steps, total) in zip(codes, walk(codes), strict=True):
        if not total:
            out.append("")
            continue
        places = np.concatenate([sampled(o) for o in range(octaves(total))])
        digits = symbols(code, np.searchsorted(steps, places, side="right") - 1)
        digits[places >= total] = 16
        out.append(DIGITS[digits].tobytes().decode())
    return out


def likeness(a: str, b: str) -> float:
    """0 to 1: equal samples of those that either text has, weighted by the positions they stand for, less chance."""
    if a == b:
        return 1.0
    n = max(len(a), len(b))
    x, y = (np.frombuffer(s.ljust(n, "-").encode(), np.uint8) for s in (a, b))
    weight = weights(n)
    valid = (x != 45) | (y != 45)
    share = float((weight * (valid & (x == y))).sum() / (weight * valid).sum())
    return max(0.0, (share - 1 / 16) / (15 / 16))


def followed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows sorted inside ranges of ids, each range with the first rows of the next one (``look`` 1) at its end.

    The ranges come from quantiles of the ids; their first ids, one for each range, are all that the driver
    holds. So every row but those has its follower in its own partition, and texts are shuffled once.
    """
    spark = docs.sparkSession
    lowest = -(1 << 63)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(id_col).cast("long"), F.lit(lowest)).alias("key"), F.coalesce(text_col, F.lit("")).alias("text"))
    count = 4 * partitions(spark)
    cuts = rows.select(F.col("key").cast("double").alias("x")).approxQuantile("x", [i / count for i in range(1, count)], 0.25 / count)
    splits = [-math.inf, *sorted(set(cuts) or {0.0}), math.inf]
    range_of = Bucketizer(splits=splits, inputCol="x", outputCol="range")
    placed = range_of.transform(rows.withColumn("x", F.col("key").cast("double"))).withColumn("range", F.col("range").cast("int")).drop("x")
    heads = sorted((r["range"], r["head"]) for r in placed.groupBy("range").agg(F.min("key").alias("head")).collect())
    before = spark.createDataFrame([(head, heads[i - 1][0]) for i, (_, head) in enumerate(heads)], "head long, before int")
    looked = rows.join(F.broadcast(before), F.col("key") == F.col("head")).select("id", "key", "text", F.col("before").alias("range"), F.lit(1).alias("look"))
    both = placed.withColumn("look", F.lit(0)).select("range", "look", "id", "key", "text").union(looked.select("range", "look", "id", "key", "text"))
    return both.repartition(partitions(spark), "range").sortWithinPartitions("range", "look", "key", F.xxhash64("text"))


def edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compare(batches):
    """Each row's fingerprint beside those of its edited text and of the row that follows."""
    held: list[tuple] = []  # id, text, range, look
    kind = None

    def flush():
        """All but the last row, which is kept as the first of what follows."""
        own = [r for r in held[:-1]]
        after = [edited(r[1], held[i + 1][1]) for i, r in enumerate(own)]
        found = fingerprints([r[1] for r in held] + after)
        prints, changed = found[: len(held)], found[len(held) :]
        del held[:-1]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([r[0] for r in own], kind),
                pa.array([len(r[1]) for r in own], pa.int64()),
                pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in after], pa.string()),
                pa.array(prints[:-1], pa.string()),
                pa.array(changed, pa.string()),
                pa.array([likeness(a, b) for a, b in zip(prints, changed, strict=False)], pa.float64()),
                pa.array([likeness(a, b) for a, b in zip(prints, prints[1:], strict=False)], pa.float64()),
            ],
            ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        )

    chars = 0
    for batch in batches:
        kind = batch.schema.field(2).type
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            for span, look, own, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2).to_pylist(), part.column(4).to_pylist(), strict=True):
                if held and held[-1][3]:
                    if held[-1][2] == span:
                        continue  # a range needs one row to look ahead to
                    held.clear()
                    chars = 0
                held.append((own, text, span, look))
                chars += 2 * len(text)
                if len(held) > 1 and (look or len(held) > GROUP_TEXTS or chars > GROUP_CHARS):
                    yield flush()
                    chars = len(text)


def edit_fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``<id_col>, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` for every row.

    The edited text has its last floor(n/2) code points replaced by the first as many of the next row by id
    (nulls first, equal ids by the hash of their text; after the last comes the first). Null counts as empty; a
    single row is its own next. Likeness is 1 for equal texts. An empty table gives an empty one.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return followed(docs, id_col, text_col).mapInArrow(compare, schema).withColumnRenamed("id", id_col)


def weights(size: int) -> np.ndarray:
    """The positions that each sample of a fingerprint stands for."""
    return np.repeat(np.asarray([1, *(1 << max(0, o - 1) for o in range(1, size // SAMPLES))], float), SAMPLES)


@functools.cache
def band_places(size: int) -> np.ndarray:
    """The samples that each band may take from a fingerprint of so many, drawn by their weights."""
    ends = np.cumsum(weights(size))
    return np.searchsorted(ends / ends[-1], np.random.default_rng(3).random((BANDS, SPARE * BAND)), side="right")


def bands(print_: str) -> list[str]:
    """Bands of sampled digits, each from a text's last octaves or the one before, so near lengths share some.

    A band has the first digits of its places that lie within the text.
    """
    out = []
    for size in {len(print_), max(SAMPLES, len(print_) - SAMPLES)} if print_ else ():
        out += [f"{size}:{k}:" + "".join(c for p in row if (c := print_[p]) != "-")[:BAND] for k, row in enumerate(band_places(size).tolist())]
    return out


def alike(pairs: DataFrame, prints: DataFrame, least: float) -> DataFrame:
    """``a, b, likeness`` of the pairs ``a, b`` that are alike enough by their whole fingerprints ``id, print``."""
    first, second = (prints.select(F.col("id").alias(x), F.col("print").alias(f"{x}_print")) for x in "ab")
    both = pairs.join(second, "b").join(first, "a").select("a", "b", "a_print", "b_print")

    def verify(batches):
        for batch in batches:
            found = [likeness(x, y) for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.float64())], ["a", "b", "likeness"])

    kind = prints.schema["id"].dataType.simpleString()
    return both.mapInArrow(verify, f"a {kind}, b {kind}, likeness double").where(F.col("likeness") >= least)


def near_texts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least: float = 0.8) -> DataFrame:
    """``a, b, likeness``, ``a`` the smaller id: links between texts that share a band and whose whole fingerprints are alike.

    Any two such texts are linked, directly or by way of others. All texts of a band are compared with its smallest
    id; where that leaves several components in a band, those outside its largest are compared, in turns, with all
    of other components. So a band of near copies gives one row per text. Null ids are left out.
    """

    def prints(batches):
        for batch in batches:
            found = fingerprints([t or "" for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string()), pa.array([bands(f) for f in found], pa.list_(pa.string()))], ["id", "print", "bands"])

    scratch = Scratch(docs.sparkSession, "near-texts")
    kind = docs.schema[id_col].dataType.simpleString()
    own = docs.where(F.col(id_col).isNotNull()).select(id_col, text_col).mapInArrow(prints, f"id {kind}, print string, bands array<string>")
    own = scratch.write(own, "prints")
    keys = own.select("id", F.explode("bands").alias("band")).distinct()
    hubs = keys.groupBy("band").agg(F.min("id").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1")
    keys = scratch.write(keys.join(apart(hubs), "band").drop("n"), "keys")
    stars = scratch.write(alike(keys.where("id <> a").select("a", F.col("id").alias("b")).distinct(), own, least), "stars")
    labels = components(stars.select("a", "b"), scratch, "components").withColumnRenamed("node", "id")
    placed = scratch.write(keys.join(labels, "id", "left").select("band", "id", F.coalesce("root", "id").alias("root")), "placed")
    parts = placed.groupBy("band", "root").agg(F.count(F.lit(1)).alias("n"))
    mixed = parts.groupBy("band").agg(F.max_by("root", F.struct("n", "root")).alias("largest"), F.sum("n").alias("members"), F.max("n").alias("most")).where("most < members")
    turns = F.ceil((F.col("members") - F.col("most")) / OUTSIDERS)
    turn = F.when(F.col("root") != F.col("largest"), F.pmod(F.xxhash64("id"), turns)).cast("int")
    open_ = scratch.write(placed.join(apart(mixed), "band").select("band", "id", "root", turn.alias("turn")), "open")
    last = open_.agg(F.max("turn")).first()[0]
    links = stars
    for now in range(0 if last is None else last + 1):
        outsiders = open_.where(F.col("turn") == now).select("band", F.col("id").alias("hub"), F.col("root").alias("hub_root"))
        untested = F.col("turn").isNull() | (F.col("turn") > now) | ((F.col("turn") == now) & (F.col("id") > F.col("hub")))
        pairs = open_.join(outsiders, "band").where((F.col("root") != F.col("hub_root")) & untested)
        pairs = pairs.select(F.least("hub", "id").alias("a"), F.greatest("hub", "id").alias("b")).distinct()
        links = links.union(scratch.write(alike(pairs, own, least), f"links-{now}"))
    return links.distinct()


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_fingerprints(load(spark, sf_dir, "documents"))

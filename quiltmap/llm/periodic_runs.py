"""Periodic runs: stretches of words that repeat with a period, found by minimizers at doubling scales.

Short periods are found by comparing each word with the one so many places before it. For periods from w to
2w - 1 (w = 8, 16, 32, ...) every stretch of 2w words gets a hash, and of w consecutive hashes the smallest is
a minimizer. Inside a run of such a period that is four periods long, some minimizer comes again exactly one
period later, and never sooner: 2w words are longer than the period, so equal ones lie whole periods apart.
Each pair of neighbouring equal minimizers proposes a period, and comparing words extends it to the run. A hash
only proposes, so runs are exact. A document is handled where it lies; nothing is shuffled.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quiltmap.llm.common import load, mix, texts

#: Periods below are compared directly; the first scale.
SHORT = 8
#: Least length of a run in words and in periods.
MIN_WORDS, MIN_PERIODS = 6, 4
#: Words of whole documents that are searched in one go.
TOGETHER = 1 << 16

BASE = 0x9E3779B97F4A7C15
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
ADDED = "n_words long, runs array<struct<start: long, length: long, period: long>>, strongest struct<start: long, length: long, period: long>, collapsed string"
NAMES = ["n_words", "runs", "strongest", "collapsed"]


def powers(base: int, n: int) -> np.ndarray:
    """``base`` to the powers 0 to n - 1, modulo 2^64."""
    out = np.full(n, base % (1 << 64), np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def least_places(values: np.ndarray, width: int) -> np.ndarray:
    """Of each ``width`` (a power of two) neighbours, the place of the smallest, the first among equals."""
    place, low, span = np.arange(len(values)), values, 1
    while span < width:
        later = low[span:] < low[:-span]
        place = np.where(later, place[span:], place[:-span])
        low = np.where(later, low[span:], low[:-span])
        span *= 2
    return place


def seeds(sums: np.ndarray, back: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and distances of neighbouring equal minimizers that are ``width`` to ``2 * width - 1`` words apart."""
    long = 2 * width
    count = len(sums) - long
    if count < width:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    hashes = (sums[long:] - sums[:-long]) * back[:count]
    at = np.unique(least_places(hashes, width))
    at = at[np.argsort(hashes[at], kind="stable")]
    apart = np.diff(at)
    found = (hashes[at[1:]] == hashes[at[:-1]]) & (apart >= width) & (apart < long)
    return at[:-1][found], apart[found]


def lagged(ids: np.ndarray, period: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal stretches in which words ``period`` apart are equal."""
    same = np.zeros(len(ids) - period + 2, np.int8)
    same[1:-1] = ids[period:] == ids[:-period]
    edges = np.flatnonzero(np.diff(same))
    return edges[::2], edges[1::2] + period


def extended(ids: np.ndarray, at: int, period: int) -> tuple[int, int]:
    """The maximal stretch around a place in which words ``period`` apart are equal; empty if those at ``at`` differ."""
    end, step = at, 64
    while end < len(ids) - period:
        block = min(step, len(ids) - period - end)
        differ = np.flatnonzero(ids[end : end + block] != ids[end + period : end + period + block])
        if differ.size:
            end += int(differ[0])
            break
        end, step = end + block, step * 2
    if end == at:
        return at, at
    start, step = at, 64
    while start > 0:
        block = min(step, start)
        differ = np.flatnonzero(ids[start - block : start] != ids[start - block + period : start + period])
        if differ.size:
            start -= block - 1 - int(differ[-1])
            break
        start, step = start - block, step * 2
    return start, end + period


def has_shorter(ids: np.ndarray, start: int, period: int) -> bool:
    """Whether the unit of a stretch is itself a repetition."""
    left, factor = period, 2
    while left > 1:
        if factor * factor > left:
            factor = left
        if left % factor == 0:
            part = period // factor
            if np.array_equal(ids[start + part : start + period], ids[start : start + period - part]):
                return True
            while left % factor == 0:
                left //= factor
        factor += 1
    return False


def find_runs(ids: np.ndarray, longest: int, min_words: int, min_periods: int) -> list[tuple[int, int, int]]:
    """``start, length, period`` of every run of a sequence of word numbers, by start, then period."""
    out = []

    def keep(start, end, period):
        if end - start >= max(min_words, min_periods * period) and not has_shorter(ids, start, period):
            out.append((start, end - start, period))

    largest = longest // min_periods
    for period in range(1, min(SHORT - 1, largest) + 1):
        starts, ends = lagged(ids, period)
        enough = ends - starts >= max(min_words, min_periods * period)
        for start, end in zip(starts[enough].tolist(), ends[enough].tolist(), strict=True):
            keep(start, end, period)
    if largest >= SHORT:
        n = len(ids)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(mix(ids) * powers(BASE, n), dtype=np.uint64, out=sums[1:])
        back = powers(pow(BASE, -1, 1 << 64), n)
        width = SHORT
        while width <= largest:
            at, period = seeds(sums, back, width)
            reached = (0, 0)
            for i in np.lexsort((at, period)).tolist():
                here, far = int(at[i]), int(period[i])
                if reached[0] == far and here < reached[1]:
                    continue
                start, end = extended(ids, here, far)
                reached = (far, end - far)
                keep(start, end, far)
            width *= 2
    return sorted(out, key=lambda run: (run[0], run[2]))


def runs_of(documents: list[list[bytes]], min_words: int, min_periods: int) -> list[list[tuple[int, int, int]]]:
    """The runs of each document. All are searched as one sequence; a mark between two occurs once, so no run spans it."""
    numbers: dict[bytes, int] = {}
    ids = np.full(sum(map(len, documents)) + len(documents), -1, np.int64)
    offsets, at = [], 0
    for i, words in enumerate(documents):
        offsets.append(at)
        ids[at : at + len(words)] = [numbers.setdefault(w, len(numbers)) for w in words]
        at += len(words)
        ids[at] = -1 - i
        at += 1
    out: list[list[tuple[int, int, int]]] = [[] for _ in documents]
    found = find_runs(ids, max(map(len, documents), default=0), min_words, min_periods)
    owner = np.searchsorted(offsets, [r[0] for r in found], "right") - 1
    for i, (start, length, period) in zip(owner.tolist(), found, strict=True):
        out[i].append((start - offsets[i], length, period))
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words less those that a run contains after its first period."""
    if runs:
        kept = np.ones(len(words), bool)
        for start, length, period in runs:
            kept[start + period : start + length] = False
        words = [words[i] for i in np.flatnonzero(kept).tolist()]
    return b" ".join(words)


def together(documents: list[list[bytes]]) -> Iterator[list[list[bytes]]]:
    held, size = [], 0
    for words in documents:
        if held and size + len(words) > TOGETHER:
            yield held
            held, size = [], 0
        held.append(words)
        size += len(words)
    if held:
        yield held


def periodic_runs(docs: DataFrame, *, text_col: str = "text", min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS) -> DataFrame:
    """The documents with every column, and ``n_words, runs, strongest, collapsed`` added.

    Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0. A run is a maximal stretch with a smallest period q that
    is at least ``min_words`` words and ``min_periods`` (4 or more) times q long. ``runs`` lists them by start,
    then period; ``strongest`` has the greatest length / period, compared exactly (then the smallest start, then
    period; null without a run); ``collapsed`` joins by one space the words that no run contains after its first q.
    Null, empty and blank texts have no words, no runs and an empty ``collapsed``. Rows are independent of each
    other, so nulls and repeats in other columns do not matter; columns with the four added names are replaced.
    An empty table gives an empty one. A text of any length is one row and is handled whole, in memory linear in it.
    """
    if min_periods < 4:
        raise ValueError("minimizers are sure to meet in runs of four periods or more")
    own = [c for c in docs.columns if c not in NAMES]
    schema = docs.select(*own).schema
    for field in docs.sparkSession.createDataFrame([], ADDED).schema:
        schema = schema.add(field)
    at = own.index(text_col)
    as_struct = lambda run: dict(zip(("start", "length", "period"), run, strict=True))
    best = lambda runs: min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))

    def search(batches):
        for batch in batches:
            documents = [(t or b"").split() for t in texts(batch.column(at))]
            runs = [r for part in together(documents) for r in runs_of(part, min_words, min_periods)]
            added = [
                pa.array([len(words) for words in documents], pa.int64()),
                pa.array([[as_struct(r) for r in rs] for rs in runs], pa.list_(RUN)),
                pa.array([as_struct(best(rs)) if rs else None for rs in runs], RUN),
                pa.array([collapsed(words, rs) for words, rs in zip(documents, runs, strict=True)], pa.binary()).cast(pa.string()),
            ]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(own))), *added], [*own, *NAMES])

    return docs.select(*own).mapInArrow(search, schema)


def with_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, text``, with the end of every tenth document (by the checksum of its id) replaced by a repetition.

    A null id and a text without words leave the text as it is.
    """

    def repeat(batches):
        for batch in batches:
            out = []
            for key, text in zip(batch.column(0).to_pylist(), texts(batch.column(1)), strict=True):
                h = 1 if key is None else zlib.crc32(str(key).encode())
                words = (text or b"").split() if h % 10 == 0 else []
                if words:
                    n, g = len(words), h // 10
                    first = g % n
                    period = 1 + (n - first) // (3 + g % 8)
                    text = b" ".join(words[:first] + [words[first + i % period] for i in range(n - first)])
                out.append(text)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary()).cast(pa.string())], ["doc_id", "text"])

    return docs.select("doc_id", "text").mapInArrow(repeat, docs.select("doc_id", "text").schema)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_repeats(load(spark, sf_dir, "documents")))
    line = lambda r: F.concat_ws(",", r.start.cast("string"), r.length.cast("string"), r.period.cast("string"))
    listed = F.concat_ws("", F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("strongest.start").alias("start"),
        F.col("strongest.length").alias("length"),
        F.col("strongest.period").alias("period"),
        F.expr("strongest.length * 1000 div strongest.period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
             flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
           lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END)) AS h
  FROM documents
), p AS (
  SELECT doc_id, w, h, h // 10 AS g, len(w) AS n,
         CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a
  FROM d
), t AS (
  SELECT doc_id, n,
         CASE WHEN h % 10 = 0 AND n > 0
              THEN list_transform(range(n), lambda i: CASE WHEN i < a THEN w[i + 1] ELSE w[1 + a + (i - a) % (1 + (n - a) // (3 + g % 8))] END)
              ELSE w END AS w
  FROM p
), x AS (
  SELECT doc_id, n, unnest(w) AS word, unnest(range(n)) AS i FROM t
), m AS (
  SELECT u.doc_id, u.i, v.i - u.i AS q
  FROM x u JOIN x v ON u.doc_id = v.doc_id AND u.word = v.word AND v.i > u.i AND 4 * (v.i - u.i) <= u.n
), s AS (
  SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM m
), c AS (
  SELECT doc_id, q AS period, min(i) AS start, count(*) + q AS length
  FROM s GROUP BY doc_id, q, island HAVING count(*) + q >= greatest(6, 4 * q)
), r AS (
  SELECT * FROM c
  WHERE NOT EXISTS (SELECT 1 FROM c b WHERE b.doc_id = c.doc_id AND b.period < c.period AND c.period % b.period = 0
                    AND b.start <= c.start AND b.start + b.length >= c.start + c.length)
), b AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY CAST(length AS DOUBLE) / period DESC, start, period) AS place FROM r
), k AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS runs FROM r GROUP BY doc_id
), e AS (
  SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM r
), y AS (
  SELECT x.doc_id, string_agg(word, ' ' ORDER BY i) AS kept FROM x ANTI JOIN e USING (doc_id, i) GROUP BY x.doc_id
)
SELECT t.doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, length * 1000 // period AS exponent_milli,
       sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM t LEFT JOIN k USING (doc_id) LEFT JOIN (SELECT * FROM b WHERE place = 1) b USING (doc_id) LEFT JOIN y USING (doc_id)
"""

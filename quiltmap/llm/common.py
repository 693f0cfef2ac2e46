"""Small helpers that the operators share: tables, scratch tables, bytes of text, memory of workers, Bloom filters."""

from __future__ import annotations

import ctypes
import functools
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from quiltmap.session import scratch_root

#: The white space of every contract here: space and U+0009 to U+000D, as bytes.
SPACE = b" \t\n\x0b\x0c\r"


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def texts(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    """The UTF-8 bytes of a text column."""
    return column.cast(pa.large_binary()).to_pylist()


def fold_case(text: bytes | None) -> bytes:
    """Lower-cases A-Z alone; null counts as empty."""
    return (text or b"").lower()


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Bytes of an Arrow batch that a task and its worker hold at once, several times over.
BATCH_BYTES = 4 << 20


def in_small_batches(spark: SparkSession) -> None:
    """Ends Arrow batches at ``BATCH_BYTES`` from now on, as 10,000 long texts are many more; a value that the session has of its own stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if key not in spark.conf.getAll:
        spark.conf.set(key, BATCH_BYTES)


def apart(df: DataFrame) -> DataFrame:
    """Gives an aggregate an exchange of its own, so that a join with it can split hot keys of the other side."""
    return df.hint("rebalance")


_owners: ContextVar[tuple[list, ...]] = ContextVar("owners", default=())


@contextmanager
def owned():
    """Deletes, at its end, the tables of all jobs begun inside: for callers that write a result before they go on."""
    made: list[Scratch] = []
    token = _owners.set((*_owners.get(), made))
    try:
        yield
    finally:
        _owners.reset(token)
        for scratch in made:
            scratch.drop("")


class Scratch:
    """Tables of one job below ``spark.checkpoint.dir``: lineage ends at each, lost executors cost no rework.

    ``drop`` deletes a table that no later step reads. A result is read from its tables, so they stay until whoever
    asked for it is done: see ``owned``.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
        for made in _owners.get():
            made.append(self)

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("errorifexists").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def append(self, df: DataFrame, name: str) -> None:
        df.write.mode("append").parquet(f"{self.root}/{name}")

    def read(self, name: str, schema) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")

    def drop(self, *names: str) -> None:
        jvm = self.spark._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


# Workers are reused by one task after another, of any operator, and several wait at once.

_cached: dict = {}


def cached(key, build: Callable):
    """What ``build`` makes, once for a worker process, until it works for another operator."""
    if key not in _cached:
        _cached[key] = build()
    return _cached[key]


def give_back() -> None:
    """Returns free memory to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def tidily(operator: str):
    """For a function over Arrow batches: frees what other operators cached before it, and gives free memory back before and after it."""

    def wrap(call):
        @functools.wraps(call)
        def run(batches):
            if _cached.get("operator") != operator:
                _cached.clear()
                _cached["operator"] = operator
                give_back()
            try:
                yield from call(batches)
            finally:
                give_back()

        return run

    return wrap


# Bloom filters: a power of two of bits, four per key, kept as bytes.

HASHES = 4
#: Bytes of a filter that travel as one row.
CHUNK = 1 << 16
FILTER = "chunk int, once binary, twice binary"


def filter_bits(keys: int, per_key: int = 10, largest: int = 1 << 31) -> int:
    """Bits for about so many keys. Past ``largest`` (256 MB) a filter only gets less selective."""
    return min(largest, max(CHUNK * 8, 1 << max(0, int(keys) * per_key - 1).bit_length()))


def positions(hashes: np.ndarray, bits: int) -> np.ndarray:
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    k = np.arange(HASHES, dtype=np.uint64)[:, None]
    return (hashes[None, :] + k * step[None, :]) & np.uint64(bits - 1)


def put(bloom: np.ndarray, hashes: np.ndarray) -> None:
    at = positions(hashes, len(bloom) * 8).ravel()
    np.bitwise_or.at(bloom, (at >> np.uint64(3)).astype(np.int64), np.left_shift(1, at & np.uint64(7)).astype(np.uint8))


def holds(bloom: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = positions(hashes, len(bloom) * 8)
    return ((bloom[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).all(axis=0)


def put_twice(once: np.ndarray, twice: np.ndarray, hashes: np.ndarray) -> None:
    """Adds keys; those met before, or twice among these, also go to the second filter."""
    keys, counts = np.unique(hashes, return_counts=True)
    again = holds(once, keys) | (counts > 1)
    put(twice, keys[again])
    put(once, keys[~again])


def chunks(once: np.ndarray, twice: np.ndarray) -> Iterator[pa.RecordBatch]:
    for start in range(0, len(once), CHUNK):
        a, b = once[start : start + CHUNK], twice[start : start + CHUNK]
        if a.any() or b.any():
            yield pa.RecordBatch.from_arrays([pa.array([start // CHUNK], pa.int32()), pa.array([a.tobytes()], pa.binary()), pa.array([b.tobytes()], pa.binary())], ["chunk", "once", "twice"])


def merged(parts: DataFrame, bits: int, which: str) -> np.ndarray:
    """One filter (``once`` or ``twice``) of all tasks: a key of two tasks counts as met twice. At most ``bits`` reach the driver."""

    def merge(table: pa.Table) -> pa.Table:
        once, twice = np.zeros(CHUNK, np.uint8), np.zeros(CHUNK, np.uint8)
        for a, b in zip(table.column("once").to_pylist(), table.column("twice").to_pylist(), strict=True):
            a, b = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
            twice |= b | (once & a)
            once |= a
        out = (once if which == "once" else twice).tobytes()
        return pa.table({"chunk": table.column("chunk").slice(0, 1), "bits": pa.array([out], pa.binary())})

    bloom = np.zeros(bits // 8, np.uint8)
    for row in parts.groupBy("chunk").applyInArrow(merge, "chunk int, bits binary").collect():
        bloom[row.chunk * CHUNK : (row.chunk + 1) * CHUNK] = np.frombuffer(row.bits, np.uint8)
    return bloom


def id_filter(ids: DataFrame, expected: int) -> np.ndarray:
    """A Bloom filter of the long ids in the frame's one column (nulls left out)."""
    bits = filter_bits(expected)

    def build(batches):
        bloom = np.zeros(bits // 8, np.uint8)
        for batch in batches:
            put(bloom, mix(batch.column(0).drop_null().to_numpy(zero_copy_only=False)))
        yield from chunks(bloom, np.zeros_like(bloom))

    spark = ids.sparkSession
    return merged(ids.coalesce(spark.sparkContext.defaultParallelism).mapInArrow(build, FILTER), bits, "once")


def mix(ids: np.ndarray) -> np.ndarray:
    """Scatters integers over 64 bits."""
    x = ids.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))

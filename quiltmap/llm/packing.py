"""Cost-balanced packing of tokenised documents into sequences.

A document is cut into full pieces of a sequence's length, which fill sequences of their own, and a rest.
Each task packs the rests of its rows in bounded runs of ``RUN``, so no token is shuffled. The cost of a
piece is linear plus quadratic in its length (attention within the piece), pieces go in descending order to
the sequence of lowest cost that has room, and a piece that fits nowhere is cut into the room left. A run
has as many sequences as its tokens need, so its padding is less than one sequence.
"""

from __future__ import annotations

import json
import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quiltmap.llm.common import cached, in_small_batches, load, tidily

CAPACITY, END = 2048, 1
#: Pieces that are packed together; the memory of a run is at most RUN * capacity ids.
RUN = 2048
#: Relative cost of a token and of a pair of tokens.
LINEAR, QUADRATIC = 1.0, 1 / 1024
PIECE = "start long, length long, doc_tokens long, ids binary, sequence_id long, offset long"


#: How a byte-level vocabulary splits text before its merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_letters() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: itself where it prints, else U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Token ids, as little-endian 32-bit bytes, by the vocabulary of a byte-level tokenizer file.

    With ``added`` the file's added tokens are found in the text first, each is its one id, and what lies
    between them is split on its own; without it they are text like any other. Where no two white-space characters meet, the pattern needs no look-ahead and splits twice as fast.
    """

    ADJACENT = re.compile(r"\s\s")

    def __init__(self, path: str, added: bool = False):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        special = {t["content"]: t["id"] for t in model["added_tokens"]}
        letters = byte_letters()
        # ids follow the order of the merges, so they serve as ranks
        ranks = {bytes(letters[c] for c in token): i for token, i in model["model"]["vocab"].items() if token not in special}
        self.any, self.single = (tiktoken.Encoding(name, pat_str=pattern, mergeable_ranks=ranks, special_tokens={}) for name, pattern in (("any", PATTERN), ("single", PATTERN.replace(r"\s+(?!\S)|", ""))))
        if added and any(t[k] for t in model["added_tokens"] for k in ("single_word", "lstrip", "rstrip")):
            raise ValueError(f"{path}: added tokens that depend on their neighbours are not supported")
        self.added = {text: array("I", [i]).tobytes() for text, i in special.items()} if added else {}
        # of tokens that begin at one place the longest counts
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None

    def encode(self, text: str) -> bytes:
        if self.split and self.split.search(text):
            return b"".join(self.added.get(part) or self.ordinary(part) for part in self.split.split(text) if part)
        return self.ordinary(text)

    def ordinary(self, text: str) -> bytes:
        encoding = self.any if self.ADJACENT.search(text) else self.single
        return array("I", encoding.encode_ordinary(text)).tobytes()


def vocabulary(path: str, added: bool = False) -> Vocabulary:
    return cached(("vocabulary", path, added), lambda: Vocabulary(path, added))


def encode_all(some: list[str | None], path: str, end: int, added: bool = False):
    """For each text the bytes of its ids with the end id."""
    vocab, stop = vocabulary(path, added), array("I", [end]).tobytes()
    for text in some:
        yield vocab.encode(text or "") + stop


def assign(lengths: np.ndarray, capacity: int, linear: float = LINEAR, quadratic: float = QUADRATIC) -> list[tuple[int, int, int, int, int]]:
    """``(piece, skip, length, sequence, offset)``: pieces by descending cost to the cheapest sequence with room."""
    count = -(-int(lengths.sum()) // capacity)
    cost, room = np.zeros(count), np.full(count, capacity)
    out = []
    for piece in np.argsort(-lengths, kind="stable"):
        skip, left = 0, int(lengths[piece])
        while left:
            fits = room >= left
            if not fits.any():
                fits = room > 0
            to = int(np.where(fits, cost, np.inf).argmin())
            take = min(left, int(room[to]))
            out.append((int(piece), skip, take, to, capacity - int(room[to])))
            cost[to] += linear * take + quadratic * take * take
            room[to] -= take
            skip, left = skip + take, left - take
    return out


def pack_task(path: str, capacity: int, end: int, added: bool = False):
    """Cuts and packs the documents of a task: full pieces at once, rests run by run."""

    @tidily("packing")
    def call(batches):
        task, used = TaskContext.get().partitionId() << 34, 0
        rests: list[tuple[int | None, int, bytes, int]] = []
        kind = None

        def flush():
            nonlocal used
            lengths = np.asarray([len(r[2]) // 4 for r in rests])
            cut = assign(lengths, capacity)
            out = [(rests[p][0], rests[p][1] + skip, n, rests[p][3], rests[p][2][4 * skip : 4 * (skip + n)], task + used + to, at) for p, skip, n, to, at in cut]
            used += -(-int(lengths.sum()) // capacity)
            rests.clear()
            return _batch(out, kind)

        for batch in batches:
            kind = batch.schema.field(0).type
            for at in range(0, batch.num_rows, 512):
                part, full = batch.slice(at, 512), []
                for own, data in zip(part.column(0).to_pylist(), encode_all(part.column(1).to_pylist(), path, end, added), strict=True):
                    n = len(data) // 4
                    whole = n - n % capacity
                    for begin in range(0, whole, capacity):
                        full.append((own, begin, capacity, n, data[4 * begin : 4 * (begin + capacity)], task + used, 0))
                        used += 1
                    if whole < n:
                        rests.append((own, whole, data[4 * whole :], n))
                        if len(rests) == RUN:
                            yield flush()
                if full:
                    yield _batch(full, kind)
        if rests:
            yield flush()

    return call


def _batch(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    own, start, length, total, ids, sequence, offset = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(own, kind), *(pa.array(c, pa.int64()) for c in (start, length, total)), pa.array(ids, pa.binary()), *(pa.array(c, pa.int64()) for c in (sequence, offset))],
        ["id", "start", "length", "doc_tokens", "ids", "sequence_id", "offset"],
    )


def pack(docs: DataFrame, *, path: str, capacity: int = CAPACITY, end: int = END, id_col: str = "doc_id", text_col: str = "text", added: bool = False) -> DataFrame:
    """``<id_col>, start, length, doc_tokens, ids, sequence_id, offset``: one row per piece.

    ``ids`` holds the piece's token ids as little-endian 32-bit integers, ``start`` the ids of its document
    before it, ``offset`` its place in the sequence. Every document ends with the id ``end``; null and
    empty texts are that id alone. With ``added`` an added token of the file that stands in a text is its one
    id, as the tokenizer has it by default; else it is split like other text. Rows with equal or null ids are documents of their own. Sequence ids are
    unique, and the same again for the same partitions. An empty table gives an empty one; other columns
    are ignored.
    """
    in_small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return own.mapInArrow(pack_task(path, capacity, end, added), f"id {kind}, {PIECE}").withColumnRenamed("id", id_col)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(pack(load(spark, sf_dir, "documents"), path=default_path(), added=True))


def digest(packed: DataFrame) -> DataFrame:
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")

"""Substring dedup by level-wise doubling: only what repeats at one length is looked at at twice that length.

A window of W words holds W - W/4 + 1 grams of W/4 words, and equal windows hold equal grams, so a window is
looked for by its smallest gram alone (by hash, the first among equals). Neighbouring windows with one smallest
gram form a segment, one row for some seven words, and:

1. Level W/4: of segments that are equal throughout, all but the first are repeats as a whole; a first one goes
   on only if its gram has another one elsewhere. Both are read off one exchange.
2. Level W/2: of those, the gram is extended to W/2 words to the right or left, whichever lies inside the
   window, and only extensions met again go on.
3. Level W: the windows of what is left are compared one by one; all but the first of each are repeats.

A level at which nothing survives ends the search. What is met twice within a batch is settled there, so a
passage that a third of the documents hold sends one row per batch to the next exchange, and a gram with many
surroundings is spread by them; rows that are settled pass through the same exchange, dealt over all its partitions.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quiltmap.llm.common import Scratch, apart, in_small_batches, load, mix, partitions, texts, tidily

WINDOW = 20
#: Words of whole documents that are hashed in one go.
TOGETHER = 1 << 17
#: Word hashes that a task remembers, and the bytes of the longest word among them.
REMEMBERED, LONGEST = 1 << 16, 32
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)

# A stretch of neighbouring windows of one document: ``first`` is the first one's place, ``n`` how many.
STRETCH = "doc long, twin long, first int, n int"
SEGMENT = f"gram long, segment long, right long, left long, {STRETCH}, gram_at int"
LATER = "settled boolean"
FIRST = f"{SEGMENT}, settled boolean, lone boolean, payload boolean"
#: Rows that ask whether their key is met again; those without ``payload`` only answer.
ASKED = "key long, {of}, settled boolean, payload boolean"
EXTENDED = f"right long, left long, {STRETCH}, gram_at int"


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        found = xxhash.xxh3_64_intdigest(word)
        if len(word) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = found
        return found


class Sequence:
    """Words of several documents in a row, as hashes, with sums from which the hash of any stretch follows."""

    def __init__(self, documents: list[list[bytes]], known: WordHashes):
        self.sizes = np.fromiter(map(len, documents), np.int64, len(documents))
        self.ends = np.cumsum(self.sizes)
        self.starts = self.ends - self.sizes
        n = int(self.sizes.sum())
        words = np.fromiter((known[w] for d in documents for w in d), np.uint64, n)
        self.owner = np.repeat(np.arange(len(documents)), self.sizes)
        self.lanes = []
        for lane, base in enumerate(BASES):
            values = words if lane == 0 else mix(words)
            powers, back = np.full(n + 1, base, np.uint64), np.full(n + 1, pow(base, -1, 1 << 64), np.uint64)
            powers[0] = back[0] = 1
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(values * np.cumprod(powers, dtype=np.uint64)[:n], dtype=np.uint64, out=sums[1:])
            self.lanes.append((sums, np.cumprod(back, dtype=np.uint64)))

    def hashed(self, first: np.ndarray, last: np.ndarray, lane: int = 0) -> np.ndarray:
        """Hashes of the words from ``first`` to before ``last``: equal for equal words, whatever their place."""
        sums, back = self.lanes[lane]
        return mix(((sums[last] - sums[first]) * back[first]).view(np.int64))

    def windows(self, width: int) -> np.ndarray:
        """The places at which a window lies within its document."""
        at = np.arange(len(self.owner))
        return at[at + width <= self.ends[self.owner]]


def smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Of each ``width`` neighbours, the place of the smallest, the first among equals."""
    if len(values) < width:
        return np.zeros(0, np.int64)
    return np.arange(len(values) - width + 1) + np.lib.stride_tricks.sliding_window_view(values, width).argmin(axis=1)


def segments(sequence: Sequence, window: int) -> dict[str, np.ndarray]:
    """One row for each stretch of windows that have one smallest gram."""
    short = window // 4
    at = sequence.windows(window)
    if not at.size:
        return {}
    n = len(sequence.owner)
    grams = sequence.hashed(np.arange(n - short + 1), np.arange(short, n + 1))
    place = smallest(grams, window - short + 1)[at]
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(at) > 1) | (place[1:] != place[:-1])
    begins = np.flatnonzero(new)
    counts = np.diff(np.append(begins, len(at)))
    first, gram_at = at[begins], place[begins]
    owner = sequence.owner[first]
    last = first + counts - 1 + window
    # an extension is used only where it lies inside the segment
    right = sequence.hashed(gram_at, np.minimum(gram_at + 2 * short, last))
    left = sequence.hashed(np.maximum(gram_at - short, first), gram_at + short)
    return {
        "gram": grams[gram_at],
        "segment": sequence.hashed(first, last),
        "right": right,
        "left": left,
        "owner": owner,
        "first": first - sequence.starts[owner],
        "n": counts,
        "gram_at": gram_at - sequence.starts[owner],
    }


def spelled(column: Iterable[bytes | None], size: int = TOGETHER):
    """Runs of whole documents of about ``size`` words: where each begins, and its documents, split only when their run comes."""
    begin, words, run = 0, 0, []
    for i, text in enumerate(column):
        document = (text or b"").split()
        if run and words + len(document) > size:
            yield begin, run
            begin, words, run = i, 0, []
        run.append(document)
        words += len(document)
    if run:
        yield begin, run


def names_of(ddl: str) -> list[str]:
    return [field.split(" ")[0] for field in ddl.split(", ")]


def record(columns: dict, ddl: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}
    value = lambda c: c.view(np.int64) if c.dtype == np.uint64 else c
    fields = [field.split(" ") for field in ddl.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(value(columns[name]), kinds[kind]) for name, kind in fields], names_of(ddl))


def numbers(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
    return {name: batch.column(i).to_numpy(zero_copy_only=False) for i, name in enumerate(batch.schema.names)}


PLACE = ["doc", "twin", "first"]


def settle(columns: dict[str, np.ndarray], keys: list[str]) -> dict[str, np.ndarray]:
    """Rows of a batch, each once, with ``settled`` for those that are not the first of their keys."""
    names = [*keys, *PLACE]
    rows = np.stack([columns[c].view(np.int64) if columns[c].dtype == np.uint64 else columns[c].astype(np.int64) for c in names])
    order = np.lexsort(rows[::-1])
    rows = rows[:, order]
    differs = np.ones(rows.shape, bool)
    differs[:, 1:] = rows[:, 1:] != rows[:, :-1]
    begins, once = differs[: len(keys)].any(axis=0), differs.any(axis=0)
    return {name: values[order][once] for name, values in columns.items()} | {"settled": ~begins[once]}


def exchanged(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows dealt by key, settled ones over all partitions; in each partition the unsettled by key and place, then the others."""
    deal = F.when(F.col("settled"), F.xxhash64(*keys, *PLACE)).otherwise(F.xxhash64(*keys))
    return rows.repartition(partitions(rows.sparkSession), deal).sortWithinPartitions("settled", *keys, *PLACE)


def first_of(rows: DataFrame, keys: list[str], ddl: str) -> DataFrame:
    """``ddl`` and ``repeat``: whether an earlier place has the same keys. Equal rows come once. ``rows`` come from ``settle``."""

    def pick(batches):
        names, before = [*keys, *PLACE], None
        for batch in batches:
            if not batch.num_rows:
                continue
            c = numbers(batch)
            held = np.stack([c[name].astype(np.int64) for name in names])
            earlier = np.concatenate([~held[:, :1] if before is None else before, held[:, :-1]], axis=1)
            before = held[:, -1:].copy()
            differs = held != earlier
            keep = c["settled"] | differs.any(axis=0)
            c["repeat"] = c["settled"] | ~differs[: len(keys)].any(axis=0)
            yield record({name: c[name][keep] for name in [*names_of(ddl), "repeat"]}, f"{ddl}, repeat boolean")

    return exchanged(rows, keys).mapInArrow(pick, f"{ddl}, repeat boolean")


def ask(columns: dict[str, np.ndarray], ddl: str) -> pa.RecordBatch:
    """Rows of a batch that ask whether ``key`` is met again. Where the batch has a key twice its rows are settled, and one without payload answers for them."""
    order = np.argsort(columns["key"], kind="stable")
    key = columns["key"][order]
    begins = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    counts = np.diff(np.append(begins, len(order)))
    rows = np.concatenate([order, order[begins[counts > 1]]])
    settled, payload = np.zeros(len(rows), bool), np.zeros(len(rows), bool)
    settled[: len(order)], payload[: len(order)] = np.repeat(counts > 1, counts), True
    return record({name: values[rows] for name, values in columns.items()} | {"settled": settled, "payload": payload}, ASKED.format(of=ddl))


def met_again(rows: DataFrame, ddl: str) -> DataFrame:
    """Of rows from ``ask``, those whose key another row has."""

    def pick(batches):
        last, known = None, False  # the last row waits for the next one
        for batch in batches:
            if not batch.num_rows:
                continue
            batch = batch if last is None else pa.concat_batches([last, batch])
            c = numbers(batch)
            alike = (c["key"][1:] == c["key"][:-1]) & ~c["settled"][1:] & ~c["settled"][:-1]
            met = c["settled"].copy()
            met[0] |= known
            met[1:] |= alike
            met[:-1] |= alike
            last, known = batch.slice(batch.num_rows - 1), bool(met[-1])
            yield batch.slice(0, batch.num_rows - 1).filter(pa.array((met & c["payload"])[:-1])).select(names_of(ddl))
        if last is not None and known and last.column("payload")[0].as_py():
            yield last.select(names_of(ddl))

    return exchanged(rows, ["key"]).mapInArrow(pick, ddl)


def ask_grams(columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    """Segments of a batch from ``settle``. A gram with one segment here is ``lone`` and asks for others; where it has several, one row without payload says so."""
    c = columns
    rest = np.flatnonzero(~c["settled"])
    rest = rest[np.argsort(c["gram"][rest], kind="stable")]
    gram = c["gram"][rest]
    begins = np.flatnonzero(np.append(True, gram[1:] != gram[:-1]))
    counts = np.diff(np.append(begins, len(rest)))
    lone = np.zeros(len(c["settled"]), bool)
    lone[rest] = np.repeat(counts == 1, counts)
    tokens = rest[begins[counts > 1]]
    more, none = np.ones(len(tokens), bool), np.zeros(len(tokens), bool)
    out = {name: np.concatenate([values, values[tokens]]) for name, values in c.items()}
    return record(out | {"lone": np.concatenate([lone, more]), "payload": np.concatenate([np.ones(len(lone), bool), none])}, FIRST)


def level_of_grams(rows: DataFrame) -> DataFrame:
    """``repeat`` rows: segments that come earlier too; and first segments whose gram has another one. Both with their place."""
    deal = F.when(F.col("settled"), F.xxhash64("gram", "segment", *PLACE)).when(F.col("lone"), F.xxhash64("gram")).otherwise(F.xxhash64("gram", "segment"))
    order = ["settled", "lone", "gram", "payload", "segment", *PLACE]
    dealt = rows.repartition(partitions(rows.sparkSession), deal).sortWithinPartitions(*order)
    out = f"{EXTENDED}, repeat boolean"

    def pick(batches):
        held, given, known = None, False, False  # one row, whether it was given out, whether its gram is known to have others
        for batch in batches:
            if not batch.num_rows:
                continue
            c = numbers(batch if held is None else pa.concat_batches([held, batch]))
            rows = np.stack([c[name].astype(np.int64) for name in order])
            differs = np.ones(rows.shape, bool)
            differs[:, 1:] = rows[:, 1:] != rows[:, :-1]
            of_gram, of_segment, once = differs[:3].any(axis=0), differs[:5].any(axis=0), differs.any(axis=0)
            group = np.cumsum(of_gram) - 1
            first = of_segment & c["payload"] & ~c["settled"]
            others = np.bincount(group, first) + 2 * np.bincount(group, ~c["payload"] | ~c["lone"]) > 1
            others[0] |= known
            c["repeat"] = c["settled"] | ~first
            give = c["payload"] & (c["settled"] | (once & (c["repeat"] | others[group])))
            if given:
                give[0] = False
            last = len(give) - 1
            known, given = bool(others[-1]), True
            if not known:  # a lone gram with one segment so far: its first row waits for another
                last, given = int(np.flatnonzero(first)[-1]), False
            held = (batch if held is None else pa.concat_batches([held, batch])).slice(last, 1)
            c |= {name: np.where(c["repeat"], 0, c[name]) for name in ("right", "left")}
            yield record({name: c[name][give] for name in names_of(out)}, out)

    return dealt.mapInArrow(pick, out)


def by_half(batches, window: int):
    """Each segment's windows as up to two stretches: those that hold the gram's extension to the right, and the others, to the left."""
    for batch in batches:
        if not batch.num_rows:
            continue
        c = numbers(batch)
        cut = np.clip(c["gram_at"] - (window - window // 4 * 2) - c["first"], 0, c["n"])
        parts = []
        # the two kinds of extension have keys of their own: a window has one of them
        for key, first, n in ((c["left"] ^ 1, c["first"], cut), (c["right"], c["first"] + cut, c["n"] - cut)):
            parts.append({name: values[n > 0] for name, values in {"key": key, "doc": c["doc"], "twin": c["twin"], "first": first, "n": n}.items()})
        yield ask({name: np.concatenate([p[name] for p in parts]) for name in parts[0]}, STRETCH)


def keyed(id_col: str, text_col: str) -> list:
    """``doc, twin``: the id (null as the largest long), and a hash of the text that tells rows of one id apart."""
    last = F.lit((1 << 63) - 1)
    return [F.coalesce(F.col(id_col).cast("long"), last).alias("doc"), F.xxhash64(F.coalesce(F.col(text_col), F.lit("")), F.col(id_col).isNull()).alias("twin")]


def listed(stretches: DataFrame, name: str) -> DataFrame:
    """``__doc, __twin`` and the stretches of that row, each once, as ``first * 65536 + n``."""
    packed = F.shiftleft(F.col("first").cast("long"), 16).bitwiseOR(F.col("n").cast("long"))
    lists = stretches.groupBy(F.col("doc").alias("__doc"), F.col("twin").alias("__twin")).agg(F.collect_set(packed).alias(name))
    return apart(lists)


def places(stretches: list[int], reach: int) -> np.ndarray:
    """The places of packed stretches, each lengthened by ``reach``, in order and each once."""
    packed = np.sort(np.asarray(stretches, np.int64))
    first, n = packed >> 16, (packed & 0xFFFF) + reach
    return np.unique(np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))


def scan(batches, window: int):
    """The segments of each batch of ``doc, twin, text``."""
    known = WordHashes()
    for batch in batches:
        doc, twin = (batch.column(i).to_numpy() for i in (0, 1))
        found = []
        for begin, part in spelled(texts(batch.column(2))):
            c = segments(Sequence(part, known), window)
            if c:
                owner = c.pop("owner") + begin
                found.append(c | {"doc": doc[owner], "twin": twin[owner]})
        if found:
            together = {name: np.concatenate([f[name] for f in found]) for name in found[0]}
            yield ask_grams(settle(together, ["gram", "segment"]))


def spell(batches, window: int):
    """The windows of each batch of ``doc, twin, text, stretches``, by two hashes."""
    known = WordHashes()
    for batch in batches:
        doc, twin = (batch.column(i).to_numpy() for i in (0, 1))
        wanted, found = batch.column(3).to_pylist(), []
        for begin, part in spelled(texts(batch.column(2))):
            sequence = Sequence(part, known)
            own = [places(wanted[begin + i], 0) for i in range(len(part))]
            owner = np.repeat(np.arange(len(part)), list(map(len, own)))
            first = np.concatenate(own)
            at = first + sequence.starts[owner]
            keys = {name: sequence.hashed(at, at + window, lane) for lane, name in enumerate(("key", "key2"))}
            found.append(keys | {"doc": doc[owner + begin], "twin": twin[owner + begin], "first": first, "n": np.ones(len(first), np.int32)})
        if found:
            together = {name: np.concatenate([f[name] for f in found]) for name in found[0]}
            yield record(settle(together, ["key", "key2"]), f"key long, key2 long, {STRETCH}, {LATER}")


def repeats(docs: DataFrame, scratch: Scratch, *, id_col: str, text_col: str, window: int) -> DataFrame:
    """``doc, twin, first, n``: the windows of each row whose words start earlier too."""
    source = docs.select(*keyed(id_col, text_col), F.col(text_col).alias("text"))
    met = scratch.write(level_of_grams(source.mapInArrow(tidily("substring")(partial(scan, window=window)), FIRST)), "grams")
    found = met.where("repeat").select(*names_of(STRETCH))
    grams = met.where("not repeat").drop("repeat")
    halves = met_again(grams.mapInArrow(partial(by_half, window=window), ASKED.format(of=STRETCH)), STRETCH)
    left = scratch.write(halves, "left")
    if left.isEmpty():
        return found
    wanted = source.join(listed(left, "stretches"), (F.col("doc") == F.col("__doc")) & (F.col("twin") == F.col("__twin"))).select("doc", "twin", "text", "stretches")
    windows = wanted.mapInArrow(tidily("substring")(partial(spell, window=window)), f"key long, key2 long, {STRETCH}, {LATER}")
    last = scratch.write(first_of(windows, ["key", "key2"], STRETCH).where("repeat").drop("repeat"), "windows")
    return found.union(last)


def substring_dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """The documents with every column, words of repeated windows removed, and ``n_words, n_removed`` added.

    Words are ``[^\\x20\\x09-\\x0D]+``, unchanged; kept words are joined by one space. A window is ``window`` (a
    multiple of 4, 262140 at most) consecutive words of one row; every word that it covers goes if its words also
    start earlier: in a row of smaller id, or in the same row. Windows are judged on the input. A null id counts as
    the largest; rows of one id that differ in their text are ordered by a hash of it, and rows equal in both are
    one document that comes as often as it did. Null, empty and short texts keep their words (null becomes empty).
    Ids are integers. Other columns do not matter, but ``n_words`` and ``n_removed`` are replaced. An empty table
    gives an empty one. A text of any length is handled whole. Words and windows are compared by 128 bits of hash,
    folded segments by 64 bits beside the 64 of their gram.
    """
    if window < 4 or window % 4 or window > 262140:
        raise ValueError("window is a multiple of 4, at most 262140")
    in_small_batches(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "substring-dedup")
    gone = listed(repeats(docs, scratch, id_col=id_col, text_col=text_col, window=window), "__gone")
    own = [c for c in docs.columns if c not in ("n_words", "n_removed")]
    doc, twin = keyed(id_col, text_col)
    joined = docs.select(*own, doc.alias("__doc_of"), twin.alias("__twin_of")).join(gone, (F.col("__doc_of") == F.col("__doc")) & (F.col("__twin_of") == F.col("__twin")), "left")
    schema = docs.select(*own).schema.add("n_words", "long").add("n_removed", "long")
    at = own.index(text_col)

    @tidily("substring")
    def clean(batches):
        for batch in batches:
            out, words, removed = [], [], []
            for text, stretches in zip(texts(batch.column(at)), batch.column(len(own)).to_pylist(), strict=True):
                kept = (text or b"").split()
                words.append(len(kept))
                if stretches:
                    stay = np.ones(len(kept), bool)
                    stay[places(stretches, window - 1)] = False
                    kept = [kept[i] for i in np.flatnonzero(stay).tolist()]
                removed.append(words[-1] - len(kept))
                out.append(b" ".join(kept))
            columns = [batch.column(i) for i in range(len(own))]
            columns[at] = pa.array(out, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(words, pa.int64()), pa.array(removed, pa.int64())], [*own, "n_words", "n_removed"])

    return joined.select(*own, "__gone").mapInArrow(clean, schema)


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup(load(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT doc_id, unnest(range(1, len(w) - 18)) AS i, w FROM d
), k AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY array_to_string(w[i:i + 19], ' ') ORDER BY doc_id, i) > 1 AS again FROM s
), g AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM k WHERE again
), x AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d
), y AS (
  SELECT x.doc_id, count(*) FILTER (WHERE g.i IS NOT NULL) AS n_removed,
         string_agg(CASE WHEN g.i IS NULL THEN word END, ' ' ORDER BY x.i) AS kept
  FROM x LEFT JOIN g USING (doc_id, i) GROUP BY x.doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN y USING (doc_id)
"""

"""Toxicity by a weighted lexicon, matched by Aho-Corasick over folded text.

Folding maps homoglyphs, accents, digit and sign substitutions to plain letters, one character to one. The
lexicon is learned from labelled rows: folded words (``stem$``) and beginnings of longer ones (``stem~``) that
are far more frequent in toxic documents, weighted by their log-odds. All stems and exception phrases are
matched in one pass; a match counts at the start of a word and outside every exception phrase. The weights found, as they are and
normalised by length, give the score through a logistic curve fitted on the same rows.
"""

from __future__ import annotations

import bisect
import itertools
import re
import unicodedata
from collections import Counter
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quiltmap.llm.common import Scratch, in_small_batches, load, tidily

#: Labelled rows that are learned from at most, those of the smallest hash of their id.
TRAIN_ROWS = 50_000
SHORTEST, LONGEST = 4, 12
#: An entry is found in so many toxic rows and has at least these log-odds.
LEAST_ROWS, LEAST_ODDS = 5, 2.2

#: Characters that look like a Latin letter, by the letter.
LOOKALIKES = {
    "a": "аαɑ@4", "b": "Ьв8", "c": "сϲ", "d": "ԁ", "e": "еєε3", "g": "ɡ9", "h": "һ", "i": "іιıl1!|łӏ", "j": "ј", "k": "кκ",
    "m": "м", "n": "пη", "o": "оοσ0", "p": "рρ", "q": "ԛ", "r": "г", "s": "ѕ5$", "t": "тτ7+", "u": "υ", "v": "ν", "w": "ѡω", "x": "хχ×", "y": "уγ", "z": "2",
}
#: Phrases in which an entry is no insult.
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "clownfish", "clown fish", "circus clown", "losers bracket", "idiot-proof")


def _table() -> dict[int, str]:
    table = {}
    for code in itertools.chain(range(0xC0, 0x250), range(0x1E00, 0x1F00), range(0xFF01, 0xFF5F), range(0x1D400, 0x1D7FF)):
        plain = unicodedata.normalize("NFKD", chr(code))[0].lower()
        if plain.isascii():
            table[code] = plain
    for letter, like in LOOKALIKES.items():
        for c in like:
            table[ord(c)] = letter
    return {k: "i" if v == "l" else v for k, v in table.items()} | {ord("L"): "i"}


TABLE = _table()
WORD = re.compile(r"[^\W\d_]+")


def fold(text: str) -> str:
    """Letters in lower case with look-alikes made equal (i, l, 1 and ! are one letter), as long as the text."""
    lower = text.lower()
    return (lower if len(lower) == len(text) else "".join(c if len(c.lower()) > 1 else c.lower() for c in text)).translate(TABLE)


def beginnings(folded: str) -> set[str]:
    """Of each distinct word itself (``stem$``) and the shorter beginnings of SHORTEST to LONGEST letters (``stem~``)."""
    words = {w for w in WORD.findall(folded) if len(w) >= SHORTEST}
    out = {w[:n] + "~" for w in words for n in range(SHORTEST, min(len(w) - 1, LONGEST) + 1)}
    out.update(w + "$" for w in words if len(w) <= 2 * LONGEST)
    return out


@dataclass
class Lexicon:
    """Entries with weights, exception phrases, and the curve: intercept, weight of the hits, weight of their density."""

    weights: dict[str, float]
    exceptions: tuple[str, ...] = EXCEPTIONS
    curve: tuple[float, float, float] = (-3.0, 1.0, 1.0)
    automaton: ahocorasick.Automaton | None = field(default=None, repr=False)

    def build(self) -> Lexicon:
        self.automaton = ahocorasick.Automaton()
        stems = {entry[:-1] for entry in self.weights}
        phrases = set(map(fold, self.exceptions))
        for stem in stems | phrases:
            self.automaton.add_word(stem, (len(stem), self.weights.get(stem + "$", 0.0), self.weights.get(stem + "~", 0.0), stem in phrases))
        if not len(self.automaton):
            self.automaton.add_word("\0", (1, 0.0, 0.0, False))
        self.automaton.make_automaton()
        return self

    def features(self, text: str | None) -> tuple[float, float]:
        """Summed weight of the hits, and the same per 1,000 words, both on a logarithmic scale."""
        folded = fold(text or "")
        hits, excused = [], []
        for end, (length, whole, longer, phrase) in self.automaton.iter(folded):
            start = end - length + 1
            if start and folded[start - 1].isalpha():
                continue
            weight = longer if folded[end + 1 : end + 2].isalpha() else whole
            if phrase:
                excused.append((start, end))
            if weight:
                hits.append((start, end, weight))
        total, last = 0.0, -1
        if hits:
            excused.sort()
            starts = [s for s, _ in excused]
            ends = list(itertools.accumulate((e for _, e in excused), max))
            best: dict[int, float] = {}
            for start, end, weight in hits:
                before = bisect.bisect_right(starts, start)
                if not before or ends[before - 1] < end:
                    best[start] = max(best.get(start, 0.0), weight)
            total = sum(best.values())
        return float(np.log1p(total)), float(np.log1p(1000 * total / (1 + folded.count(" "))))

    def score(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.curve[0] + features @ np.asarray(self.curve[1:]), -500, 500)))


def train_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, most: int) -> DataFrame:
    """``text, toxic`` of the labelled texts outside the held-out fold: at most ``most`` ids, so their list may be broadcast."""
    chosen = labels.where(F.col("toxic").isin(0, 1) & (F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 != 0))
    chosen = chosen.groupBy(F.col(id_col).alias("__id")).agg(F.max("toxic").alias("__toxic"))
    chosen = chosen.orderBy(F.xxhash64("__id"), "__id").limit(most)
    rows = docs.join(F.broadcast(chosen), F.col(id_col) == F.col("__id")).select(F.col(text_col).alias("text"), F.col("__toxic").alias("toxic"))
    # copies of one text are one witness
    return rows.groupBy("text").agg(F.max("toxic").alias("toxic"))


def learn(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", most: int = TRAIN_ROWS, exceptions: tuple[str, ...] = EXCEPTIONS) -> Lexicon:
    """The lexicon and curve from at most ``most`` labelled rows. Without toxic rows the lexicon is empty and scores are low."""
    in_small_batches(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "toxicity")
    rows = scratch.write(train_rows(docs, labels, id_col, text_col, most), "train")
    sizes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic:
        return Lexicon({}, exceptions)

    def count(wanted: frozenset[str] | None):
        @tidily("toxicity")
        def call(batches):
            for batch in batches:
                for at in range(0, batch.num_rows, 1000):
                    found: Counter[str] = Counter()
                    for text in batch.column(0).slice(at, 1000).to_pylist():
                        own = beginnings(fold(text or ""))
                        found.update(own if wanted is None else own & wanted)
                    yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], ["entry", "n"])

        return call

    def counted(label: int, wanted: frozenset[str] | None, least: int) -> dict[str, int]:
        found = rows.where(F.col("toxic") == label).select("text").mapInArrow(count(wanted), "entry string, n long").groupBy("entry").agg(F.sum("n").alias("n"))
        # the rows learned from are bounded, so what so many of them share is too; of clean ones, the same entries are asked for
        return {r["entry"]: r["n"] for r in found.where(F.col("n") >= least).collect()}

    inside = counted(1, None, max(LEAST_ROWS, toxic // 100) if toxic >= 4 * LEAST_ROWS else 2)
    outside = counted(0, frozenset(inside) | {entry[:-1] + "~" for entry in inside}, 1)
    entries = choose(inside, outside, toxic, clean)
    # words of much copied toxic texts are no reason: an entry must be among the two commonest of some rows
    order = {e: i for i, e in enumerate(entries)}

    @tidily("toxicity")
    def credit(batches):
        for batch in batches:
            found: Counter[str] = Counter()
            for text in batch.column(0).to_pylist():
                found.update(sorted(beginnings(fold(text or "")) & order.keys(), key=order.__getitem__)[:2])
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], ["entry", "n"])

    credited = rows.where("toxic = 1").select("text").mapInArrow(credit, "entry string, n long").groupBy("entry").agg(F.sum("n").alias("n"))
    needed = {r["entry"][:-1] for r in credited.where(F.col("n") >= max(1, min(LEAST_ROWS, toxic // 100))).collect()}
    entries = {e: w for e, w in entries.items() if e[:-1] in needed}
    lexicon = Lexicon(entries, exceptions).build()
    points = rows.mapInArrow(_points(lexicon), "hits double, density double, toxic int").toPandas()
    lexicon.curve = fit(points[["hits", "density"]].to_numpy(), points["toxic"].to_numpy())
    lexicon.automaton = None
    return lexicon


def choose(inside: dict[str, int], outside: dict[str, int], toxic: int, clean: int) -> dict[str, float]:
    """Entries with their log-odds; of nested ones with about the same toxic rows the longest."""
    odds = {e: float(np.log((n + 0.5) / (toxic + 1)) - np.log((outside.get(e, 0) + 0.5) / (clean + 1))) for e, n in inside.items()}
    odds = {e: w for e, w in odds.items() if w >= LEAST_ODDS}
    next_ones: dict[str, list[str]] = {}
    for entry in odds:
        next_ones.setdefault(entry[:-2], []).append(entry)
    out: dict[str, float] = {}
    for entry in sorted(odds, key=lambda e: (len(e), e)):
        if any(entry[:k] + "~" in out for k in range(SHORTEST, len(entry) - 1)):
            continue
        while entry[-1] == "~" and (longer := [e for e in next_ones.get(entry[:-1], ()) if inside[e] >= 0.9 * inside[entry]]):
            entry = max(longer, key=lambda e: (inside[e], e))
        out[entry] = odds[entry]
    # a word whose longer forms are in no clean row stands for those too
    out |= {e[:-1] + "~": w for e, w in out.items() if e[-1] == "$" and len(e) > SHORTEST + 1 and not outside.get(e[:-1] + "~")}
    return dict(sorted(out.items(), key=lambda x: (-inside.get(x[0], 0), x[0])))


def _points(lexicon: Lexicon):
    @tidily("toxicity")
    def call(batches):
        own = Lexicon(lexicon.weights, lexicon.exceptions).build()
        for batch in batches:
            values = np.asarray([own.features(t) for t in batch.column(0).to_pylist()]).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(values[:, 0]), pa.array(values[:, 1]), batch.column(1).cast(pa.int32())], ["hits", "density", "toxic"])

    return call


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> tuple[float, float, float]:
    """Logistic regression by Newton's method with a small ridge."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(map(float, w))


def score(docs: DataFrame, lexicon: Lexicon, *, text_col: str = "text", into: str = "score") -> DataFrame:
    """The rows of ``docs`` with every column and the score in ``into`` (0 to 1), which replaces one of that name.

    Null and empty texts score as texts without a hit. Order, repeats and other columns do not matter.
    """
    in_small_batches(docs.sparkSession)
    names = [c for c in docs.columns if c != into]
    at = names.index(text_col)
    plain = Lexicon(lexicon.weights, lexicon.exceptions, lexicon.curve)

    @tidily("toxicity")
    def call(batches):
        own = Lexicon(plain.weights, plain.exceptions, plain.curve).build()
        for batch in batches:
            values = np.asarray([own.features(t) for part in range(0, batch.num_rows, 1000) for t in batch.column(at).slice(part, 1000).to_pylist()]).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own.score(values), pa.float64())], [*names, into])

    return docs.select(*names).mapInArrow(call, docs.select(*names).schema.add(into, "double"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    lexicon = learn(docs, load(spark, sf_dir, "labels"))
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return score(docs, lexicon).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))

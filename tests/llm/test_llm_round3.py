"""Periodic runs, repeated windows, hard negatives and levels of calls against brute force, with their edges."""

import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from quiltmap.llm import hard_negatives, minhash_dedup, periodic_runs, substring_dedup, tool_calls
from quiltmap.llm.common import Scratch

SHAPE = "doc_id long, text string, runs string, n_words int, doc int, twin string, first int, gone string, key string"


def with_names(spark, rows):
    return spark.createDataFrame([(i, t, "r", 1, 2, "t", 3, "g", "k") for i, t in rows], SHAPE)


# Periodic runs


def brute_runs(words, min_words=6, min_periods=4):
    out = []
    n = len(words)
    for q in range(1, n // min_periods + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            end = i + q
            shorter = any(all(words[k] == words[k + d] for k in range(start, end - d)) for d in range(1, q))
            if end - start >= max(min_words, min_periods * q) and not shorter:
                out.append((start, end - start, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def repetitive(seed):
    draw = random.Random(seed)
    words = []
    for _ in range(draw.randrange(1, 6)):
        unit = [draw.choice("ab" if draw.random() < 0.5 else "abcdefghijk") for _ in range(draw.choice([1, 2, 3, 7, 8, 9, 15, 16, 17, 31, 40]))]
        if draw.random() < 0.3:  # a unit that is nearly a repetition itself
            unit = unit[:3] * draw.randrange(1, 9) + ["z"]
        words += (unit * 9)[: int(len(unit) * draw.uniform(1, 6))]
        words += [draw.choice("abxyz") for _ in range(draw.randrange(4))]
    return words


def test_runs_are_all_found():
    for seed in range(400):
        words = repetitive(seed)
        (got,) = periodic_runs.runs_of([[w.encode() for w in words]], 6, 4)
        assert got == brute_runs(words), seed


def test_documents_searched_together_keep_apart():
    documents = [repetitive(s) for s in range(60)] + [[], ["a"] * 30, [], ["a"] * 30]
    got = periodic_runs.runs_of([[w.encode() for w in d] for d in documents], 6, 4)
    assert got == [brute_runs(d) for d in documents]


def test_periodic_runs(spark):
    long = "x y z " * 30_000 + "end"
    rows = [(1, "a b " * 4), (1, "a b " * 4), (2, None), (3, ""), (4, " \n\t"), (None, "q " * 9), (5, long), (6, "one two three"), (7, "é ü é ü " * 3)]
    docs = with_names(spark, rows)
    got = periodic_runs.periodic_runs(docs)
    assert got.columns == [*(c for c in docs.columns if c not in periodic_runs.NAMES), *periodic_runs.NAMES]
    found = {(r.doc_id, r.n_words): ([tuple(x) for x in r.runs], r.strongest and tuple(r.strongest), r.collapsed) for r in got.collect()}
    assert got.count() == len(rows)
    assert found[1, 8] == ([(0, 8, 2)], (0, 8, 2), "a b") and found[None, 9] == ([(0, 9, 1)], (0, 9, 1), "q")
    assert found[2, 0] == found[3, 0] == found[4, 0] == ([], None, "") and found[6, 3] == ([], None, "one two three")
    assert found[5, 90_001] == ([(0, 90_000, 3)], (0, 90_000, 3), "x y z end") and found[7, 6][2] == "é ü"
    assert periodic_runs.periodic_runs(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periodic_runs.periodic_runs(docs, min_periods=3)


def test_the_strongest_run_is_compared_exactly(spark):
    text = " ".join(["a", "b"] * 4 + ["c"] + ["d", "e"] * 4 + ["f"] + ["g", "h", "i"] * 4 + ["g"])
    (row,) = periodic_runs.periodic_runs(spark.createDataFrame([(text,)], "text string")).collect()
    assert tuple(row.strongest) == min(map(tuple, row.runs), key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))


# Substring dedup


def brute_kept(rows, width):
    """Kept words and how many went, of rows whose ids all differ."""
    rows = sorted(rows)
    seen, out = set(), {}
    for i, text in rows:
        words = (text or "").split(" ") if text else []
        gone = set()
        for at in range(len(words) - width + 1):
            window = tuple(words[at : at + width])
            if window in seen:
                gone |= set(range(at, at + width))
            seen.add(window)
        out[i] = (" ".join(w for k, w in enumerate(words) if k not in gone), len(gone))
    return out


def passages(seed, n=40, vocabulary=6):
    draw = random.Random(seed)
    shared = [[draw.choice("abcdefgh") * draw.randrange(1, 3) for _ in range(draw.randrange(3, 30))] for _ in range(5)]
    rows = []
    for i in range(n):
        words = []
        for _ in range(draw.randrange(1, 6)):
            words += draw.choice(shared) if draw.random() < 0.6 else [str(draw.randrange(vocabulary)) for _ in range(draw.randrange(12))]
        rows.append((i * 3, " ".join(words)))
    return rows


@pytest.mark.parametrize("seed, width", [(0, 4), (1, 8), (2, 8), (3, 20), (4, 12)])
def test_repeated_windows_go(spark, seed, width):
    rows = passages(seed, vocabulary=2 if seed == 2 else 9)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.text, r.n_removed) for r in substring_dedup.substring_dedup(docs, window=width).collect()}
    assert got == brute_kept(rows, width)


def test_windows_met_in_many_small_batches(spark):
    """A passage of every document, and one gram in many surroundings, over many tasks and batches."""
    hot = "u v w x y z " * 2
    rows = [(i, f"{hot}m{i} n{i} a b c d e o{i} p{i} q{i} r{i} s{i}") for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        got = {r.doc_id: (r.text, r.n_removed) for r in substring_dedup.substring_dedup(docs, window=8).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    assert got == brute_kept([(i, " ".join(t.split())) for i, t in rows], 8)


def test_substring_dedup_edges(spark):
    passage = " ".join(f"w{i}" for i in range(24))
    long = " ".join(str(i) for i in range(50_000))
    rows = [(1, passage), (2, passage + " more"), (2, passage + " more"), (2, "other " + passage), (None, passage), (None, passage), (3, None), (4, ""), (5, " \n"), (6, long), (7, long + " " + passage), (8, "one")]
    docs = with_names(spark, rows)
    got = substring_dedup.substring_dedup(docs)
    assert got.columns == [*(c for c in docs.columns if c != "n_words"), "n_words", "n_removed"] and got.count() == len(rows)
    found = sorted(((r.doc_id or 0, r.text, r.n_words, r.n_removed) for r in got.collect()), key=str)
    want = [(1, passage, 24, 0), (2, "more", 25, 24), (2, "more", 25, 24), (2, "other", 25, 24), (0, "", 24, 24), (0, "", 24, 24), (3, "", 0, 0), (4, "", 0, 0), (5, "", 0, 0), (6, long, 50_000, 0), (7, "", 50_024, 50_024), (8, "one", 1, 0)]
    assert found == sorted(want, key=str)
    assert substring_dedup.substring_dedup(docs.limit(0)).count() == 0
    assert substring_dedup.substring_dedup(docs.where("doc_id > 7")).count() == 1
    with pytest.raises(ValueError):
        substring_dedup.substring_dedup(docs, window=18)


def test_a_third_without_an_id(spark):
    """Rows without an id come last, by a hash of their text, and no passage is lost or kept twice."""
    passage = " ".join(f"w{i}" for i in range(20))
    rows = [(None if i % 3 else i, f"a{i} b{i} {passage} c{i}") for i in range(60)]
    got = substring_dedup.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)).collect()
    kept = [r for r in got if r.n_removed == 0]
    assert len(got) == 60 and [r.doc_id for r in kept] == [0] and {r.n_removed for r in got} == {0, 20}


# Hard negatives


def brute_negatives(rows, every=100, positives=5, negatives=10, low=30, high=90):
    clean = {(i, y, tuple(int(np.floor(256 * float(np.float32(x)))) for x in v)) for i, y, v in rows if None not in (i, y, v) and None not in v and np.isfinite(v).all()}
    out = set()
    for a in clean:
        if a[0] % every:
            continue
        scored = sorted((-sum(p * q for p, q in zip(a[2], b[2], strict=True)), b[0], b) for b in clean if b != a and len(b[2]) == len(a[2]))
        for s, i, _ in [x for x in scored if x[2][1] == a[1]][:positives]:
            inside = [x for x in scored if x[2][1] != a[1] and low * -s <= 100 * -x[0] <= high * -s][:negatives]
            out |= {(a[0], i, k + 1, x[1], -s, -x[0]) for k, x in enumerate(inside)}
    return out


@pytest.fixture
def small_parts(monkeypatch):
    monkeypatch.setattr(hard_negatives, "PART_VALUES", 64)
    monkeypatch.setattr(hard_negatives, "BLOCK_VALUES", 16)
    monkeypatch.setattr(hard_negatives, "PARTS", 3)


@pytest.mark.parametrize("seed", range(3))
def test_negatives_match_brute_force(spark, small_parts, seed):
    draw = np.random.default_rng(seed)
    rows = [(i, int(draw.integers(3)), draw.normal(size=4).round(1 if seed else 0).tolist()) for i in range(0, 900, 4)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").repartition(5)
    got = [tuple(r) for r in hard_negatives.hard_negatives(df, F.col("id") % 100 == 0).collect()]
    want = brute_negatives(rows)
    assert len(got) == len(want) and set(got) == want


def test_negatives_edges(spark, small_parts):
    rows = [
        (0, 1, [1.0, 0.5]), (0, 1, [1.0, 0.5]), (1, 1, [1.0, 0.25]), (2, 1, [0.0, 0.0]), (3, 2, [0.5, 0.5]), (4, 2, [0.0, 0.0]), (5, 2, [0.5, 0.5]),
        (6, 2, None), (7, None, [0.5, 0.5]), (None, 2, [0.5, 0.5]), (8, 2, [float("nan"), 1.0]), (9, 2, [float("inf"), 1.0]), (10, 2, [None, 1.0]),
        (100, 3, [1.0, 1.0]), (200, 1, [1.0]), (201, 1, [0.5]), (202, 2, [0.25]), (300, 4, []), (301, 4, []), (302, 5, []), (11, 1, [-1.0, -1.0]), (12, 2, [-0.5, -0.5]),
    ]
    df = spark.createDataFrame([(*r, 1, "k", 2.0) for r in rows], "vec_id long, label int, embedding array<float>, id int, anchor string, score double")
    got = [tuple(r) for r in hard_negatives.hard_negatives(df, F.col("id") % 100 == 0).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_negatives(rows)
    assert {g[0] for g in got} == {0, 200, 300}
    assert hard_negatives.hard_negatives(df.limit(0), F.col("id") % 100 == 0).count() == 0
    big = spark.createDataFrame([(0, 1, [3e7]), (1, 1, [3e8])], "vec_id long, label int, embedding array<float>")
    with pytest.raises(Exception, match="64 bits"):
        hard_negatives.hard_negatives(big, F.col("id") == 0).collect()


def test_rows_of_one_id_each_count(spark, small_parts):
    rows = [(0, 1, [1.0, 1.0]), (0, 1, [0.5, 0.5]), (1, 1, [1.0, 1.0]), (2, 2, [0.5, 0.25]), (0, 2, [0.25, 0.5])]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    got = [tuple(r) for r in hard_negatives.hard_negatives(df, F.col("id") % 100 == 0).collect()]
    assert set(got) == brute_negatives(rows)


def test_keys_sort_as_what_they_stand_for():
    score = np.array([5, 5, 5, -3, 0, 1 << 40, -(1 << 40)], np.int64)
    ids = np.array([2, 1, -7, 0, 9, 4, 4], np.int64)
    keys = hard_negatives.packed_keys(score, 1, ids, ids * 0).to_pylist()
    order = sorted(range(7), key=keys.__getitem__)
    assert order == sorted(range(7), key=lambda i: (-score[i], ids[i])) and [hard_negatives.key_of(k) for k in keys] == [(s, 1, i) for s, i in zip(score, ids, strict=True)]
    assert hard_negatives.anchor_of(hard_negatives.anchor_bytes(-5, 7)) == (-5, 7)


# Levels of calls


def brute_levels(calls):
    needs = {}
    for call, after in calls:
        needs.setdefault(call, set()).update(after)
    found = {}
    while True:
        more = {c: 1 + max((found[x] for x in n), default=-1) for c, n in needs.items() if c not in found and all(x in found for x in n)}
        if not more:
            return found
        found |= more


def random_calls(seed):
    draw = random.Random(seed)
    calls = []
    for i in range(60):
        near = [f"c{draw.randrange(max(0, i - 6), i + (3 if draw.random() < 0.1 else 0) or 1)}" for _ in range(draw.choice([0, 1, 1, 1, 1, 2, 3]))] if i else []
        calls.append((f"c{i}", near + (["unknown"] if draw.random() < 0.03 else []) + ([None] if draw.random() < 0.02 else [])))
    return calls + calls[:2]


@pytest.mark.parametrize("calls", [random_calls(1), random_calls(2), [("c0", [])] + [(f"c{i}", [f"c{i - 1}"]) for i in range(1, 70)], [("a", ["b"]), ("b", ["a"]), ("c", ["b"]), ("d", [])]], ids=["graph", "other", "chain", "circle"])
def test_levels_of_calls(spark, calls):
    df = spark.createDataFrame(calls, "call_id string, after array<string>")
    got = tool_calls.levels(df, Scratch(spark, "levels"))
    assert {r.call_id: r.level for r in got.collect()} == brute_levels(calls)
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Relation") <= 3  # whatever the longest chain


def test_the_turn_before_across_windows(spark, monkeypatch):
    monkeypatch.setattr(tool_calls, "TURNS", 8)
    rows = [(c, t) for c in (1, None) for t in (0, 3, 7, 8, 40, 41, 90)] + [(2, 5)]
    got = sorted((r.conv_id or 0, r.turn, r.before) for r in tool_calls.turn_before(spark.createDataFrame(rows, "conv_id long, turn long")).collect())
    chain = [(0, None), (3, 0), (7, 3), (8, 7), (40, 8), (41, 40), (90, 41)]
    assert got == sorted([(c, *x) for c in (0, 1) for x in chain] + [(2, 5, None)], key=lambda x: x[:2])


# Near-dedup: links left beside a hub


def family(draw, base, edits):
    words = list(base)
    for at in draw.sample(range(len(words)), edits):
        words[at] = f"e{draw.randrange(10**6)}" if draw.random() < 0.7 else draw.choice(["same", "edit"])
    return " ".join(words)


@pytest.mark.parametrize("seed", range(3))
def test_near_copies_around_a_hub(spark, seed):
    """Variants of a few texts at likenesses on both sides of 0.8, with families of their own among those far from the hub."""
    draw = random.Random(seed)
    texts = []
    for _ in range(2):
        base = [f"w{draw.randrange(400)}" for _ in range(120)]
        texts += [family(draw, base, draw.choice([0, 1, 2, 3])) for _ in range(40)]
        for _ in range(6):
            far = family(draw, base, draw.choice([4, 5, 6])).split(" ")
            texts += [family(draw, far, draw.choice([0, 1, 2])) for _ in range(draw.choice([1, 4]))]
    draw.shuffle(texts)
    sets = [{tuple(w[i : i + 4]) for i in range(len(w) - 3)} for w in (t.split(" ") for t in texts)]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.component_id for r in minhash_dedup.near_dedup(docs, words=4).collect()}
    assert got == {i: find(i) for i in range(len(texts))} and len(set(got.values())) > 2


def test_a_family_is_described_once_and_not_once_for_each_hub(spark, monkeypatch):
    """Copies edited at several of 60 words have many hubs; the differences made rows do not grow with those."""
    draw = random.Random(3)
    base = [f"w{i}" for i in range(60)]
    texts = []
    for _ in range(800):
        words = list(base)
        for at in draw.sample(range(60), draw.choice([0, 1, 1, 2, 2, 3])):
            words[at] = f"e{draw.randrange(10**6)}" if draw.random() < 0.5 else f"v{draw.randrange(5)}"
        texts.append(" ".join(words))
    seen = {}

    class Kept(Scratch):
        def write(self, df, name):
            seen[name] = super().write(df, name)
            return seen[name]

    monkeypatch.setattr(minhash_dedup, "Scratch", Kept)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.component_id for r in minhash_dedup.near_dedup(docs, words=4).collect()}
    sets = [{tuple(w[i : i + 4]) for i in range(len(w) - 3)} for w in (t.split(" ") for t in texts)]
    for i in range(len(sets)):
        for j in range(i):
            if got[i] != got[j]:
                assert 100 * len(sets[i] & sets[j]) < 80 * len(sets[i] | sets[j])
    described = seen["described"]
    ids = described.select("id").distinct().count()
    assert seen["hubs"].select("hub").distinct().count() > 50 and ids > 200
    assert described.count() <= 1.5 * ids


def test_a_hub_that_leads_another_is_linked_with_the_sets_of_its_buckets(spark):
    """3 is linked with 1, which leads the hub of 3's bucket, and with nothing in the bucket itself."""
    sets = {1: range(100), 2: range(30, 130), 3: [*range(15), *range(20, 100), *range(200, 205)], 4: range(1, 101), 5: range(2, 102)}
    keys = [(1, 10), (4, 10), (5, 10), (1, 11), (2, 11), (2, 12), (3, 12)]
    lone = {1: 0, 2: 1, 3: 5, 4: 2, 5: 3}
    rows = spark.createDataFrame([(i, list(h)) for i, h in sets.items()], "id long, hashes array<long>")
    # lone counts choose the hubs here
    members = spark.createDataFrame([(i, len(sets[i]), lone[i], k) for i, k in keys], "id long, size int, lone int, key long")
    none = spark.createDataFrame([], "id long, lone array<long>")
    got = minhash_dedup.merge_buckets(Scratch(spark, "led"), members, rows, none, 80).collect()
    assert {r.id: r.root for r in got if r.id != r.root} == {3: 1, 4: 1, 5: 1}


def test_repeats_of_a_row_are_one_text(spark):
    docs = spark.range(300).selectExpr("7L AS doc_id", "'a b c d e f g h i j' AS text").union(spark.range(3).selectExpr("id AS doc_id", "'a b c d e f g h i j' AS text"))
    sketches = docs.selectExpr("doc_id AS id", "text").mapInArrow(minhash_dedup.sketch(4), "id long, size long, digest binary, halves array<long>")
    assert sketches.select("digest").distinct().count() == 1
    got = minhash_dedup.near_dedup(docs, words=4).collect()
    assert len(got) == 303 and {r.component_id for r in got} == {0} and sum(r.kept for r in got) == 1


def test_exact_dedup_deals_texts_with_one_beginning(spark):
    """Ranges split texts that begin alike, and what goes to the driver to find them does not grow with the texts."""
    from quiltmap.llm import exact_dedup

    docs = spark.range(400).selectExpr("id AS doc_id", "concat(repeat('same beginning ', 400), id % 150) AS text").repartition(8)
    got = exact_dedup.exact_dedup(docs)
    assert {(r.doc_id % 150, r.keep_id, r.group_size) for r in got.collect()} == {(i, i, 3 if i < 100 else 2) for i in range(150)}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning(substring(norm" in plan

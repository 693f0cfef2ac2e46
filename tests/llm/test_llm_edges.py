"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns."""

import pytest

from quiltmap.llm import exact_dedup, fingerprints, html_extract, line_dedup, minhash_dedup, mixing, packing, tool_calls, toxicity, url_filters

SHAPE = "doc_id long, text string, lang string, source string, n_chars long, id string, size int, digest string, key string, block int, score string"
LONG = "word " * 60_000 + "end"


def rows():
    some = [(1, "a b c d e f\nx"), (2, "a b c d e f\nx"), (2, "a b c d e f\nx"), (3, None), (4, ""), (5, " \n\t"), (None, "a b c d e f\nx"), (None, None), (6, LONG), (7, LONG + " more"), (8, "é  ü\x1c"), (9, "one")]
    return [(i, t, None, None if k % 3 else f"s{k % 2}", None, "x", k, None, "k", 3, "y") for k, (i, t) in enumerate(some)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SHAPE)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SHAPE)


def test_exact_dedup(docs, none):
    got = exact_dedup.exact_dedup(docs).collect()
    assert len(got) == len(rows())
    assert sorted((r.doc_id is None, r.keep_id, r.group_size, r.kept) for r in got if r.doc_id in (1, 2, None)) == sorted(
        [(False, 1, 4, True), (False, 1, 4, False), (False, 1, 4, False), (True, 1, 4, False), (True, 5, 4, False)]
    )
    assert {r.doc_id for r in got if r.keep_id == 5} == {3, 4, 5, None}  # blank ones: the longest stays
    assert exact_dedup.exact_dedup(none).count() == 0


def test_line_dedup(docs, none):
    got = line_dedup.line_dedup(docs, min_docs=4)
    assert got.columns == [*docs.columns, "n_lines", "n_dropped"]
    by_id = {(r.doc_id, r.size): r for r in got.collect()}
    assert len(by_id) == len(rows())
    assert by_id[1, 0].text == "" and by_id[1, 0].n_dropped == 2 and by_id[None, 6].text == ""
    assert by_id[3, 3].text == "" and by_id[3, 3].n_lines == 1 and by_id[5, 5].text == " \n\t" and by_id[6, 8].text == LONG
    first = {(r.doc_id, r.size): r.text for r in line_dedup.line_dedup(docs, min_docs=2, keep="first").collect()}
    assert first[1, 0] == "a b c d e f\nx" and first[2, 1] == first[2, 2] == first[None, 6] == ""
    assert line_dedup.line_dedup(none).count() == 0


def test_line_dedup_of_one_partition_of_copies(spark):
    """All lines of the task occur twice within a slice, so none of its keys is in the first filter."""
    docs = spark.createDataFrame([(i, "one line\nanother") for i in range(12)], "doc_id long, text string").repartition(1)
    got = line_dedup.line_dedup(docs).collect()
    assert len(got) == 12 and {(r.text, r.n_lines, r.n_dropped) for r in got} == {("", 2, 2)}
    first = {r.doc_id: (r.text, r.n_dropped) for r in line_dedup.line_dedup(docs, keep="first").collect()}
    assert first == {i: ("", 2) if i else ("one line\nanother", 0) for i in range(12)}


def test_near_dedup(docs, none):
    got = minhash_dedup.near_dedup(docs, words=4).collect()
    assert len(got) == len(rows())
    by_id = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got if r.doc_id is not None}
    assert by_id[1] == (4, 1, True) and by_id[2] == (4, 1, False) and by_id[3] == (0, 3, True) and by_id[5] == (0, 5, True) and by_id[9] == (1, 9, True)
    assert sorted((r.n_shingles, r.component_id, r.kept) for r in got if r.doc_id is None) == [(0, None, True), (4, None, True)]
    assert minhash_dedup.near_dedup(none).count() == 0


def test_pack(docs, none):
    path = packing.default_path()
    got = packing.pack(docs, path=path).collect()
    assert sum(r.length for r in got) == sum(r.doc_tokens for r in got if r.start == 0)
    assert {r.doc_tokens for r in got if r.doc_id in (3, 4)} == {1} and all(r.length * 4 == len(r.ids) for r in got)
    assert packing.pack(none, path=path).count() == 0


def test_mix(docs, none):
    counts = {(r.id, r.size): r for r in mixing.mix_counts(docs).collect()}
    assert counts[3, 0].size == 0
    got = mixing.mix(docs)
    assert got.columns == [*docs.columns, "shard"]
    most = {}
    for r in got.collect():
        most[r.size] = most.get(r.size, 0) + 1
    assert max(most.values()) <= 2
    assert mixing.mix(none).count() == 0 and mixing.mix_counts(none).count() == 0


def test_toxicity(spark, docs, none):
    labels = spark.createDataFrame([(1, None, 1), (9, 0, 0), (None, 0, 1), (77, 0, None)], "doc_id long, quality int, toxic int")
    lexicon = toxicity.learn(docs, labels)
    got = toxicity.score(docs, lexicon)
    assert got.columns == [c for c in docs.columns if c != "score"] + ["score"]
    assert got.count() == len(rows()) and all(0 <= r.score <= 1 for r in got.collect())
    empty = toxicity.learn(none, labels)
    assert empty.weights == {} and toxicity.score(none, empty).count() == 0


def test_fingerprints(spark, docs, none):
    got = fingerprints.edit_fingerprints(docs).collect()
    assert len(got) == len(rows())
    by_text = {}
    for r in got:
        if r.n_chars == 13:
            by_text.setdefault(r.n_chars, set()).add(r.fingerprint)
    assert len(by_text[13]) == 1 and {r.fingerprint for r in got if r.n_chars == 0} == {""}
    assert fingerprints.edit_fingerprints(none).count() == 0
    (one,) = fingerprints.edit_fingerprints(docs.where("doc_id = 9")).collect()
    assert one.near_next == 1.0 and fingerprints.near_texts(none).count() == 0


def test_pages(spark):
    shape = "page_id long, url string, html string, text string, host int, rule string"
    pages = spark.createDataFrame(
        [(1, "http://A.com/x", "<article><p>a</p></article>", "t", 1, "r"), (1, "http://A.com/x", "<article><p>a</p></article>", "t", 1, "r"), (None, None, None, None, None, None), (2, "odd", "", "t", 1, "r"), (3, "", "<b>", "t", 1, "r"), (4, "://", "<p>" + LONG, "t", 1, "r")],
        shape,
    )
    got = html_extract.extract(pages)
    assert got.columns == ["page_id", "url", "html", "host", "rule", "text"]
    assert sorted((r.page_id or 0, r.text) for r in got.collect()) == [(0, ""), (1, "a"), (1, "a"), (2, ""), (3, ""), (4, LONG)]
    judged = url_filters.url_filter(pages).select("page_id", "host", "path", "rule", "verdict").collect()
    assert sorted((r.page_id or 0, r.host, r.path, r.rule, r.verdict) for r in judged if r.page_id != 1) == [(0, "", "", None, "allow"), (2, "", "", None, "allow"), (3, "", "", None, "allow"), (4, "", "", None, "allow")]
    assert [tuple(r)[1:] for r in judged if r.page_id == 1] == [("a.com", "/x", "com/", "allow")] * 2
    empty = spark.createDataFrame([], shape)
    assert html_extract.extract(empty).count() == 0 and url_filters.url_filter(empty).count() == 0


def test_tool_calls(spark):
    calls = spark.createDataFrame(
        [
            (1, "a", "add", '{"x":1}', None, 5), (1, "b", "add", '{"x":"1"}', ["a"], 5), (1, "c", "add", "{", ["a"], 5), (1, "d", "add", '{"x":2}', ["e"], 5), (1, "e", "add", '{"x":2}', ["d"], 5),
            (None, "f", "none", None, ["a", "b"], 5), (2, None, "add", '{"x":3}', [], 5), (2, "g", "add", '{"x":3}', ["zzz"], 5), (2, "h", "add", '{"x":4}', ["a", "b"], 5), (2, "h", "add", '{"x":4}', ["a", "b"], 5),
        ],
        "conv_id long, call_id string, name string, arguments string, after array<string>, level int",
    )
    results = spark.createDataFrame([("a", "2"), ("a", "1"), ("h", None), (None, "x"), ("b", "é\n")], "call_id string, result string")
    schema = {"add": {"type": "object", "required": ["x"], "properties": {"x": {"type": "integer"}}, "additionalProperties": False}}
    got = sorted((r.call_id or "", r.status, r.level) for r in tool_calls.link_calls(calls, results, schema).collect())
    assert [g[1] for g in got] == ["cycle", "ok", "bad_arguments", "bad_json", "cycle", "cycle", "unknown_tool", "cycle", "ok", "ok"]
    assert {g[0]: g[2] for g in got if g[0] in "abfh" and g[0]} == {"a": 0, "b": 1, "f": 2, "h": 2}
    assert tool_calls.link_calls(calls.limit(0), results, schema).count() == 0
    assert tool_calls.canonical({"b": 1, "a": "é\n"}) == '{"a":"é\\n","b":1}'
    assert tool_calls.problems({"x": True, "y": 1}, schema["add"]) == ["$.x: not integer", "$.y: unknown"]

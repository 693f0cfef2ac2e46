"""The pipeline's stages on planted documents, and its run against what the stages must keep."""

import os
import random

import corpus_pipeline as pipeline
from quiltmap.llm import packing


def test_stages_in_order():
    assert [name for name, _ in pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "mix", "pack"]


def planted(spark, folder):
    rng = random.Random(8)
    words = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in ("lin", "mar", "tos", "ven")]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    shared = say(60)
    docs, kinds = [], {}

    def add(kind, text):
        kinds[len(docs)] = kind
        docs.append((len(docs), text, "en", f"src{len(docs) % 2}", len(text)))

    for i in range(120):
        add("toxic" if i % 3 == 0 else "clean", "\n".join([say(30), say(20) + (" idiot scum " if i % 3 == 0 else " ") + say(10)]))
    for _ in range(14):
        add("shared", say(40) + "\n" + shared + "\n" + say(40))
    base = say(200).split()
    for i in range(6):
        add("copy", " ".join(base[: 190 + i]))
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, int(k == "toxic")) for i, k in kinds.items()]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return {i: t for i, t, *_ in docs}, kinds, shared


def test_each_stage_takes_effect_and_spares_clean_documents(spark, tmp_path):
    texts, kinds, shared = planted(spark, str(tmp_path))
    of = lambda kind: {i for i, k in kinds.items() if k == kind}
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = {}
    for name, stage in pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = docs.collect()
    ids = {name: [r.doc_id for r in rows] for name, rows in seen.items()}
    assert set(ids["toxicity"]) == set(kinds) - of("toxic")
    lines = {r.doc_id: r for r in seen["line_dedup"]}
    assert set(lines) == set(ids["toxicity"])
    first = min(of("shared"))
    for i, r in lines.items():
        want = texts[i] if kinds[i] != "shared" or i == first else texts[i].replace(shared + "\n", "")
        assert r.text == want and r.n_chars == len(want)
    assert set(ids["near_dedup"]) == set(lines) - (of("copy") - {min(of("copy"))})
    assert set(ids["mix"]) <= set(ids["near_dedup"]) and max(ids["mix"].count(i) for i in ids["mix"]) <= 2
    tokens = {}
    for r in seen["pack"]:
        tokens[r.doc_id] = tokens.get(r.doc_id, 0) + r.length
    vocab = packing.vocabulary(packing.default_path())
    kept = {r.doc_id: r.text for r in seen["near_dedup"]}
    assert tokens == {i: ids["mix"].count(i) * (len(vocab.encode(kept[i])) // 4 + 1) for i in set(ids["mix"])}
    before = set(os.listdir(spark.conf.get("spark.checkpoint.dir")))
    assert sorted(tuple(r) for r in pipeline.run(spark, str(tmp_path)).select("doc_id", "start", "length", "ids_crc32").collect()) == sorted((r.doc_id, r.start, r.length, r.ids_crc32) for r in seen["pack"])
    # of all tables below the shared folder only the last stage's is left
    (left,) = set(os.listdir(spark.conf.get("spark.checkpoint.dir"))) - before
    assert os.listdir(os.path.join(spark.conf.get("spark.checkpoint.dir"), left)) == ["pack"]


SHAPE = "doc_id long, text string, lang string, source string, n_chars long, key string, id int, score double"


def test_stages_take_nulls_repeats_and_nothing(spark, tmp_path):
    line = "\n".join(["a line that many share", "own words of this document here"])
    rows = [(1, line), (1, line), (2, None), (3, ""), (4, " \n"), (None, line), (None, None), (5, "word " * 30_000), *((10 + i, f"a line that many share\nand what only document {i} says, number {i * i}") for i in range(12))]
    docs = spark.createDataFrame([(i, t, None, None if k % 2 else "s", None, "k", 7, 1.5) for k, (i, t) in enumerate(rows)], SHAPE)
    spark.createDataFrame([(1, 1, 0), (None, 0, 1), (10, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    out = {}
    for name, stage in pipeline.STAGES:
        got = stage(spark, docs, str(tmp_path))
        assert name == "pack" or got.columns == docs.columns
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0
        out[name] = got.collect()
    ids = {name: sorted((r.doc_id is None, r.doc_id or 0) for r in found) for name, found in out.items()}
    everyone = sorted((i is None, i or 0) for i, _ in rows)
    assert ids["toxicity"] == everyone and ids["line_dedup"] == everyone
    texts = {(r.doc_id, r.text) for r in out["line_dedup"]}
    assert (2, "") in texts and (1, line) in texts and (None, "own words of this document here") in texts
    # ten rows or more share the line, and it stays in both rows of the smallest id
    assert sum("a line that many share" in r.text for r in out["line_dedup"]) == 2
    assert ids["near_dedup"] == everyone
    assert {r.doc_id for r in out["mix"]} <= {i for i, _ in rows}
    assert sum(r.doc_tokens for r in out["pack"] if r.doc_id in (2, 3)) == 2

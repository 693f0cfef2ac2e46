"""Operators against brute force, round trips and held-out accuracy."""

import hashlib
import html
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quiltmap.llm import components, fingerprints, html_extract, minhash_dedup, mixing, packing, toxicity, url_filters
from quiltmap.llm.common import Scratch, filter_bits, holds, put, put_twice
from quiltmap.llm.queries import QUERIES


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def test_bloom_filters_miss_nothing():
    keys = np.random.default_rng(1).integers(0, 1 << 63, 5000, dtype=np.uint64)
    once, twice = np.zeros(filter_bits(5000) // 8, np.uint8), np.zeros(filter_bits(5000) // 8, np.uint8)
    put_twice(once, twice, keys[:4000])
    put_twice(once, twice, keys[3000:])
    assert holds(once, keys).all() and holds(twice, keys[3000:4000]).all() and holds(twice, keys[:3000]).mean() < 0.02
    bloom = np.zeros_like(once)
    put(bloom, keys[:10])
    assert holds(bloom, keys[:10]).all() and not holds(bloom, keys[10:]).any()


def test_components_by_brute_force(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(120), rng.randrange(120)) for _ in range(90)] + [(i, i + 1) for i in range(200, 230)]
    root = {x: x for e in edges for x in e}
    for _ in range(len(root)):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    found = components.components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "t"), "e")
    assert {r.node: r.root for r in found.collect()} == {x: r for x, r in root.items() if x != r}


def test_near_copies_are_linked_by_full_sets(spark):
    """Families of edited copies, and short texts around one common line, against all pairs."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(4000)]
    docs = []
    for _ in range(12):
        base = [rng.choice(words) for _ in range(rng.choice([30, 120]))]
        for _ in range(12):
            copy = list(base)
            for _ in range(rng.randrange(0, max(2, len(base) // 12))):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            docs.append(" ".join(copy))
    line = " ".join(words[:12])
    docs += [line + " " + " ".join(rng.choice(words) for _ in range(rng.randrange(3, 12))) for _ in range(60)]
    sets = []
    for text in docs:
        w = text.split()
        sets.append({tuple(w[i : i + 4]) for i in range(len(w) - 3)})
    root = list(range(len(docs)))
    for _ in range(20):
        for i in range(len(docs)):
            for j in range(i):
                both = len(sets[i] & sets[j])
                if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                    root[i] = root[j] = min(root[i], root[j])
    got = minhash_dedup.near_dedup(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string"), words=4)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == {i: (len(sets[i]), root[i]) for i in range(len(docs))}


def test_extraction_leaves_out_what_is_no_article(spark):
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="no-sidebar"><header><h1>Site</h1></header>
      <nav><ul><li><a href=/>Home</a></ul></nav><div id="cookie-notice">We use cookies</div><!-- <p>old</p> -->
      <main><article><header><h2>A&nbsp;title &amp; more</h2></header><p>One <b>two</b>
        three<br>four<p>Five &#x263a;<script>var p="</p>";</script><div class="ad">Buy</div><h2>Part</h2><p>Six<ul><li>x<li>y</ul>
      <form><p>Name</p><input></form><section id="comments"><p>First!</p></section></article></main>
      <aside><p>Related</p></aside><footer>&copy;</footer></body></html>"""
    rows = [(i, f"http://h{i % 2}.org/{i}", page.replace("One", f"One{i}")) for i in range(6)]
    got = html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in got} == {i: f"A title & more\nOne{i} two three four\nFive ☺\nPart\nSix\nx\ny" for i in range(6)}


def test_extraction_without_an_article_element(spark):
    rng = random.Random(1)
    text = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(n))
    rows, want = [], {}
    for i in range(8):
        parts = [text(30) for _ in range(rng.randrange(1, 5))]
        body = "".join(f"<h3>{p[:11]}</h3><p>{p}</p>" for p in parts)
        rows.append((i, "http://h/", f"<body><div class=top>Our site</div><div class=links><a href=1>{text(3)}</a></div><div class=body>{body}</div><div class=foot>All rights</div></body>"))
        want[i] = "\n".join(x for p in parts for x in (p[:11].strip(), p))
    got = html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in got} == want


def test_extraction_of_hosts_with_several_templates(spark):
    """Article pages, two containers and a page of copies on one host, and the same without a host."""
    rng = random.Random(4)
    text = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(n))
    frame = "<body><div class=top>Our site</div>{}<div class=foot>All rights</div></body>"
    rows, want = [], {}
    copied = text(40)
    for i in range(18):
        main = text(60 if i % 3 else 20)
        shape = ("<article><h1>{}</h1></article>", "<div class=content><p>{}</p></div>", "<div class=post><p>{}</p></div>")[i % 3]
        if i > 15:
            main, shape = copied, "<section class=copy><p>{}</p></section>"
        for k, url in ((i, "http://h/"), (100 + i, None)):
            rows.append((k, url, frame.format(shape.format(main))))
            want[k] = main
    rows.append((50, "http://h/", frame.format("")))
    want[50] = ""
    got = html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in got} == want


def test_wrappers_fold_squares_and_options():
    page = lambda n, extra: "<body><div class=t>Top</div><article>" + "".join(f"<h2>a{i}</h2><p>b</p><p>c</p>" for i in range(n)) + "</article>" + extra + "</body>"
    one, two = (html_extract.stream(html_extract.blocks(p)) for p in (page(3, ""), page(2, "<div class=z>end</div>")))
    both = html_extract.align(one, two)
    text = html_extract.expression(both)
    assert re.fullmatch(r"page>body>div\.t =\w+ \(page>body>article>h2 #TEXT \(page>body>article>p #TEXT\)\+\)\+ \(page>body>div\.z #TEXT\)\?", text), text


def test_op1_on_the_pages(spark, sf_dir):
    pages = {r.page_id: r.html for r in table(spark, sf_dir, "pages").collect()}
    for r in QUERIES["op1_html_extraction"](spark, sf_dir).collect():
        body = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        blocks = re.split(r"</?(?:p|h1)>", body)
        want = [" ".join(html.unescape(re.sub(r"<[^>]*>", " " if "br" in b else "", b)).split()) for b in blocks]
        assert r.text == "\n".join(w for w in want if w) and r.n_chars == len(r.text)


def test_folding_and_exceptions():
    lexicon = toxicity.Lexicon({"idiot$": 2.0, "idiot~": 2.0, "trash$": 1.0, "achiich~": 1.0}).build()
    hits = lambda t: lexicon.features(t)[0]
    plain = hits("you idiot")
    assert all(hits(t) == plain for t in ("you IDIOT.", "you 1d10t", "you іdіоt", "you ídïöt", "you idiots"))
    assert hits("the trash can") == hits("videot") == hits("achlich") == hits("") == hits(None) == 0
    assert hits("trash") > 0 and hits("achliche") > 0 and len(toxicity.fold("İSTANBUL ß")) == len("İSTANBUL ß")
    assert lexicon.features("idiot " + "word " * 50)[1] > lexicon.features("idiot " + "word " * 5000)[1]


def test_toxicity_on_the_held_out_fold(spark):
    rng = random.Random(2)
    clean = [" ".join(rng.choice(["red", "green", "blue", "idiom", "trashy"]) + str(rng.randrange(9)) * 0 for _ in range(40)) for _ in range(600)]
    docs, labels = [], []
    for i, text in enumerate(clean):
        toxic = int(i % 4 == 0)
        words = text.split()
        if toxic:
            words[rng.randrange(40)] = rng.choice(["idiot", "1di0t", "scum", "vequ" + rng.choice("abcdef") * 2])
        docs.append((i, " ".join(words)))
        labels.append((i, 0, toxic))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    lexicon = toxicity.learn(frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    held = {i for i, _ in docs if zlib.crc32(str(i).encode()) % 5 == 0}
    got = {r.doc_id: r.score >= 0.5 for r in toxicity.score(frame, lexicon).collect()}
    assert {i: got[i] for i in held} == {i: i % 4 == 0 for i in held}


def test_targets_level_off_like_the_rounds(spark):
    sizes = {"a": 10, "b": 400, "c": 30, "é": 100, None: 60}
    rows = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    order = ["a", "b", "c", "é", None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    left, want, open_ = 1.5 * sum(sizes.values()), {}, set(order)
    while True:
        total = sum(weight[s] for s in open_)
        above = {s for s in open_ if left * weight[s] / total > 2 * sizes[s]}
        if not above:
            want |= {s: left * weight[s] / total for s in open_}
            break
        for s in above:
            want[s] = 2.0 * sizes[s]
            left -= want[s]
        open_ -= above
    assert {r.source: r.target for r in mixing.targets(rows).collect()} == pytest.approx(want)


def test_mix_meets_its_targets(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_WORDS", 400)
    monkeypatch.setattr(mixing, "SHARD_BLOCKS", 16)
    docs = table(spark, sf_dir, "documents")
    rows = mixing.mix_counts(docs).collect()
    again = mixing.mix_counts(docs).collect()
    assert sorted((r.id, r.draws) for r in rows) == sorted((r.id, r.draws) for r in again)
    taken, most = {}, {}
    for r in rows:
        taken[r.source] = taken.get(r.source, 0) + r.size * len(r.draws)
        most[r.source] = max(most.get(r.source, 0), r.size)
        assert len(r.draws) <= 2 and len({d["pass"] for d in r.draws}) == len(r.draws)
    for r in rows:
        assert taken[r.source] <= r.target + 1e-6 and r.target - taken[r.source] <= most[r.source]
    mixed = mixing.mix(docs).select("doc_id", "shard").collect()
    assert sorted((r.doc_id, r.shard) for r in mixed) == sorted((r.id, d["shard"]) for r in rows for d in r.draws)
    shards = [r.shard for r in mixed]
    assert len(set(shards)) > 4


def test_packing_round_trip(spark, sf_dir):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.default_path())
    tokenizer.encode_special_tokens = True
    extra = [(-1, "a  b\n\nc \t d<|endoftext|> it's"), (-2, None), (-3, "\x1c x  "), (-4, " lead and trail ")]
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string"))
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    got = packing.pack(docs, path=packing.default_path()).collect()
    ids, fill = {}, {}
    for r in sorted(got, key=lambda r: (r.doc_id, r.start)):
        own = np.frombuffer(r.ids, "<u4").tolist()
        assert len(own) == r.length and r.start == len(ids.setdefault(r.doc_id, []))
        ids[r.doc_id] += own
        fill.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert ids == {k: tokenizer.encode(t, add_special_tokens=False).ids + [1] for k, t in texts.items()}
    used = 0
    for spans in fill.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 2048
        used += at
    assert used / (2048 * len(fill)) > 0.9


def test_op4_and_pipeline_have_the_ids_of_the_tokenizer_as_it_is(spark, tmp_path):
    """Added tokens within texts, at their ends, side by side and next to white space."""
    from tokenizers import Tokenizer

    import corpus_pipeline

    tokenizer, end = Tokenizer.from_file(packing.default_path()), "<|endoftext|>"
    texts = [f"a{end}b", end, end + end, f"a  {end}  b {end}", f"{end}\n\n it's", f"<|endoftext|{end}|>", "plain  text", "<|ENDOFTEXT|>", "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    want = {i: tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for i, t in enumerate(texts)}
    assert want[0] == [64, 50256, 65, 1]
    want = {(i, zlib.crc32(np.asarray(ids, "<u4").tobytes()), len(ids)) for i, ids in want.items()}
    for got in (QUERIES["op4_packing"](spark, str(tmp_path)), corpus_pipeline.pack(spark, docs, str(tmp_path))):
        assert {(r.doc_id, r.ids_crc32, r.doc_tokens) for r in got.collect()} == want


def test_packing_balances_cost():
    lengths = np.random.default_rng(1).integers(1, 2048, 300)
    cut = packing.assign(lengths, 2048)
    cost, total = {}, 0
    for _, _, n, to, _ in cut:
        cost[to] = cost.get(to, 0) + n + n * n / 1024
        total += n
    assert total == lengths.sum() and len(cost) == -(-total // 2048) and len(cut) < 1.5 * len(lengths)


def test_url_rules_by_brute_force(spark, sf_dir):
    for r in QUERIES["op8_url_filters"](spark, sf_dir).join(table(spark, sf_dir, "pages"), "page_id").collect():
        rest = r.url.partition("://")[2] if r.url and "://" in r.url else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = host.lower()
        fits = []
        for kind, text in url_filters.RULES:
            name, slash, more = text.partition("/")
            if (host == name or host.endswith("." + name)) and path.startswith(slash + more):
                fits.append((len(text), text, kind))
        rule = max(fits, default=(0, None, None))
        assert (r.host, r.path, r.rule) == (host, path, rule[1]) and r.verdict == (rule[2] or r.verdict)


def templates_slowly(paths, labels):
    """Template and purity of each ``(host, path)``, page by page; ``labels`` holds 1 for block, 0 for allow, None, for each page."""
    u, extension = url_filters, re.compile(url_filters.EXTENSION)

    def wild(segment):
        return "*" + (extension.search(segment)[1] if extension.search(segment) else "")

    trails, parts = [("",) for _ in paths], []
    for _, path in paths:
        own = path.removeprefix("/").split("/") if path else []
        parts.append(own if len(own) <= u.DEPTH else [*own[: u.DEPTH - 1], "/".join(own[u.DEPTH - 1 :])])
    for depth in range(max(map(len, parts), default=0)):
        kinds = {}
        for (host, _), trail, own in zip(paths, trails, parts, strict=True):
            if len(own) > depth:
                seen = kinds.setdefault((host, trail[-1]), {})
                seen[own[depth]] = seen.get(own[depth], 0) + 1
        for i, own in enumerate(parts):
            if len(own) > depth:
                seen = kinds[paths[i][0], trails[i][-1]]
                varies = len(seen) >= u.VARIETY and seen[own[depth]] * u.VARIETY < sum(seen.values())
                trails[i] += (trails[i][-1] + "/" + (wild(own[depth]) if varies else own[depth]),)
    nodes = {}  # (host, node): above, pages, labels, blocked
    for (host, _), trail, label in zip(paths, trails, labels, strict=True):
        for k, node in enumerate(trail):
            n = nodes.setdefault((host, node), [trail[k - 1] if k else None, 0, 0, 0])
            n[1], n[2], n[3] = n[1] + 1, n[2] + (label is not None), n[3] + (label or 0)
    below = {}
    for (host, node), n in nodes.items():
        below.setdefault((host, n[0]), []).append(node)
    alike = set()
    for (host, above), some in below.items():
        if above is None:
            continue
        tables = {node: {c.split("/")[-1]: nodes[host, c][1] for c in below.get((host, node), ())} for node in some}
        columns = {c for t in tables.values() for c in t}
        size = {node: sum(t.values()) for node, t in tables.items()}
        for node, t in tables.items():
            chi = 0.0
            for c in columns if size[node] else ():
                expected = sum(x.get(c, 0) for x in tables.values()) * size[node] / sum(size.values())
                chi += (t.get(c, 0) - expected) ** 2 / expected
            if not size[node] or chi <= len(columns) - 1 + 3 * (2 * (len(columns) - 1)) ** 0.5:
                alike.add((host, node))

    def shape(node):
        return "/".join(wild(s) if re.search("[0-9]", s) else s for s in node.split("/"))

    own = {}
    for (host, node), n in nodes.items():
        if n[0] is not None:
            o = own.setdefault((shape(node), host), [0, 0])
            o[0], o[1] = o[0] + n[2], o[1] + n[3]
    votes = [(form, ".".join(host.split(".")[-2:]), b * u.VOTE // n / u.VOTE) for (form, host), (n, b) in own.items() if n]

    def towards(some, p):
        return (sum(some) + u.PRIOR_LABELS * p) / (len(some) + u.PRIOR_LABELS)

    def pool(host, form):
        wide = [v for f, _, v in votes if f == form]
        near = [v for f, domain, v in votes if f == form and domain == ".".join(host.split(".")[-2:])]
        return towards(near, towards(wide, u.PRIOR)) if wide else None

    out = []
    for (host, _), trail in zip(paths, trails, strict=True):
        p = u.PRIOR
        for node in trail:
            above, _, n, b = nodes[host, node]
            said = pool(host, shape(node)) if above is not None else None
            if (host, node) in alike:
                merged = [x for x in below[host, above] if (host, x) in alike]
                n, b = (sum(nodes[host, x][k] for x in merged) for k in (2, 3))
            if n:
                p = (b + u.PRIOR_LABELS * (p if said is None else said)) / (n + u.PRIOR_LABELS)
            else:
                p = u.PRIOR if said is None else said
        out.append((trail[-1], p))
    return out


def test_templates_and_purities_by_brute_force(spark, sf_dir):
    odd = ["http://odd.example.com", "http://odd.example.com/", "http://odd.example.com/a/b/c/d/e/f/g/h.html", "http://odd.example.com//x//", "none", None]
    pages = table(spark, sf_dir, "pages").select("url").union(spark.createDataFrame([(u,) for u in odd], "url string"))
    got = url_filters.url_filter(pages).collect()
    assert len(got) == pages.count()
    slow = templates_slowly([(r.host, r.path) for r in got], [{"block": 1, "allow": 0}[r.verdict] if r.rule else None for r in got])
    for r, (template, purity) in zip(got, slow, strict=True):
        assert r.template == template and r.purity == pytest.approx(purity), (r, template, purity)
        assert r.rule or r.verdict == ("block" if r.purity >= url_filters.REJECT else "allow")
    # templates decide where no rule does, in both directions
    assert {r.verdict for r in got if not r.rule} == {"allow", "block"}


def test_hosts_without_labels_are_judged_by_others_of_their_domain(spark):
    """Labels of one host in five are hidden: the tree finds them again from the other hosts."""
    pages = url_filters.url_filter(table(spark, "/root/testdata/sf0.1", "pages")).where("host <> '' and rule is not null").select("host", "path", "verdict")
    hidden = F.pmod(F.crc32(F.col("host").cast("binary")), F.lit(5)) == 0
    label = F.when(~hidden, F.when(F.col("verdict") == "block", 1).otherwise(0))
    counts = pages.groupBy("host", "path").agg(F.count(F.lit(1)).alias("pages"), F.count(label).alias("labels"), F.coalesce(F.sum(label), F.lit(0)).alias("blocked"))
    found = url_filters.judged_paths(counts, Scratch(spark, "hidden"))
    got = pages.where(hidden).join(found, ["host", "path"]).select("verdict", "purity").collect()
    block = [r for r in got if r.verdict == "block"]
    assert len(got) > 50 and len(block) > 20
    right = sum((r.purity >= url_filters.REJECT) == (r.verdict == "block") for r in got) / len(got)
    assert right >= 0.9 > 1 - len(block) / len(got)

def test_templates_of_blocked_branches_are_rejected(spark):
    rows = [(f"http://a.org/{kind}/{i}.html", kind) for kind in ("good", "bad") for i in range(40)]
    rows += [("http://a.org/bad/last", "bad"), ("http://b.org/x", None)]
    rules = [("block", f"a.org/bad/{i}.html") for i in range(30)] + [("allow", f"a.org/good/{i}.html") for i in range(30)]
    got = url_filters.url_filter(spark.createDataFrame(rows, "url string, kind string"), rules=rules).collect()
    assert {(r.kind, r.template, r.verdict) for r in got if r.kind} >= {("bad", "/bad/*.html", "block"), ("good", "/good/*.html", "allow")}
    assert [r.verdict for r in got if r.kind is None] == ["allow"]


def test_branches_unlike_the_blocked_ones_are_kept(spark):
    """Hosts of two sizes whose only labels are blocks; a branch like a blocked one goes with it."""
    rows = [(f"http://n{size}.example.net/{lang}/{i}{end}", lang) for size in (3, 40) for lang, end in (("es", ".html"), ("fr", ".html"), ("en", "/a"), ("pt", ".html")) for i in range(size)]
    got = url_filters.url_filter(spark.createDataFrame(rows, "url string, lang string")).collect()
    seen = {(r.host, r.lang, r.verdict) for r in got}
    assert {(h, lang, v) for h, lang, v in seen if lang != "pt"} == {(f"n{size}.example.net", lang, "allow" if lang == "en" else "block") for size in (3, 40) for lang in ("es", "fr", "en")}
    assert all(r.purity == url_filters.PRIOR for r in got if r.lang == "en")


def walk_slowly(text):
    """What the walk writes, step by step."""
    steps, at, heads = [], 0, fingerprints.STRIDES.reshape(fingerprints.CLASSES, -1)
    for c in text:
        kind = (ord(c) * 0x9E3779B1 % (1 << 32)) >> 26
        steps.append(at)
        at += int(heads[kind, at % fingerprints.PERIOD])
    return steps, at


def test_walks_and_fingerprints_by_brute_force():
    rng = random.Random(4)
    texts = ["".join(rng.choice("abc dé☺") for _ in range(rng.randrange(0, 1500))) for _ in range(60)]
    codes = [np.frombuffer(t.encode("utf-32-le"), np.uint32) for t in texts]
    for text, (steps, total) in zip(texts, fingerprints.walk(codes), strict=True):
        assert (steps.tolist(), total) == walk_slowly(text)
    prints = fingerprints.fingerprints(texts)
    assert prints == [fingerprints.fingerprints([t])[0] for t in texts]
    base = "".join(rng.choice("abcdefghij ") for _ in range(3000))
    edit = base[:1000] + "XY" + base[1003:2000] + base[2001:]
    near, other = fingerprints.fingerprints([base, edit, base[::-1]])[1:]
    own = fingerprints.fingerprints([base])[0]
    assert fingerprints.likeness(own, near) > 0.6 > 0.2 > fingerprints.likeness(own, other) and fingerprints.likeness(own, own) == 1


def test_op9_by_brute_force(spark, sf_dir):
    docs = sorted((r.doc_id, r.text or "") for r in table(spark, sf_dir, "documents").collect())
    got = {r.doc_id: r for r in QUERIES["op9_fingerprints"](spark, sf_dir).collect()}
    prints = fingerprints.fingerprints([t for _, t in docs])
    better = 0
    for i, (key, text) in enumerate(docs):
        following, half = docs[(i + 1) % len(docs)][1], len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        r = got[key]
        assert (r.n_chars, r.edited_sha256, r.fingerprint) == (len(text), hashlib.sha256(edited.encode()).hexdigest(), prints[i])
        assert r.near_next == fingerprints.likeness(prints[i], prints[(i + 1) % len(docs)])
        better += r.near_edited > r.near_next
    assert len(got) == len(docs) and better > 0.95 * len(docs)


def test_near_texts_finds_edited_copies(spark):
    rng = random.Random(6)
    texts = ["".join(rng.choice("abcdefghij ") for _ in range(2000)) for _ in range(20)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(100 + i, t[:700] + "Z" + t[700:]) for i, t in enumerate(texts[:10])]
    found = {(r.a, r.b) for r in fingerprints.near_texts(spark.createDataFrame(rows, "doc_id long, text string"), least=0.5).collect()}
    assert found <= {(i, 100 + i) for i in range(10)} and len(found) >= 8


def test_near_texts_links_copies_behind_outlying_hubs(spark):
    """Families whose smaller ids are alike in part only: every near pair is joined, as among all pairs."""
    rng = random.Random(8)
    text = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    rows = []
    for family in range(3):
        base = text(3000)
        for k in range(40):
            at = rng.randrange(2000)
            rows.append((1000 * family + k, base[:at] + text(1000) + base[at + 1000 :]))
        rows += [(1000 * family + 500 + k, text(60) + base[60:] if k % 2 else base[: 600 * k] + "Z" + base[600 * k :]) for k in range(4)]
    prints = dict(zip([i for i, _ in rows], fingerprints.fingerprints([t for _, t in rows]), strict=True))
    near = {(a, b) for a in prints for b in prints if a < b and fingerprints.likeness(prints[a], prints[b]) >= 0.8}
    assert {a // 1000 for a, b in near if a % 1000 >= 500} == {0, 1, 2}
    found = {(r.a, r.b) for r in fingerprints.near_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found <= near
    root = {i: i for i in prints}
    for _ in prints:
        for a, b in found:
            root[a] = root[b] = min(root[a], root[b])
    joined = sum(root[a] == root[b] for a, b in near)
    assert joined >= 0.99 * len(near), (joined, len(near))

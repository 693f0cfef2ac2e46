"""HTML extraction with wrappers: union-free regular expressions inferred per host.

A page is a stream of slots: the path of open block elements of each text block. Runs and squares of slots
become repeated groups. The streams of a host are aligned one after the other; what only one side has
becomes optional, texts that differ become text slots. Tasks infer wrappers of the hosts they see, partial
wrappers are aligned in turn, salted first, so a host of any size costs its tasks one wrapper each. A
wrapper says which slots hold the main text of its host's pages; each page is then read slot by slot. Pages
with and without an article have wrappers of their own, and a page takes the heaviest container that it has.
"""

from __future__ import annotations

import html
import json
import re
from difflib import SequenceMatcher

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quiltmap.llm.common import Scratch, apart, load

#: Elements that end the text block before them.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section select summary table "
    "tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their text is no text of the page.
SILENT = frozenset("head title form select option button datalist nav aside footer dialog menu".split())
#: Names in classes, ids and roles of parts that are not the article.
PARTS = frozenset(
    "ad ads advert adverts advertisement advertisements sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices "
    "alert alerts sidebar widget widgets menu menus nav navbar navigation breadcrumb breadcrumbs footer comment comments commentlist disqus "
    "respond reply replies share sharing social related recommended recommendations newsletter subscribe subscription signup popup modal overlay "
    "login search skip pagination pager toolbar complementary contentinfo form dialog".split()
)
#: The same, but only outside an article.
HEADS = frozenset("header masthead topbar".split())
#: Elements that close an open element of these kinds.
CLOSED_BY = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|template|noscript|svg|iframe|object|textarea|math)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>",
    re.S | re.I,
)
NAMES = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
HIDDEN = re.compile(r"display\s*:\s*none", re.I)


class Element:
    """An open block element: its label in slots, whether its text counts, whether it lies in an article."""

    __slots__ = ("tag", "slot", "silent", "article")

    def __init__(self, tag: str, attributes: str, above: Element | None):
        inside = above.article if above else False
        words, label, hidden = set(), tag, False
        if attributes:
            for m in NAMES.finditer(attributes):
                name, value = m[1].lower(), (m[2] or "").strip("\"'")
                if name in ("class", "id", "role"):
                    words.update(re.split(r"[^a-z]+", value.lower()))
                    label += {"class": ".", "id": "#", "role": "@"}[name] + re.sub(r"\d+", "0", value)
                elif name == "style":
                    hidden |= bool(HIDDEN.search(value))
                else:
                    hidden |= value.lower() != "false"
        root = tag in ("html", "body", "article", "main")
        silent = tag in SILENT or hidden or (not root and bool(words & PARTS)) or (tag == "article" and bool(words & {"comment", "comments", "reply"}))
        if not inside and (tag == "header" or (not root and words & HEADS)):
            silent = True
        self.tag = tag
        self.slot = (above.slot + ">" if above else "") + label
        self.silent = silent or (above.silent if above else False)
        self.article = inside or tag in ("article", "main")


def blocks(page: str) -> list[tuple[str, str, bool, bool, int]]:
    """``slot, text, silent, article, characters of links`` of each text block, in page order. Texts are decoded and trimmed."""
    stack = [Element("page", "", None)]
    out: list[tuple[str, str, bool, bool, int]] = []
    text: list[str] = []
    linked, in_link, at = 0, 0, 0

    def end():
        nonlocal linked
        if text:
            whole = " ".join(html.unescape("".join(text)).split())
            if whole:
                top = stack[-1]
                out.append((top.slot, whole, top.silent, top.article, linked))
            text.clear()
        linked = 0

    for m in TOKEN.finditer(page):
        if m.start() > at:
            text.append(page[at : m.start()])
            linked += (m.start() - at) * bool(in_link)
        at = m.end()
        tag = m[3]
        if tag is None:
            continue
        tag = tag.lower()
        if tag not in BLOCKS:
            if tag == "a":
                in_link = 0 if m[2] else 1
            elif tag == "br":
                text.append(" ")
            continue
        end()
        if m[2]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
        elif tag not in VOID:
            while len(stack) > 1 and (stack[-1].tag == "p" or stack[-1].tag in CLOSED_BY.get(tag, ()) or (tag == "body" and stack[-1].tag in ("head", "title"))):
                stack.pop()
            stack.append(Element(tag, m[4], stack[-1]))
    if at < len(page):
        text.append(page[at:])
    end()
    return out


# A wrapper is a list of nodes: [key, optional, repeated, pages, text digest or null, characters, link characters, silent, article, children].
# A group has children and the key of its first one.


def stream(found: list[tuple[str, str, bool, bool, int]]) -> list[list]:
    """One page as a wrapper: runs of a slot are one repeated slot, squares one repeated group."""
    nodes: list[list] = []
    for slot, text, silent, article, linked in found:
        if nodes and nodes[-1][0] == slot:
            last = nodes[-1]
            last[2], last[4], last[5], last[6] = True, None, last[5] + len(text), last[6] + linked
        else:
            nodes.append([slot, False, False, 1, xxhash.xxh3_64_hexdigest(text), len(text), linked, silent, article, []])
    return squares(nodes)


def squares(nodes: list[list], longest: int = 6) -> list[list]:
    """Folds neighbouring repeats of two to ``longest`` slots into one repeated group."""
    out: list[list] = []
    for node in nodes:
        out.append(node)
        for n in range(2, longest + 1):
            if len(out) > n and out[-n - 1][9] and [c[0] for c in out[-n - 1][9]] == [x[0] for x in out[-n:]]:
                again = out[-n:]
                del out[-n:]
                out[-1][9] = align(out[-1][9], again, same_page=True)
                break
            if len(out) >= 2 * n and not any(x[9] for x in out[-2 * n :]) and [x[0] for x in out[-2 * n : -n]] == [x[0] for x in out[-n:]]:
                children = align(out[-2 * n : -n], out[-n:], same_page=True)
                del out[-2 * n :]
                out.append([children[0][0], False, True, 1, None, 0, 0, False, False, children])
                break
    return out


def align(a: list[list], b: list[list], same_page: bool = False) -> list[list]:
    """Two wrappers as one: matched slots are joined, the others become optional."""
    keys_a, keys_b = [(x[0], bool(x[9])) for x in a], [(x[0], bool(x[9])) for x in b]
    if keys_a == keys_b:
        return [join(x, y, same_page) for x, y in zip(a, b, strict=True)]
    out, i, j = [], 0, 0
    for i2, j2, n in SequenceMatcher(None, keys_a, keys_b, autojunk=False).get_matching_blocks():
        out += [[x[0], True, *x[2:]] for x in a[i:i2]] + [[y[0], True, *y[2:]] for y in b[j:j2]]
        out += [join(x, y, same_page) for x, y in zip(a[i2 : i2 + n], b[j2 : j2 + n], strict=True)]
        i, j = i2 + n, j2 + n
    return out


def join(x: list, y: list, same_page: bool) -> list:
    pages = max(x[3], y[3]) if same_page else x[3] + y[3]
    return [x[0], x[1] or y[1], x[2] or y[2], pages, x[4] if x[4] == y[4] else None, x[5] + y[5], x[6] + y[6], x[7] and y[7], x[8] or y[8], align(x[9], y[9], same_page) if x[9] else []]


def leaves(wrapper: list[list]):
    for node in wrapper:
        if node[9]:
            yield from leaves(node[9])
        else:
            yield node


def containers(spoken: list[list]) -> dict[str, float]:
    """The containers with their text that varies and is no link, in characters."""
    weight: dict[str, float] = {}
    for key, _, repeated, pages, digest, chars, linked, *_ in spoken:
        if (pages < 2 or digest is None or repeated) and linked * 2 <= chars:
            above = key.rpartition(">")[0]
            weight[above] = weight.get(above, 0) + chars - linked
    return weight


def rule(pair: list) -> dict:
    """What the wrappers of a host's pages with and without an article say about main text.

    ``inside`` are the slots in articles. For the other pages: ``weight`` of containers, ``constant`` slots, of these
    ``fixed`` ones that all pages have, and ``plain`` slots that count where no text varies.
    """
    article, other = ([x for x in leaves(w or []) if not x[7]] for w in pair)
    weight = containers(other)
    constant = [x for x in other if x[3] > 1 and x[4] is not None and not x[2]]
    return {
        "inside": sorted({x[0] for x in article if x[8]}),
        "weight": weight,
        "constant": sorted({x[0] for x in constant}),
        "fixed": sorted({x[0] for x in constant if not x[1]}),
        "plain": [] if weight else sorted({x[0] for x in other if x[6] * 2 <= x[5]}),
    }


class Rule:
    """Reads pages by a host's rule."""

    def __init__(self, found: dict):
        self.weight = found["weight"]
        self.inside, self.constant, self.fixed, self.plain = (frozenset(found[k]) for k in ("inside", "constant", "fixed", "plain"))

    def under(self, slots: set[str]) -> set[str]:
        """Of a page's slots those under the heaviest container that it has text in."""
        varied, best = slots - self.constant, None
        for slot in varied:
            at = len(slot)
            while at > 0:
                if (above := slot[:at]) in self.weight:
                    best = max(best or (-1.0, ""), (self.weight[above], above))
                at = slot.rfind(">", 0, at)
        return {x for x in varied if (x + ">").startswith(best[1] + ">")} if best else set()

    def main(self, found: list[tuple]) -> str:
        """The main text: the page's articles, else the host's containers, else what the page alone says."""
        spoken = [x for x in found if not x[2]]
        if any(x[3] for x in spoken):
            keep = self.inside
        else:
            slots = {x[0] for x in spoken}
            keep = self.under(slots) or slots & self.plain
            if not keep and (rest := [x for x in spoken if x[0] not in self.fixed]):
                own = Rule(rule([None, stream(rest)]))
                rested = {x[0] for x in rest}
                keep = own.under(rested) or rested & own.plain
        return "\n".join(x[1] for x in spoken if x[0] in keep)


def expression(wrapper: list[list]) -> str:
    """The wrapper as a regular expression over slots: ``(...)+`` repeated, ``(...)?`` optional, ``#TEXT`` a text slot."""
    out = []
    for node in wrapper:
        body = expression(node[9]) if node[9] else node[0] + (" #TEXT" if node[4] is None or node[3] < 2 else " =" + node[4])
        out.append(("(" + body + ")" if node[1] or node[2] or node[9] else body) + ("+" if node[2] else "") + ("?" if node[1] else ""))
    return " ".join(out)


def either(a: list[list] | None, b: list[list] | None) -> list[list] | None:
    return align(a, b) if a and b else a or b


def infer(batches):
    """``host, wrapper`` of the pages of a task, a wrapper of those with an article and one of the others; they are handed on when there are many."""
    seen: dict[str, list] = {}
    for batch in batches:
        for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            pair = seen.setdefault(host, [None, None])
            if found := blocks(page or ""):
                side = 0 if any(article and not silent for _, _, silent, article, _ in found) else 1
                pair[side] = either(pair[side], stream(found))
        if len(seen) > 2000:
            yield _rows(seen)
            seen = {}
    if seen:
        yield _rows(seen)


def _rows(seen: dict[str, list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array([json.dumps(w) for w in seen.values()], pa.string())], ["host", "wrapper"])


def meet(table: pa.Table) -> pa.Table:
    """The partial wrappers of a host as one pair."""
    parts = sorted(table.column("wrapper").to_pylist())
    whole = json.loads(parts[0])
    for part in parts[1:]:
        whole = [either(a, b) for a, b in zip(whole, json.loads(part), strict=True)]
    return pa.table({"host": table.column("host").slice(0, 1), "wrapper": [json.dumps(whole)]})


def wrappers(pages: DataFrame) -> DataFrame:
    """``host, wrapper`` from ``host, html``: the wrappers of pages with and without an article."""
    parts = pages.select("host", "html").mapInArrow(infer, "host string, wrapper string")
    salted = parts.groupBy("host", (F.abs(F.xxhash64("wrapper")) % 32).alias("salt")).applyInArrow(meet, "host string, wrapper string")
    return salted.groupBy("host").applyInArrow(meet, "host string, wrapper string")


def extract(pages: DataFrame, *, url_col: str = "url", html_col: str = "html", into: str = "text") -> DataFrame:
    """The rows of ``pages`` with every column and their main text in ``into``, which replaces one of that name.

    Blocks of white space turned into one space and trimmed are joined in page order by one newline. Null,
    empty and blank pages, and pages without main text, give an empty text. Pages without a host share one
    pair of wrappers. A page that fits no container of its host is read by itself. Repeated rows and very long pages are read like any other. An empty table gives an empty one.
    """
    scratch = Scratch(pages.sparkSession, "html")
    own = [c for c in pages.columns if c != into]
    host = F.coalesce(F.lower(F.regexp_extract(url_col, r"://([^/?#]*)", 1)), F.lit(""))
    found = wrappers(pages.select(host.alias("host"), F.col(html_col).alias("html")))

    def decide(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([json.dumps(rule(json.loads(w))) for w in batch.column(1).to_pylist()], pa.string())], ["__host", "__rule"])

    rules = scratch.write(found.mapInArrow(decide, "__host string, __rule string"), "rules")
    joined = pages.select(*own, host.alias("__host")).join(apart(rules), "__host", "left").select(*own, "__rule")
    at = own.index(html_col)

    def read(batches):
        for batch in batches:
            out, known, host_rule = [], None, None
            for page, text in zip(batch.column(at).to_pylist(), batch.column(len(own)).to_pylist(), strict=True):
                if text != known:
                    known, host_rule = text, Rule(json.loads(text))
                out.append(host_rule.main(blocks(page or "")))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(out, pa.string())], [*own, into])

    return joined.mapInArrow(read, pages.select(*own).schema.add(into, "string"))


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = load(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))

"""URL filters: rules first, then a tree of path templates with a smoothed purity.

Per host the paths are generalised segment by segment from the root: where a node has many kinds of
segments, those that hold few of its pages become a wildcard (a file extension stays). Branches of a node
whose children are distributed alike, by a chi-square test against all branches together, are merged. The
pages that a rule decides are the labels: along its path each template's share of blocked labels is smoothed
towards what other hosts say of the same shape, else towards the branch above, and templates of high purity are
rejected. A branch that neither has labels nor is merged with one that has takes what other hosts say, and the
prior where they say nothing. Hosts of one domain are heard first, and each has one vote, so that a host with
many pages does not decide for all. Everything is DataFrame expressions; counts are aggregated before they are
joined, and no key is gathered in one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quiltmap.llm.common import Scratch, apart, load

#: Verdict, host and beginning of the path.
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))
#: A segment varies if its node has VARIETY kinds or more and it holds less than 1/VARIETY of the node's pages.
VARIETY = 8
#: Segments of the tree; a longer path ends in one segment with the rest.
DEPTH = 6
#: Labels (or votes) that the share above counts for, the share without labels, the share that is rejected.
PRIOR_LABELS, PRIOR, REJECT = 4.0, 0.5, 0.75
#: A host's share of blocked labels becomes an integer vote up to this, so that sums do not depend on their order.
VOTE = 1_000_000
EXTENSION = r"(\.[A-Za-z0-9]{1,5})$"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path: after the first ``://`` up to ``/ ? #``, A-Z lower-cased; then up to ``? #``. Empty without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null where none does. A rule fits its host and all subdomains."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: (len(r[1]), r[1], r[0])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def templates(paths: DataFrame, scratch: Scratch) -> DataFrame:
    """``host, path, nodes`` and counts: the nodes of each path's template from the host's root down."""
    parts = F.split(F.regexp_replace("path", "^/", ""), "/")
    short = F.when(F.size(parts) <= DEPTH, parts).otherwise(F.concat(F.slice(parts, 1, DEPTH - 1), F.array(F.array_join(F.slice(parts, DEPTH, F.size(parts)), "/"))))
    now = paths.withColumn("parts", F.when(F.col("path") == "", F.array().cast("array<string>")).otherwise(short)).withColumn("node", F.lit("")).withColumn("nodes", F.array(F.lit("")))
    now = scratch.write(now, "paths-0")
    deepest = now.agg(F.max(F.size("parts"))).first()[0] or 0
    for depth in range(deepest):
        here = now.withColumn("segment", F.get("parts", F.lit(depth)))
        kinds = here.where("segment is not null").groupBy("host", "node", "segment").agg(F.sum("pages").alias("own"))
        totals = kinds.groupBy("host", "node").agg(F.count(F.lit(1)).alias("kinds"), F.sum("own").alias("all"))
        varies = (F.col("kinds") >= VARIETY) & (F.col("own") * VARIETY < F.col("all"))
        wild = F.concat(F.lit("*"), F.regexp_extract("segment", EXTENSION, 1))
        names = kinds.join(apart(totals), ["host", "node"]).select("host", "node", "segment", F.concat("node", F.lit("/"), F.when(varies, wild).otherwise(F.col("segment"))).alias("next"))
        moved = here.join(apart(names), ["host", "node", "segment"], "left").withColumn("nodes", F.when(F.col("next").isNull(), F.col("nodes")).otherwise(F.concat("nodes", F.array("next"))))
        now = scratch.write(moved.withColumn("node", F.coalesce("next", "node")).drop("segment", "next"), f"paths-{depth + 1}")
        scratch.drop(f"paths-{depth}")
    return now


def shape_of(node: Column) -> Column:
    """A template as hosts share it: segments with a digit are wildcards (a file extension stays)."""
    return F.array_join(F.transform(F.split(node, "/"), lambda s: F.when(s.rlike("[0-9]"), F.concat(F.lit("*"), F.regexp_extract(s, EXTENSION, 1))).otherwise(s)), "/")


def domain_of(host: Column) -> Column:
    """The last two labels of a host."""
    return F.substring_index(host, ".", -2)


def smoothed(blocked: Column, labels: Column, towards: Column) -> Column:
    return (blocked + PRIOR_LABELS * towards) / (labels + PRIOR_LABELS)


def pooled_shares(nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """``domain, shape, pool`` for each domain and shape of ``nodes``: what labelled hosts say, null where none does."""
    own = nodes.groupBy("domain", "host", "shape").agg(F.sum("labels").alias("labels"), F.sum("blocked").alias("blocked"))
    vote = F.when(F.col("labels") > 0, F.floor(F.col("blocked") * VOTE / F.col("labels")))
    near = scratch.write(own.groupBy("domain", "shape").agg(F.count(vote).alias("hosts"), F.coalesce(F.sum(vote), F.lit(0)).alias("votes")), "pools")
    everywhere = near.groupBy("shape").agg(F.sum("hosts").alias("all_hosts"), F.sum("votes").alias("all_votes"))
    wide = smoothed(F.col("all_votes") / VOTE, F.col("all_hosts"), F.lit(PRIOR))
    pool = F.when(F.col("all_hosts") > 0, smoothed(F.col("votes") / VOTE, F.col("hosts"), wide))
    return near.join(apart(everywhere), "shape").select("domain", "shape", pool.alias("pool"))


def purities(paths: DataFrame, scratch: Scratch) -> DataFrame:
    """``host, node, purity`` for each template."""
    leaf = paths.groupBy("host", "node", "nodes").agg(*(F.sum(c).alias(c) for c in ("pages", "labels", "blocked")))
    leaf = scratch.write(leaf, "templates")
    steps = leaf.select("host", "pages", "labels", "blocked", F.posexplode("nodes").alias("depth", "node"), "nodes")
    above = F.when(F.col("depth") > 0, F.get("nodes", F.col("depth") - 1))
    nodes = steps.withColumn("above", above).groupBy("host", "node", "above").agg(*(F.sum(c).alias(c) for c in ("pages", "labels", "blocked")))
    nodes = scratch.write(nodes.withColumns({"domain": domain_of(F.col("host")), "shape": shape_of(F.col("node"))}), "nodes")
    # are the children of a branch distributed like those of all branches of its node?
    children = nodes.select("host", F.col("above").alias("node"), F.element_at(F.split("node", "/"), -1).alias("child"), F.col("pages").alias("n"))
    grand = nodes.where("above is not null").select("host", "above", "node").join(children, ["host", "node"])
    pooled = grand.groupBy("host", "above", "child").agg(F.sum("n").alias("of_child"))
    size = grand.groupBy("host", "above", "node").agg(F.sum("n").alias("of_node"))
    whole = grand.groupBy("host", "above").agg(F.sum("n").alias("of_all"))
    cells = pooled.join(apart(whole), ["host", "above"]).join(apart(size), ["host", "above"])
    expected = F.col("of_child") * F.col("of_node") / F.col("of_all")
    cells = cells.join(grand.select("host", "above", "node", "child", "n"), ["host", "above", "node", "child"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    tests = cells.groupBy("host", "above", "node").agg(F.sum((F.col("n") - expected) ** 2 / expected).alias("chi"), (F.count(F.lit(1)) - 1).alias("free"))
    tests = tests.select("host", "node", (F.col("chi") <= F.col("free") + 3 * F.sqrt(2.0 * F.col("free"))).alias("alike"))
    tested = nodes.join(apart(tests), ["host", "node"], "left").withColumn("alike", F.coalesce("alike", F.lit(True)) & F.col("above").isNotNull())
    tested = scratch.write(tested, "tested")
    merged = tested.where("alike").groupBy("host", "above").agg(F.sum("labels").alias("all_labels"), F.sum("blocked").alias("all_blocked"))
    # the root of a host has no shape that others could share
    pools = pooled_shares(nodes.where("above is not null"), scratch)
    judged = tested.join(apart(merged), ["host", "above"], "left").join(apart(pools), ["domain", "shape"], "left").select(
        "host",
        "node",
        F.when(F.col("above").isNotNull(), F.col("pool")).alias("pool"),
        F.when(F.col("alike"), F.col("all_labels")).otherwise(F.col("labels")).alias("l"),
        F.when(F.col("alike"), F.col("all_blocked")).otherwise(F.col("blocked")).alias("b"),
    )
    chain = leaf.select("host", F.col("node").alias("leaf"), F.posexplode("nodes").alias("depth", "node")).join(judged, ["host", "node"]).groupBy("host", "leaf").agg(F.array_sort(F.collect_list(F.struct("depth", "l", "b", "pool"))).alias("chain"))
    # a host's labels say nothing of a branch that is unlike all its labelled ones; other hosts' may
    purity = F.aggregate("chain", F.lit(PRIOR), lambda p, x: F.when(x["l"] == 0, F.coalesce(x["pool"], F.lit(PRIOR))).otherwise(smoothed(x["b"], x["l"], F.coalesce(x["pool"], p))))
    return chain.select("host", F.col("leaf").alias("node"), purity.alias("purity"))


def judged_paths(counts: DataFrame, scratch: Scratch) -> DataFrame:
    """``host, path, template, purity`` of ``host, path, pages, labels, blocked``, one row per host and path."""
    paths = templates(counts, scratch)
    found = paths.select("host", "path", "node").join(apart(purities(paths, scratch)), ["host", "node"])
    return scratch.write(found.select("host", "path", F.col("node").alias("template"), "purity"), "found")


def url_filter(pages: DataFrame, *, url_col: str = "url", rules=RULES) -> DataFrame:
    """The rows of ``pages`` with every column and ``host, path, rule, verdict, template, purity``, which replace those of that name.

    A page has the verdict of the longest rule that fits it, else ``block`` where the purity of its template
    is ``REJECT`` or more, else ``allow``. Null and odd URLs (no ``://``) have an empty host and path, no rule
    and the prior's purity. Repeated rows count as pages of their own. An empty table gives an empty one.
    """
    scratch = Scratch(pages.sparkSession, "url-filter")
    own = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict", "template", "purity")]
    host, path = split_url(F.col(url_col))
    keyed = pages.select(*own, host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    keyed = keyed.withColumns({"rule": rule, "verdict": verdict})
    counts = keyed.groupBy("host", "path").agg(F.count(F.lit(1)).alias("pages"), F.count("verdict").alias("labels"), F.count(F.when(F.col("verdict") == "block", 1)).alias("blocked"))
    found = judged_paths(counts, scratch)
    judged = F.coalesce("verdict", F.when(F.col("purity") >= REJECT, "block").otherwise("allow"))
    return keyed.join(found, ["host", "path"], "left").select(*own, "host", "path", "rule", judged.alias("verdict"), "template", "purity")


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(load(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict")

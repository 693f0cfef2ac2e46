"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Documents of a source are dealt by hash over blocks of about equal words. A source's target takes whole
passes over its blocks and one part of a pass, in permuted order, so each source has an exact quota of
blocks. The tree splits the vector of quotas: a node with some output shards hands its left half a fixed
number of blocks, drawn without replacement from all sources (one hypergeometric draw after the other),
and the rest to its right half, down to single shards. A shard then draws its quota of each source's
permuted blocks, disjoint from all other shards, and orders its documents by hash. Only the block where a
part ends is taken document by document. Everything is DataFrame expressions with hashed randomness.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quiltmap.llm.common import Scratch, load

WEIGHTS, SHARE, MOST = (3.0, 1.0, 2.0), 1.5, 2
#: Words of a block at least, blocks in all about (the tree's size; beyond it blocks get larger), blocks of a shard.
BLOCK_WORDS, BLOCKS, SHARD_BLOCKS = 1 << 16, 1 << 14, 64
WORD = r"[^\x20\x09-\x0D]+"


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """``id, source, size``: the words of each text."""
    return docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), F.coalesce(F.regexp_count(text_col, F.lit(WORD)), F.lit(0)).cast("long").alias("size"))


def targets(rows: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``source, rank, source_size, target``: weights by code point order of the sources, null last, levelled at ``most`` sizes.

    Sources by the ratio of limit to weight: those below the common level stop at their limit, the others get
    the level times their weight. The windows run over one row per source.
    """
    by_source = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = by_source.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    order = Window.orderBy("ratio", "rank")
    level = (share * F.sum("source_size").over(Window.partitionBy()) - (F.sum("limit").over(order) - F.col("limit"))) / F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    return (
        ranked.withColumn("weight", weight)
        .withColumn("limit", (most * F.col("source_size")).cast("double"))
        .withColumn("ratio", F.col("limit") / F.col("weight"))
        .withColumn("level", level)
        .withColumn("level", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "rank", "level"))).over(Window.partitionBy()).getField("level"))
        .select("source", "rank", "source_size", F.least("limit", F.col("weight") * F.col("level")).alias("target"))
    )


def uniform(*parts: Column) -> Column:
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 53)) / float(1 << 53)


def hypergeometric(marked: Column, total: Column, draws: Column, *seed: Column) -> Column:
    """How many of ``marked`` among ``total`` fall into ``draws``: the draws one by one, of the smaller side."""
    few, many = F.least(marked, draws), F.greatest(marked, draws)
    steps = F.when(few > 0, F.sequence(F.lit(0), few - 1)).otherwise(F.array().cast("array<int>"))
    hit = lambda got, i: got + F.when(uniform(*seed, i) * (total - i) < many - got, 1).otherwise(0)
    return F.aggregate(steps, F.lit(0), hit)


def split_quotas(node: Column, quotas: Column, draws: Column, seed: int) -> Column:
    """The left half's quotas: ``draws`` blocks of all sources."""
    total = F.aggregate(quotas, F.lit(0), lambda a, q: a + q)
    start = F.struct(total.alias("total"), draws.alias("draws"), F.array().cast("array<int>").alias("left"))

    def take(state, quota):
        x = hypergeometric(quota, state["total"], state["draws"], F.lit(seed), node, F.size(state["left"]))
        return F.struct((state["total"] - quota).alias("total"), (state["draws"] - x).alias("draws"), F.concat(state["left"], F.array(x)).alias("left"))

    return F.aggregate(quotas, start, take, lambda s: s["left"])


def shard_quotas(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """``shard, quotas`` from one row with the array ``quotas``, by recursive halving of the shards."""
    level = quotas.select(F.lit(0).alias("shard"), F.lit(shards).alias("shards"), "quotas")
    for _ in range(max(0, shards - 1).bit_length()):
        half = F.ceil(F.col("shards") / 2).cast("int")
        total = F.aggregate("quotas", F.lit(0), lambda a, q: a + q)
        draws = F.when(F.col("shards") > 1, F.floor(total * half / F.col("shards")).cast("int")).otherwise(total)
        level = level.withColumn("half", half).withColumn("left", split_quotas(F.col("shard") * 1024 + F.col("shards"), F.col("quotas"), draws, seed))
        right = F.zip_with("quotas", "left", lambda q, x: q - x)
        halves = F.array(
            F.struct("shard", F.col("half").alias("shards"), F.col("left").alias("quotas")),
            F.struct((F.col("shard") + F.col("half")).alias("shard"), (F.col("shards") - F.col("half")).alias("shards"), right.alias("quotas")),
        )
        level = level.select(F.explode(halves).alias("h")).select("h.*").where("shards > 0")
    return level.select("shard", "quotas")


def placed(rows: DataFrame, sources: DataFrame, seed: int) -> DataFrame:
    """Each row with its source's figures and its block."""
    own = rows.join(sources.withColumnRenamed("source", "__source"), F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    return own.withColumn("order", F.xxhash64(F.lit(seed), "id")).withColumn("block", F.pmod("order", F.col("n_blocks")).cast("int"))


def shares(sizes: DataFrame, scratch: Scratch, seed: int, **rule) -> tuple[DataFrame, DataFrame]:
    """The sources with their figures; for each block its ``draws`` (pass and shard of each copy) and where a part ends in it."""
    sources = targets(sizes, **rule)
    sources = scratch.write(sources, "targets")
    total = sources.agg(F.sum("target")).first()[0] or 0.0
    words = max(BLOCK_WORDS, total / BLOCKS)
    sources = sources.withColumn("n_blocks", F.greatest(F.lit(1), F.round(F.col("source_size") / words)).cast("int"))
    sources = sources.withColumn("passes", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int"))
    # the part of a pass: blocks in permuted order, until the words left are used up
    permuted = Window.partitionBy("rank").orderBy(F.xxhash64(F.lit(seed + 1), "rank", "block"), "block")
    blocks = placed(sizes, sources, seed).groupBy("rank", "block", "passes", "source_size", "target").agg(F.sum("size").alias("words"))
    edge = F.col("target") - F.col("passes") * F.col("source_size") - (F.sum("words").over(permuted) - F.col("words"))
    blocks = blocks.withColumn("edge", edge).withColumn("copies", F.col("passes") + F.when(F.col("edge") > 0, 1).otherwise(0))
    blocks = scratch.write(blocks.select("rank", "block", "words", "edge", "copies"), "blocks")
    # one draw for each block and pass, numbered in permuted order
    draws = blocks.where("copies > 0").select("rank", "block", F.explode(F.sequence(F.lit(1), "copies")).alias("pass"))
    draws = draws.withColumn("place", F.row_number().over(Window.partitionBy("rank").orderBy(F.xxhash64(F.lit(seed + 2), "rank", "block", "pass"), "block", "pass")))
    counts = scratch.write(draws.groupBy("rank").agg(F.count(F.lit(1)).cast("int").alias("n")), "counts")
    shards = max(1, round((counts.agg(F.sum("n")).first()[0] or 0) / SHARD_BLOCKS))
    quotas = counts.agg(F.array_sort(F.collect_list(F.struct("rank", "n"))).alias("q")).select(F.col("q.n").alias("quotas"))
    leaves = shard_quotas(quotas, shards, seed).select("shard", F.posexplode("quotas").alias("at", "n"))
    ranks = counts.select("rank", (F.row_number().over(Window.orderBy("rank")) - 1).alias("at"))
    upto = F.sum("n").over(Window.partitionBy("at").orderBy("shard"))
    spans = leaves.withColumn("upto", upto).where("n > 0").join(ranks, "at").select("rank", "shard", F.explode(F.sequence(F.col("upto") - F.col("n") + 1, "upto")).alias("place"))
    taken = draws.join(spans, ["rank", "place"]).groupBy("rank", "block").agg(F.sort_array(F.collect_list(F.struct("pass", "shard"))).alias("draws"))
    ends = F.when((F.col("edge") > 0) & (F.col("edge") < F.col("words")), F.col("edge")).alias("edge")
    return sources, scratch.write(blocks.join(taken, ["rank", "block"], "left").select("rank", "block", "draws", ends), "shares")


def drawn(rows: DataFrame, sources: DataFrame, by_block: DataFrame, seed: int) -> DataFrame:
    """The rows (``id, source, size`` and others) with ``source_size, target, order`` and the ``draws`` of each."""
    full = placed(rows, sources, seed).join(by_block, ["rank", "block"])
    # where the part ends inside a block, its last pass holds the documents up to there, and then the largest that fill the gap
    block = Window.partitionBy("rank", "block")
    inside = full.where("edge is not null").withColumn("sofar", F.sum("size").over(block.orderBy("order", "id", "size").rowsBetween(Window.unboundedPreceding, 0)))
    inside = inside.withColumn("gap", F.col("edge") - F.coalesce(F.max(F.when(F.col("sofar") <= F.col("edge"), F.col("sofar"))).over(block), F.lit(0)))
    fits = (F.col("sofar") > F.col("edge")) & (F.col("size") <= F.col("gap"))
    filled = F.sum(F.when(fits, F.col("size")).otherwise(0)).over(block.orderBy(fits.desc(), F.col("size").desc(), "order", "id").rowsBetween(Window.unboundedPreceding, 0))
    inside = inside.withColumn("taken", (F.col("sofar") <= F.col("edge")) | (fits & (filled <= F.col("gap"))))
    some = F.when(F.col("taken"), F.col("draws")).otherwise(F.slice("draws", 1, F.size("draws") - 1))
    names = [*rows.columns, "source_size", "target", "order", "draws"]
    both = full.where("edge is null").select(*names).union(inside.withColumn("draws", some).select(*names))
    return both.withColumn("draws", F.coalesce("draws", F.array().cast("array<struct<pass:int,shard:int>>")))


def mix_counts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 1, **rule) -> DataFrame:
    """``id, source, size, source_size, target, order, draws`` for every row: what the mix takes, without the texts."""
    scratch = Scratch(docs.sparkSession, "mix")
    sizes = scratch.write(sized(docs, id_col, text_col, source_col), "sizes")
    return drawn(sizes, *shares(sizes, scratch, seed, **rule), seed)


def mix(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 1, **rule) -> DataFrame:
    """The mix: the rows of ``docs`` with every column and their ``shard``, once for each copy, in the shards' order.

    The size of a row is its number of words, 0 for null and empty texts; weights go to the sources by code
    point order, a null source is a source of its own and the last. The sources share ``share`` times all
    words; a target stops at ``most`` sizes of its source, and the excess goes to the others by weight. Taken
    words stay below the target by less than the words of a small document. Rows of size 0 come along with their block.
    Repeated rows and equal ids are rows of their own, drawn alike up to the end of a part; reruns agree. An
    empty table gives an empty one. A column named ``shard`` is replaced.
    """
    scratch = Scratch(docs.sparkSession, "mix")
    sizes = scratch.write(sized(docs, id_col, text_col, source_col), "sizes")
    row = F.struct(*(F.col(c) for c in docs.columns if c != "shard")).alias("row")
    words = F.coalesce(F.regexp_count(text_col, F.lit(WORD)), F.lit(0)).cast("long").alias("size")
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), words, row)
    out = drawn(rows, *shares(sizes, scratch, seed, **rule), seed).select("row", "order", F.explode("draws").alias("draw"))
    shard = out.select("row", F.col("draw.shard").alias("shard"), F.xxhash64(F.lit(seed + 3), "order", "draw.pass").alias("place"))
    return shard.repartition("shard").sortWithinPartitions("shard", "place").select("row.*", "shard")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mix_counts(load(spark, sf_dir, "documents"))
    return rows.select(F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.size("draws")).alias("taken"))

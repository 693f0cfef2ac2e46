"""MinHash near-dedup with tensored banding.

Two small collections of ``COLLECTION`` half keys, of ``HALF`` minhashes each, are computed per document;
a table key joins one half key of either, so 64 tables of four minhashes cost 32 minhashes instead of 256.
At a likeness of 0.8 a pair shares a key with probability (1 - (1 - 0.8^2)^8)^2 = 0.9994.

Documents with equal shingle sets are first folded into one. A set that shares no half key of the first
collection with another is in no bucket, so only the others get their 64 keys. Shingles that no other
candidate has bound what a pair can share: sets and pairs that cannot reach the likeness are left out, and
the member with the fewest is the most typical of its bucket. Each member is compared, on the full sets,
with that one, the bucket's hub, and linked members are merged. What is left are members of one bucket in
different components, at least one of a pair not linked with the hub. A large family has many hubs, so a bucket
goes by another hub if its own is at least half as alike to that as a link needs, and more sets are: a set is then
described about once for a family, not once for each of its hubs. Both of a pair are described by what they lack of
the hub and what they have beside it. Sets that are alike enough share many of these differences, so they
share one among few of either (a prefix in a fixed order, its length from the sizes alone), and a join finds
all pairs that do. What all of them have in common takes no part in it, so near copies that differ in their
own ways do not meet. No pair that could be linked goes untested, and nothing is capped.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quiltmap.llm.common import Scratch, apart, cached, fold_case, holds, id_filter, in_small_batches, load, mix, texts, tidily
from quiltmap.llm.components import components

COLLECTION, HALF = 8, 2
WORDS, PERCENT = 5, 80

_random = np.random.default_rng(20)
_MUL = _random.integers(1, 1 << 63, (COLLECTION * HALF * 2, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _random.integers(0, 1 << 63, (COLLECTION * HALF * 2, 1), dtype=np.uint64)
_PLACE = _random.integers(1, 1 << 63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class WordHashes(dict):
    """Remembers the hashes of short words, up to a bound."""

    LARGEST = 1 << 16

    def __missing__(self, word: bytes) -> bytes:
        digest = xxhash.xxh3_64_digest(word)
        if len(word) <= 32:
            if len(self) >= self.LARGEST:
                self.clear()
            self[word] = digest
        return digest


def shingles(text: bytes | None, words: int) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's shingles: A-Z lower-cased, words split at ASCII white space.

    Fewer words than a shingle has make one shingle; no words make none.
    """
    found = fold_case(text).split()
    if not found:
        return np.empty(0, np.uint64)
    known = cached("word hashes", WordHashes)
    h = np.frombuffer(b"".join(map(known.__getitem__, found)), np.uint64)
    width = min(words, len(h))
    place = np.resize(_PLACE, width)
    out = np.full(len(h) - width + 1, width, np.uint64)
    for k in range(width):
        x = h[k : k + len(out)] * place[k]
        out = (out ^ (x ^ (x >> np.uint64(31)))) * np.uint64(0x9E3779B97F4A7C15)
    return np.unique(out ^ (out >> np.uint64(32)))


def half_keys(hashes: np.ndarray) -> np.ndarray:
    """The half keys of both collections, 2 x COLLECTION."""
    least = np.full(len(_MUL), np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(hashes), 4096):
        np.minimum(least, (hashes[None, start : start + 4096] * _MUL + _ADD).min(axis=1), out=least)
    return mix(least[0::2] * np.uint64(3) + mix(least[1::2])).view(np.int64)


def sketch(words: int):
    """Per row: id, size of the set, its digest and the half keys."""

    @tidily("minhash")
    def call(batches):
        for batch in batches:
            size, digest, halves = [], [], []
            for text in texts(batch.column(1)):
                h = shingles(text, words)
                size.append(len(h))
                digest.append(xxhash.xxh3_128_digest(h.tobytes()) if len(h) else None)
                halves.append(half_keys(h) if len(h) else [])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size, pa.int64()), pa.array(digest, pa.binary()), pa.array(halves, pa.list_(pa.int64()))], ["id", "size", "digest", "halves"])

    return call


def sets_of(words: int, bloom):
    """The full sets of the rows whose id may be asked for."""

    @tidily("minhash")
    def call(batches):
        for batch in batches:
            ids = batch.column(0)
            wanted = np.flatnonzero(holds(bloom.value, mix(ids.fill_null(0).to_numpy(zero_copy_only=False))) & ids.is_valid().to_numpy(zero_copy_only=False))
            for start in range(0, len(wanted), 256):
                part = batch.take(pa.array(wanted[start : start + 256]))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([shingles(t, words).view(np.int64) for t in texts(part.column(1))], pa.list_(pa.int64()))], ["id", "hashes"])

    return call


def compared(pairs: DataFrame, sets: DataFrame, percent: int, least: int) -> DataFrame:
    """``a, b, linked``: the pairs ``hub, member`` whose full sets are alike by ``least`` percent, and whether by ``percent``."""
    both, sizes = F.size(F.array_intersect("hub_set", "own_set")), F.size("hub_set") + F.size("own_set")
    return (
        pairs.join(sets.select(F.col("id").alias("member"), F.col("hashes").alias("own_set")), "member")
        .join(sets.select(F.col("id").alias("hub"), F.col("hashes").alias("hub_set")), "hub")
        .where((100 + least) * both >= least * sizes)
        .select(F.col("hub").alias("a"), F.col("member").alias("b"), ((100 + percent) * both >= percent * sizes).alias("linked"))
    )


def linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``a, b``: the pairs ``hub, member`` whose full sets are alike enough."""
    return compared(pairs, sets, percent, percent).select("a", "b")


def bucket_keys(reps: DataFrame) -> DataFrame:
    """``id, i, j, key`` of every set that shares a half key of the first collection, for each such half key."""
    halves = reps.select("id", F.posexplode(F.slice("halves", 1, COLLECTION)).alias("i", "half"))
    shared = halves.groupBy("i", "half").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    firsts = halves.join(apart(shared), ["i", "half"]).groupBy("id").agg(F.collect_list(F.struct("i", "half")).alias("firsts"))
    return (
        firsts.join(reps.select("id", F.slice("halves", COLLECTION + 1, COLLECTION).alias("seconds")), "id")
        .select("id", "seconds", F.explode("firsts").alias("first"))
        .select("id", "first", F.posexplode("seconds").alias("j", "second"))
        .select("id", "first.i", "j", F.xxhash64("first.i", "first.half", "j", "second").alias("key"))
    )


def lone_shingles(sets: DataFrame) -> DataFrame:
    """``id, lone``: the shingles of a set that no other of the sets has, for sets that have any."""
    one = sets.select("id", F.explode("hashes").alias("hash")).groupBy("hash").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("id")).where("n = 1")
    return one.groupBy("id").agg(F.collect_list("hash").alias("lone"))


def leading_hubs(hubs: DataFrame, stars: DataFrame) -> DataFrame:
    """``hub, lead``: of a hub and the hubs that it is alike to, the one that most sets are alike to, for hubs that have any.

    ``stars`` has the pairs ``a, b`` of hubs and members of their buckets that are alike.
    """
    counted = stars.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
    around = stars.select("a", "b").join(apart(counted), "a").union(counted.select("a", F.col("a").alias("b"), "n"))
    best = around.join(hubs.select(F.col("hub").alias("b")).distinct(), "b").groupBy("b").agg(F.min(F.struct((-F.col("n")).alias("n"), "a")).alias("best"))
    return best.select(F.col("b").alias("hub"), F.col("best.a").alias("lead"))


def differences(scratch: Scratch, grouped: DataFrame, sets: DataFrame, lone: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """``hub, id, root, far, hash, most, need``: whether a set is not linked with the hub, and the differences from it that a link must share one of.

    Beside it ``a, b``: links of hubs with sets ``hub, id, root, hub_root`` of another root, which the description shows by itself.

    Of a set x, let r and a be the numbers of shingles it lacks of the hub h and has beside it. Two sets share
    |h| - r1 - r2 + s shingles, where s counts the differences they have in common. That a link needs percent /
    (100 + percent) of both sizes bounds s from below: for a set that is far from the hub by its own missing share,
    for a near one by what its far partner must lack. Any ``r + a - s + 1`` differences of either, the first in an
    order that all sets have in common, then hold a common one. Shingles of a set that no other has come first:
    nothing meets there, so they are counted and not made rows, and a set that has no place left has no links here.
    The rarest among those of the hub follow. Hubs whose sets are all near, or of one component, are done.
    A pair that first meets at a difference can share ``most`` of both from there on, and must share what both
    ``need`` (in parts of 100 + percent).
    """
    own = sets.select("id", F.col("hashes").alias("own_set"))
    of_hub = sets.select(F.col("id").alias("hub"), F.col("hashes").alias("hub_set"))
    none = F.array().cast("array<long>")
    both = grouped.join(own, "id").join(lone, "id", "left").join(of_hub, "hub").where("id <> hub")
    both = both.withColumns({"beside": F.array_except(F.array_except("own_set", "hub_set"), F.coalesce("lone", none)), "lacks": F.array_except("hub_set", "own_set")})
    n, h, r = F.size("own_set"), F.size("hub_set"), F.size("lacks")
    a = n - h + r
    missing = percent * (n + h) - (100 + percent) * (h - r)
    least = F.when(missing > 0, F.ceil(missing / 100)).otherwise(F.floor((100 * r + percent * a) / (100 + percent)) + 1)
    left = r + F.size("beside")
    # half of the hub's size is taken off either side's need
    need = (2 * percent * n + 2 * (100 + percent) * r - (100 + percent) * h).alias("need")
    both = both.select("hub", "id", "root", "hub_root", (missing > 0).alias("far"), (left - least + 1).alias("length"), left.alias("all"), need, F.concat("beside", "lacks").alias("hashes"))
    both = scratch.write(both.where("length > 0 or (not far and root <> hub_root)"), "described")
    direct = both.where("not far and root <> hub_root").select(F.col("hub").alias("a"), F.col("id").alias("b"))
    both = both.where("length > 0")
    # a far set meets others of its hub that are in another component
    open_hubs = both.groupBy("hub").agg(F.min("root").alias("one"), F.max("root").alias("other"), F.max("far").alias("any")).where("one < other and any").select("hub")
    each = both.join(apart(open_hubs), "hub").select("hub", "id", "root", "far", "length", "all", "need", F.explode("hashes").alias("hash"))
    # dealt anew, so that the join before may split a hub that many sets have
    met = each.repartition("hub", "hash").withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("hub", "hash")))
    place = F.row_number().over(Window.partitionBy("hub", "id").orderBy("n", "hash"))
    prefix = met.withColumn("place", place).where("place <= length").select("hub", "id", "root", "far", "hash", (F.col("all") - F.col("place") + 1).alias("most"), "need")
    return prefix, direct


def merge_buckets(scratch: Scratch, keys: DataFrame, sets: DataFrame, lone: DataFrame, percent: int) -> DataFrame:
    """``id, root`` of every set linked with a smaller one, from the buckets ``id, size, lone, key``."""
    # at most so many of a set's shingles are in any other, so a pair's intersection has a bound before it is computed
    shared = F.least(F.col("size") - F.col("lone"), F.col("hub_size") - F.col("hub_lone"))
    fits = 100 * shared >= percent * (F.col("size") + F.col("hub_size") - shared)
    as_hub = [F.col("id").alias("hub"), F.col("size").alias("hub_size"), F.col("lone").alias("hub_lone")]
    # every member with the most typical one of its bucket
    hubs = keys.groupBy("key").agg(F.min(F.struct("lone", "id")).alias("hub")).select("key", F.col("hub.id").alias("hub"))
    hubs = scratch.write(keys.select("key", *as_hub).join(apart(hubs), ["key", "hub"]), "hubs")
    pairs = keys.join(hubs, "key").where(F.col("id") != F.col("hub")).where(fits).select("hub", F.col("id").alias("member")).distinct()
    stars = scratch.write(compared(pairs, sets, percent, percent // 2), "alike")
    labels = components(stars.where("linked"), scratch, "stars").withColumnRenamed("node", "id")
    placed = keys.join(labels, "id", "left").select("id", "size", "lone", "key", F.coalesce("root", "id").alias("root"))
    placed = scratch.write(placed, "placed")
    # who differs too much from every size in its bucket has no links there
    smallest = F.greatest("low", F.col("size") - F.col("lone"))
    low = placed.groupBy("key").agg(F.min("size").alias("low"))
    placed = placed.join(apart(low), "key").where(100 * (F.col("size") - F.col("lone")) >= percent * (F.col("lone") + smallest))
    # in buckets that still hold several components: everyone by its differences from the hub that leads the bucket's hub
    mixed = placed.groupBy("key").agg(F.min("root").alias("one"), F.max("root").alias("other")).where("one < other").select("key")
    led = mixed.join(hubs.select("key", "hub"), "key").join(leading_hubs(hubs, stars), "hub", "left").select("key", F.coalesce("lead", "hub").alias("hub"))
    led = led.join(labels.select(F.col("id").alias("hub"), F.col("root").alias("hub_root")), "hub", "left").select("key", "hub", F.coalesce("hub_root", "hub").alias("hub_root"))
    grouped = placed.join(apart(led), "key").select("hub", "id", "root", "hub_root").distinct()
    prefix, direct = differences(scratch, grouped, sets, lone, percent)
    prefix = scratch.write(prefix, "differences")
    far = prefix.where("far").select("hub", "hash", *(F.col(c).alias(f"far_{c}") for c in ("id", "root", "most", "need")))
    enough = 2 * (100 + percent) * F.least("most", "far_most") >= F.col("need") + F.col("far_need")
    once = ~F.col("far") | (F.col("id") > F.col("far_id"))
    met = prefix.join(far, ["hub", "hash"]).where((F.col("root") != F.col("far_root")) & once & enough)
    both = met.select(F.least("far_id", "id").alias("hub"), F.greatest("far_id", "id").alias("member")).distinct()
    links = scratch.write(linked(both, sets, percent).union(direct), "links")
    if links.isEmpty():
        return labels
    # links between components join the stars
    ends = links.select(F.col("a").alias("id")).union(links.select("b")).distinct().join(labels, "id", "left")
    roots = ends.select("id", F.coalesce("root", "id").alias("root"))
    joined = links.join(roots.select(F.col("id").alias("a"), F.col("root").alias("ra")), "a").join(roots.select(F.col("id").alias("b"), F.col("root").alias("rb")), "b")
    moved = components(joined.select(F.col("ra").alias("a"), F.col("rb").alias("b")), scratch, "joins").select(F.col("node").alias("root"), F.col("root").alias("to"))
    return labels.join(moved, "root", "left").select("id", F.coalesce("to", "root").alias("root")).union(moved.select(F.col("root").alias("id"), F.col("to").alias("root")))


def near_dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``<id_col>, n_shingles, component_id, kept`` for every row.

    A row's set is its distinct shingles of ``words`` words (A-Z lower-cased, split at U+0020 and U+0009 to
    U+000D); with fewer words the whole sequence is one; null, empty and blank texts have an empty set and
    are linked with nothing. Two sets are linked when 100 * intersection >= ``percent`` * union, checked on
    the full sets of 64-bit hashes. ``component_id`` is the smallest id reachable; rows of equal ids share
    theirs, and a row with a null id is a component of its own with a null ``component_id``, kept. Ids are
    integers. An empty table gives an empty one.
    """
    spark = docs.sparkSession
    in_small_batches(spark)
    scratch = Scratch(spark, "near-dedup")
    own = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    sketches = scratch.write(own.mapInArrow(sketch(words), "id long, size long, digest binary, halves array<long>"), "sketches")
    named = sketches.where("id is not null and digest is not null")
    # one row for a text, however often it comes
    groups = scratch.write(named.groupBy("digest").agg(F.min(F.struct("id", "size", "halves")).alias("one")).select("digest", F.col("one.id").alias("rep"), "one.size", "one.halves"), "groups")
    reps = groups.select(F.col("rep").alias("id"), "size", "halves")
    keys = bucket_keys(reps)
    crowded = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    keys = scratch.write(keys.join(apart(crowded), "key").distinct(), "keys")
    ids = keys.select("id").distinct()
    bloom = spark.sparkContext.broadcast(id_filter(ids, ids.count()))
    sets = own.mapInArrow(sets_of(words, bloom), "id long, hashes array<long>").join(ids, "id", "left_semi").distinct()
    sets = scratch.write(sets, "sets")
    lone = scratch.write(lone_shingles(sets), "lone")
    sizes = sets.select("id", F.size("hashes").alias("size")).join(lone.select("id", F.size("lone").alias("lone")), "id", "left").withColumn("lone", F.coalesce("lone", F.lit(0)))
    keys = scratch.write(keys.join(sizes.where(100 * (F.col("size") - F.col("lone")) >= percent * F.col("size")), "id").select("id", "size", "lone", "key").distinct(), "members")
    labels = merge_buckets(scratch, keys, sets, lone, percent)
    roots = groups.join(labels.select(F.col("id").alias("rep"), "root"), "rep", "left").select("digest", F.coalesce("root", "rep").alias("root"))
    component = F.when(F.col("id").isNotNull(), F.coalesce("root", "id"))
    kind = docs.schema[id_col].dataType
    return (
        sketches.join(roots, "digest", "left")
        .select(F.col("id").cast(kind).alias(id_col), F.col("size").alias("n_shingles"), component.cast(kind).alias("component_id"))
        .withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))
    )


def op10_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(load(spark, sf_dir, "documents"), words=4)


#: Links by an inverted index over all shingles, components by a recursive search.
SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) >= 4
    THEN list_distinct(list_transform(range(1, len(w) - 2), lambda i: list_aggregate(w[i:i + 3], 'string_agg', ' ')))
    WHEN len(w) > 0 THEN [list_aggregate(w, 'string_agg', ' ')] ELSE [] END AS sh
  FROM d
), n AS (
  SELECT doc_id, len(sh) AS n FROM s
), x AS (
  SELECT doc_id, unnest(sh) AS g FROM s
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM x a JOIN x b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2
), l AS (
  SELECT p.a, p.b FROM p JOIN n na ON na.doc_id = p.a JOIN n nb ON nb.doc_id = p.b
  WHERE 100 * common >= 80 * (na.n + nb.n - common)
), r AS (
  SELECT doc_id, doc_id AS seen FROM n UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.seen
)
SELECT n.doc_id, n.n AS n_shingles, min(r.seen) AS component_id, n.doc_id = min(r.seen) AS kept
FROM n JOIN r USING (doc_id) GROUP BY n.doc_id, n.n
"""

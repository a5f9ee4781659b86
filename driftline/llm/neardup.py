"""Near-duplicate groups by one-permutation MinHash.

A document is its set of 5-word shingles. One hash deals the shingles into bins; each
bin keeps its minimum, and an empty bin borrows that of the first occupied bin in a
random order of its own (optimal densification). Runs of bins are bands, as long as the
threshold allows (``layout``), and documents with an equal band share a bucket.

Equal sets are one node. Each bucket proposes a star: its members against one centre,
so that candidate edges are as many as bucket entries. Links are confirmed on full
sets and joined into components. What stars can miss is a link between two members of
a bucket whose components are still apart; of those pairs, the ones with a member
outside the bucket's largest component are then compared as well, unless their sizes
and the shingles that only one of them has rule a link out. So every pair that shares
a bucket is compared, ruled out exactly, or already in one component.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.llm.common import checkpointed, small, utf8_values
from driftline.llm.words import mix, shingles

#: Bins at most, and how often a pair at the threshold may share no bucket.
BINS, MISSED = 352, 1e-6
_ODD = np.uint64(0x9E3779B97F4A7C15)  # fixed value: an odd multiplier
SIGNATURE = "struct<n:bigint,key:binary,bands:array<bigint>>"


def layout(percent: int) -> tuple[int, int]:
    """(bands, bins of a band): the longest bands that miss a pair at the threshold once
    in a million at most. 44 of 8 at 85 (unlike documents, at 0.5, share a bucket in 16
    of 100 cases); 58 of 6 at 80 (2 in 100 million missed; 60 of 100)."""
    for rows in range(BINS, 0, -1):
        if (1 - (percent / 100) ** rows) ** (BINS // rows) <= MISSED:
            return BINS // rows, rows
    raise ValueError(f"{BINS} bins are too few for a similarity of {percent} percent")


@lru_cache(maxsize=2)
def _loans(bins: int) -> np.ndarray:
    return np.argsort(np.random.default_rng(3).random((bins, bins)), axis=1)


def bands(hashes: np.ndarray, count: int, rows: int) -> np.ndarray:
    """One 64-bit key per band of a non-empty set of shingle hashes."""
    bins = count * rows
    mixed, lenders = mix(hashes), _loans(bins)
    place = ((mixed >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
    low = np.full(bins, np.uint64((1 << 64) - 1))
    np.minimum.at(low, place, mixed & np.uint64((1 << 32) - 1))
    full = low != np.uint64((1 << 64) - 1)
    empty = np.flatnonzero(~full)
    for loans in (lenders[:, :16], lenders):
        if not len(empty):
            break
        got = full[loans[empty]]
        found = got.any(axis=1)
        low[empty[found]] = low[loans[empty[found], got[found].argmax(axis=1)]]
        empty = empty[~found]
    table = low.reshape(count, rows)
    keys = np.arange(1, count + 1, dtype=np.uint64)
    for r in range(rows):
        keys = mix(keys * _ODD + table[:, r])
    return keys.view(np.int64)


def signature(text: Column, percent: int) -> Column:
    """Set size, 128-bit hash of the set, and band keys of each text; a text without
    words has size 0 and no bands."""
    count, rows = layout(percent)
    kind = pa.struct([("n", pa.int64()), ("key", pa.binary()), ("bands", pa.list_(pa.int64()))])

    @F.arrow_udf(SIGNATURE)
    def sign(texts: pa.Array) -> pa.Array:
        out = []
        for t in utf8_values(texts):
            s = shingles(t)
            out.append({"n": len(s), "key": hashlib.blake2b(s.tobytes(), digest_size=16).digest(),
                        "bands": bands(s, count, rows) if len(s) else []})
        return pa.array(out, type=kind)

    return sign(text)


def shingle_set(text: Column) -> Column:
    """Distinct shingle hashes of each text as array<bigint>."""

    @F.arrow_udf("array<bigint>")
    def hashes(texts: pa.Array) -> pa.Array:
        return pa.array([shingles(t).view(np.int64) for t in utf8_values(texts)], type=pa.list_(pa.int64()))

    return hashes(text)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of each node of an edge list (a, b): the smallest node reachable.

    Alternates two steps until nothing changes: each node's larger neighbours are
    linked to its smallest neighbour, then its smaller ones are. Every step is an
    aggregation and a join over edges, cut off by a checkpoint.
    """
    cur = checkpointed(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                       .where("u <> v").distinct())
    before = None
    while True:
        now = tuple(cur.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before or not now[0]:
            return cur.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now
        both = cur.union(cur.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        cur = checkpointed(small.union(low).distinct())


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are alike enough, counted on full sets."""
    a = sets.select(F.col("node").alias("a"), F.col("hashes").alias("ha"))
    b = sets.select(F.col("node").alias("b"), F.col("hashes").alias("hb"))
    both = F.size(F.array_intersect("ha", "hb"))
    return pairs.join(a, "a").join(b, "b") \
        .where(100 * both >= percent * (F.size("ha") + F.size("hb") - both)).select("a", "b")


def _sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, hashes) of some nodes, made anew from their texts; repeated rows come
    as often, which adds nothing to what is linked."""
    texts = docs.join(small(checkpointed(nodes)), "id")
    return checkpointed(texts.select(F.col("id").alias("node"), shingle_set(F.col("text")).alias("hashes")))


def _sizes(sets: DataFrame) -> DataFrame:
    """(node, n, own): the size of a set, and how many of its shingles no other has.
    Both are null for a node of several rows, whose texts may differ."""
    alone = sets.select("node", F.explode("hashes").alias("h")).groupBy("h") \
        .agg(F.count("*").alias("c"), F.min("node").alias("node")).where("c = 1") \
        .groupBy("node").agg(F.count("*").alias("own"))
    sizes = sets.groupBy("node").agg(F.max(F.size("hashes")).alias("n"), F.count("*").alias("rows"))
    return sizes.join(alone, "node", "left").select(
        "node", F.when(F.col("rows") == 1, F.col("n")).alias("n"),
        F.when(F.col("rows") == 1, F.coalesce("own", F.lit(0))).alias("own"))


def _may_link(n: str, own: str, m: str, other: str, percent: int) -> Column:
    """Whether two sets can be alike enough: they share at most what either has in
    common with any other set. Without a size nothing is ruled out."""
    most = F.least(F.col(n) - F.col(own), F.col(m) - F.col(other))
    return F.coalesce(100 * most >= percent * (F.col(n) + F.col(m) - most), F.lit(True))


def group_near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of ``df``.

    Documents are linked when 100 * intersection >= percent * union of their shingle
    sets; ``component_id`` is the smallest id reachable, ``kept`` marks the row whose
    id that is. Null, empty and wordless texts have size 0 and are like no other. Rows
    without id are neither linked nor dropped (component null, kept). Rows that share
    an id count as one document. No rows give no rows.
    """
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    signed = checkpointed(docs.select("id", signature(F.col("text"), percent).alias("s")).select("id", "s.*"))
    real = signed.where("id IS NOT NULL AND n > 0")
    # Equal sets: one node, named by its smallest id, combined before the shuffle.
    names = real.groupBy("key").agg(F.min("id").alias("node"), F.count("*").alias("copies"))
    classes = checkpointed(names)
    nodes = real.join(classes.where("copies > 1").select("key", "node"), "key", "left") \
        .where("node IS NULL OR node = id")
    entries = nodes.select(F.col("id").alias("node"), F.explode("bands").alias("bucket"))
    several = entries.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1")
    shared = checkpointed(entries.join(several.select("bucket"), "bucket"))
    sets = _sets(docs, shared.select(F.col("node").alias("id")).distinct())
    members = checkpointed(shared.join(_sizes(sets), "node"))
    # A bucket's centre has the smallest share of shingles that no other node has:
    # of the copies of one text, that nearest to it. Among equals, each band takes
    # another one.
    centres = members.groupBy("bucket").agg(F.min_by(
        F.struct(F.col("node").alias("centre"), F.col("n").alias("nc"), F.col("own").alias("oc")),
        F.struct(F.col("own") / F.col("n"), F.col("node").bitwiseXOR(F.xxhash64("bucket")))).alias("c")) \
        .select("bucket", "c.*")
    placed = checkpointed(members.join(centres, "bucket"))
    star = placed.where(F.col("node") != F.col("centre")).where(_may_link("n", "own", "nc", "oc", percent)) \
        .select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")).distinct()
    # Rows that share an id are one document: their classes are linked through it.
    again = checkpointed(signed.where("id IS NOT NULL").groupBy("id").agg(F.count("*").alias("rows"))
                         .where("rows > 1").select("id"))
    same = real.join(again, "id").join(classes, "key").select(F.col("id").alias("a"), F.col("node").alias("b"))
    roots = components(checkpointed(_linked(checkpointed(star), sets, percent).union(same)))
    rest = checkpointed(_apart(placed, roots, percent))
    if not rest.isEmpty():
        more = _linked(rest, sets, percent)
        roots = components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(more))
    by_key = classes.join(roots, "node", "left").where("copies > 1 OR root IS NOT NULL") \
        .select("key", F.coalesce("root", "node").alias("root"))
    rooted = signed.join(by_key, "key", "left")
    if not again.isEmpty():  # rows without words follow their id as well
        by_id = again.join(roots, again["id"] == roots["node"]).select("id", F.col("root").alias("of_id"))
        rooted = rooted.join(by_id, "id", "left").withColumn("root", F.coalesce("of_id", "root"))
    return rooted.select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("root", "id"))
        .alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _apart(placed: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """Pairs that share a bucket and may be linked, have different roots, were in no
    star together, and of which one is outside the bucket's largest component."""
    placed = placed.where("node <> centre").join(roots, "node", "left") \
        .select("bucket", "node", "n", "own", F.coalesce("root", "node").alias("root"))
    counts = placed.groupBy("bucket", "root").agg(F.count("*").alias("c"))
    largest = counts.groupBy("bucket").agg(F.max_by("root", F.struct("c", "root")).alias("most"),
                                           F.count("*").alias("kinds")).where("kinds > 1")
    mixed = placed.join(largest.drop("kinds"), "bucket")
    mixed = checkpointed(mixed.join(mixed.groupBy("node").agg(F.collect_list("bucket").alias("all")), "node"))
    minor = mixed.where("root <> most").select(
        F.col("bucket").alias("at"), F.col("node").alias("x"), F.col("root").alias("rx"), F.col("n").alias("nx"),
        F.col("own").alias("ox"), F.col("all").alias("allx"))
    # The bound is part of the join, so that pairs it refuses are never made; the
    # others come from the first bucket that the two share (a node has one a band).
    different = (F.col("bucket") == F.col("at")) & (F.col("root") != F.col("rx")) \
        & _may_link("n", "own", "nx", "ox", percent) \
        & (F.array_min(F.array_intersect("all", "allx")) == F.col("bucket"))
    return mixed.join(minor, different).select(F.least("node", "x").alias("a"),
                                               F.greatest("node", "x").alias("b")).distinct()

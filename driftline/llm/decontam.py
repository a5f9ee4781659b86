"""Benchmark decontamination by SimHash over item-sized windows.

Only DataFrame functions run here. Texts become lower-case words and 5-word shingles.
A window is as long as a benchmark item and may begin anywhere. It has no more in common
with an item than it has positions with a shingle of any item of that length; as a
prefilter, windows with too few of those for the threshold are left out, which loses
nothing. Equal windows are handled once.

Each distinct window and each item gets a 128-bit SimHash of its shingles, weighted by
how often they come, cut into eight blocks of 16 bits. Two fingerprints within ``RADIUS``
(31) differ in at most ``NEAR`` (3) bits of some block, so the items' index holds every
value that near to each block of theirs, and an equality join on (window length, block,
value) finds all pairs within the radius and 8.5 % of unrelated ones. Pairs within the
radius are then decided by the exact weighted similarity: the shingles in common, counted
as often as they come in both, over those in either.

The window with the greatest bound of a text and length goes first. The others follow only
as far as their bounds may beat what it gave: a text that holds a long item has one
window to compare and not one per start.

Items of one to four words have no shingle: they are held by a document that has them as
consecutive words, which is looked up exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.llm.common import checkpointed, small

SHINGLE, BITS, BLOCK_BITS = 5, 128, 16
#: Items at a similarity of 0.8 differ in 19.4 of 128 bits, with a deviation of 4.1: the
#: radius is 2.8 deviations above (and 99.7 % of such pairs within it).
RADIUS = 31
#: Bits in which the nearest block of a pair within the radius differs at most.
NEAR = RADIUS // (BITS // BLOCK_BITS)


def _words(text_col: str) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(F.col(text_col), F.lit(""))), "[\\x20\\x09-\\x0D]+"), "")


def _runs(hashes: Column, n: int) -> Column:
    """Hashes of the runs of n words, in order, of an array of word hashes."""
    return F.transform(F.slice(hashes, 1, F.greatest(F.size(hashes) - (n - 1), F.lit(0))), lambda x, i: F.xxhash64(
        x, *(F.get(hashes, i + k) for k in range(1, n))))


def with_shingles(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with ``shingles``: hashes of its runs of 5 words in order. Texts of fewer
    words have none."""
    hashed = df.withColumn("_hashes", F.transform(_words(text_col), lambda w: F.xxhash64(w)))
    return hashed.withColumn("shingles", _runs(F.col("_hashes"), SHINGLE)).drop("_hashes")


def simhash(shingles: Column) -> Column:
    """128-bit SimHash of an array of shingle hashes as array<bigint> of two halves; each
    occurrence counts."""

    def half(hashes: Column) -> Column:
        bit = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda b: F.aggregate(
            hashes, F.lit(0), lambda acc, h: acc + F.call_function("getbit", h, b).cast("int") * 2 - 1))
        return F.aggregate(F.transform(bit, lambda s, b: F.when(s > 0, F.call_function(
            "shiftleft", F.lit(1).cast("bigint"), b)).otherwise(F.lit(0).cast("bigint"))),
            F.lit(0).cast("bigint"), lambda acc, x: acc.bitwiseOR(x))

    return F.array(half(shingles), half(F.transform(shingles, lambda h: F.xxhash64(h, F.lit(2)))))


def distance(f: Column, g: Column) -> Column:
    """Bits in which two fingerprints differ."""
    return sum((F.bit_count(F.get(f, F.lit(k)).bitwiseXOR(F.get(g, F.lit(k)))) for k in range(BITS // 64)), F.lit(0))


def blocks(fingerprint: Column) -> Column:
    """The blocks of a fingerprint as array<struct<block, value>>."""
    per = 64 // BLOCK_BITS
    return F.array(*(F.struct(F.lit(k).alias("block"), F.shiftrightunsigned(
        F.get(fingerprint, F.lit(k // per)), BLOCK_BITS * (k % per)).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)).alias("value"))
        for k in range(BITS // BLOCK_BITS)))


def near_blocks(fingerprint: Column) -> Column:
    """The same with every value that differs from a block's in NEAR bits at most."""
    masks = F.lit([m for m in range(1 << BLOCK_BITS) if m.bit_count() <= NEAR]).cast("array<bigint>")
    return F.flatten(F.transform(blocks(fingerprint), lambda b: F.transform(
        masks, lambda m: F.struct(b["block"].alias("block"), b["value"].bitwiseXOR(m).alias("value")))))


def _numbered(shingles: Column) -> Column:
    """Shingles numbered by occurrence, so that a set of them is the weighted set."""
    return F.transform(shingles, lambda x, i: F.xxhash64(x, i - F.array_position(shingles, x)))


def _starts(hits: DataFrame, percent: int) -> DataFrame:
    """(t1, t2, m, start, hits): every window of m positions that holds at least
    ``percent`` of m hits, of the ascending positions ``at`` of all hits. A window has
    its start after one hit and not after the next, so none comes twice."""
    least = F.expr(f"int((m * {percent} + 99) div 100)")

    def of(x: Column, i: Column) -> Column:
        last = F.get("at", i + least - 1)
        first = F.greatest(last - F.col("m") + 1, F.get("at", i - 1) + 1)
        window = F.slice("at", i + 1, F.col("m"))
        return F.when(last - x < F.col("m"), F.transform(F.sequence(first, x), lambda s: F.struct(
            s.alias("start"), F.size(F.filter(window, lambda p: p < s + F.col("m"))).alias("hits"))))

    found = F.flatten(F.filter(F.transform("at", of), lambda x: x.isNotNull()))
    return hits.select("t1", "t2", "m", F.inline_outer(found)).where("start IS NOT NULL")


def _alike(windows: DataFrame, items: DataFrame, index: DataFrame, percent: int) -> DataFrame:
    """(t1, t2, m, start, item_id, similarity): the pairs of windows (t1, t2, m, start, w)
    and items (key, item_id, m, v, g) that are similar enough. ``index``: (key, m, g, block,
    value), some 5,600 rows an item; the estimate of its size is that of the items, so Spark
    is told not to broadcast it."""
    keyed = windows.withColumn("w1", F.xxhash64("w", F.lit(1))).withColumn("w2", F.xxhash64("w", F.lit(2)))
    distinct = keyed.select("m", "w1", "w2", "w").dropDuplicates(["m", "w1", "w2"])
    marked = checkpointed(distinct.withColumn("f", simhash(F.col("w"))))
    near = marked.select("m", "w1", "w2", "f", F.inline(blocks(F.col("f")))) \
        .join(index.hint("merge"), ["m", "block", "value"]).where(distance(F.col("f"), F.col("g")) <= RADIUS) \
        .select("m", "w1", "w2", "key").distinct()
    both = F.size(F.array_intersect(_numbered(F.col("w")), _numbered(F.col("v"))))
    alike = near.join(marked.drop("f"), ["m", "w1", "w2"]).join(items, ["key", "m"]) \
        .withColumn("both", both).withColumn("either", F.size("w") + F.size("v") - F.col("both")) \
        .where(100 * F.col("both") >= percent * F.col("either")) \
        .select("m", "w1", "w2", "item_id", (F.col("both") / F.col("either")).alias("similarity"))
    return keyed.drop("w").join(alike, ["m", "w1", "w2"]).select("t1", "t2", "m", "start", "item_id", "similarity")


def _short(keyed: DataFrame, items: DataFrame) -> DataFrame:
    """(t1, t2, item_id, similarity, n_words, start) of the items of one to four words:
    the first place where a text has them as consecutive words."""
    runs = F.array(*(F.struct(F.lit(n).alias("n"), _runs(F.col("_hashes"), n).alias("runs")) for n in range(1, SHINGLE)))

    def placed(df: DataFrame) -> DataFrame:
        hashed = df.withColumn("_hashes", F.transform(_words("text"), lambda w: F.xxhash64(w)))
        each = hashed.select(*df.columns, F.size("_hashes").alias("size"), F.inline(runs))
        return each.select(*df.columns, "size", "n", F.posexplode("runs").alias("start", "run"))

    of = placed(items.select("item_id", "text")).where("n = size").select("item_id", "n", "run")
    found = placed(keyed.select("t1", "t2", "text")).join(small(checkpointed(of)), ["n", "run"])
    return found.groupBy("t1", "t2", "item_id").agg(F.min(F.struct("start", "n")).alias("b")).select(
        "t1", "t2", "item_id", F.lit(1.0).alias("similarity"), F.col("b.n").alias("n_words"), F.col("b.start").alias("start"))


def leaks(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text_col: str = "text", percent: int = 80) -> DataFrame:
    """(doc_id, item_id, similarity, n_words, start) per document and benchmark item
    that it holds: the most similar window of the item's length, the first of equals.

    An item of fewer than five words is held by a document that has these words one after
    the other; an item without words by none. Null ids are reported as null; repeated rows
    give repeated rows, and items with equal ids are taken together. Windows at a text's
    edge are cut off there. Empty tables give no rows.
    """
    docs = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    keys = [F.xxhash64("text", F.lit(k)).alias(f"t{k}") for k in (1, 2)]
    keyed = docs.where("text IS NOT NULL").select("doc_id", "text", *keys)
    of_bench = benchmark.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text"))
    items = checkpointed(with_shingles(of_bench).withColumn("size", F.size(_words("text")))) \
        .withColumn("m", F.size("shingles"))
    brief = items.where(F.col("size").between(1, SHINGLE - 1))
    items = items.where("m > 0").select("item_id", "shingles", "m")
    known = checkpointed(items.select("m", F.explode("shingles").alias("h")).distinct())
    # Outer, as else a filter on the array's size is inferred, pushed below and
    # evaluated there with every inner array made anew for each element.
    cut = with_shingles(keyed).select("t1", "t2", F.posexplode_outer("shingles").alias("p", "h"))
    hits = cut.join(small(known), "h").select("t1", "t2", "m", "p").distinct()
    starts = checkpointed(_starts(checkpointed(
        hits.groupBy("t1", "t2", "m").agg(F.sort_array(F.collect_list("p")).alias("at"))), percent))
    texts = checkpointed(starts.select("t1", "t2").distinct())
    held = with_shingles(keyed.join(small(texts), ["t1", "t2"]).dropDuplicates(["t1", "t2"])) \
        .select("t1", "t2", "shingles")
    inside = F.least(F.col("start") + F.col("m"), F.size("shingles")) - F.greatest(F.col("start"), F.lit(0))
    bound = F.col("hits") / (F.col("inside") + F.col("m") - F.col("hits"))
    bounded = checkpointed(starts.join(held.select("t1", "t2", F.size("shingles").alias("_n")), ["t1", "t2"])
                           .withColumn("inside", F.least(F.col("start") + F.col("m"), F.col("_n")) - F.greatest(F.col("start"), F.lit(0)))
                           .where((100 + percent) * F.col("hits") >= percent * (F.col("inside") + F.col("m")))
                           .select("t1", "t2", "m", "start", bound.alias("bound")))
    window = F.slice("shingles", F.greatest(F.col("start"), F.lit(0)) + 1, inside)

    def cut_out(places: DataFrame) -> DataFrame:
        return places.join(held, ["t1", "t2"]).select("t1", "t2", "m", "start", F.array_sort(window).alias("w"))

    of_items = checkpointed(items.select(F.xxhash64("item_id", "shingles").alias("key"), "item_id", "m", F.array_sort("shingles").alias("v"))
                            .dropDuplicates(["key"]).withColumn("g", simhash(F.col("v"))))
    top = checkpointed(bounded.groupBy("t1", "t2", "m").agg(F.max(F.struct("bound", (-F.col("start")).alias("back"))).alias("b"))
                       .select("t1", "t2", "m", (-F.col("b.back")).alias("start")))
    index = checkpointed(of_items.select("key", "m", "g", F.inline(near_blocks(F.col("g")))))
    first = checkpointed(_alike(checkpointed(cut_out(top)), of_items, index, percent))
    # What every item of this length has found already; nothing while one is missing.
    reached = first.groupBy("t1", "t2", "m").agg(F.count_distinct(F.struct("item_id")).alias("found"), F.min("similarity").alias("least")) \
        .join(of_items.groupBy("m").agg(F.count_distinct(F.struct("item_id")).alias("all")), "m").where("found = all") \
        .select("t1", "t2", "m", "least")
    rest = bounded.join(top.withColumnRenamed("start", "first"), ["t1", "t2", "m"]).join(reached, ["t1", "t2", "m"], "left") \
        .where("start <> first AND (least IS NULL OR bound > least OR bound = least AND start < first)")
    second = _alike(checkpointed(cut_out(rest)), of_items, index, percent)
    best = first.unionByName(second).groupBy("t1", "t2", "item_id") \
        .agg(F.max(F.struct("similarity", (-F.col("start")).alias("back"), "m")).alias("b")).select(
            "t1", "t2", "item_id", "b.similarity", (F.col("b.m") + (SHINGLE - 1)).alias("n_words"),
            F.greatest(-F.col("b.back"), F.lit(0)).alias("start"))
    if not brief.isEmpty():
        best = best.unionByName(_short(keyed, brief)).groupBy("t1", "t2", "item_id") \
            .agg(F.max(F.struct("similarity", (-F.col("start")).alias("back"), "n_words")).alias("b")) \
            .select("t1", "t2", "item_id", "b.similarity", "b.n_words", (-F.col("b.back")).alias("start"))
    return keyed.select("doc_id", "t1", "t2").join(best, ["t1", "t2"]).select(
        "doc_id", "item_id", "similarity", "n_words", "start")


def without_leaks(spark: SparkSession, df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """``df`` without the documents that hold a benchmark item. Rows without id go by
    their text alone, like all others: equal texts are decided alike."""
    found = leaks(df.select(F.col(text_col).alias("text"), F.xxhash64(text_col, F.lit(1)).alias("doc_id")),
                  benchmark).select(F.col("doc_id").alias("_held")).distinct()
    found = checkpointed(found)
    return df.join(small(found), F.xxhash64(F.col(text_col), F.lit(1)) == F.col("_held"), "left_anti")

"""Ranked lexical search of many items at once, with shared partial sums.

The items' terms are the only ones that matter. One pass over the documents keeps, per
document, its length and how often it holds each of these terms; that table is written once
and gives the statistics (documents, terms, documents by term).

Items share terms. Pairs of terms that lie in several items are mined greedily, the pair of
most items first; a pair becomes a node that stands for both, and nodes are paired again, so
that term sets shared by many items become one node each of a graph. An item is what is left
of its list: a few nodes. For a slice of documents every node's partial score is one array
(an accumulator by document), made once from its two parts and used by all items above it.
Each task keeps the best documents of each item; only these are shuffled and ranked.

All scores are exact integers. Items are taken in blocks of bounded size, each against all
documents.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from driftline.llm.common import checkpointed, text_runs

#: Terms of all items of a block; a block is on the driver and sent to the tasks.
BLOCK_TERMS = 20_000
#: Nodes of an item among which pairs are mined.
WIDTH = 32
#: Numbers of a slice's accumulators, and bytes of text split at a time.
SLICE_CELLS, PART_BYTES = 4_000_000, 4 << 20

# The bytes of a term; A-Z fold.
_TERM = bytes(b for b in range(256) if b >= 0x80 or chr(b).isalnum())
_FOLD = bytes((b + 32 if 65 <= b <= 90 else b) if b in _TERM else 32 for b in range(256))


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in order, in lists of bounded size."""
    folded, at = text.translate(_FOLD), 0
    while at < len(folded):
        end = folded.find(b" ", at + PART_BYTES)
        end = len(folded) if end < 0 else end
        yield folded[at:end].split()
        at = end


# --- the graph of shared term sets ---------------------------------------------------------

@dataclass
class Graph:
    """``leaves``: (term, weight); node number ``len(leaves) + i`` is the sum of the two
    nodes ``pairs[i]``; ``items``: the nodes whose sum is the item's score."""

    leaves: list[tuple[bytes, int]]
    pairs: list[tuple[int, int]]
    items: list[list[int]]


def shared_pairs(items: Sequence[Iterable[int]], leaves: int) -> tuple[list[tuple[int, int]], list[list[int]]]:
    """Mine pairs of nodes that lie in several items until there are none left."""
    lists = [set(x) for x in items]
    pairs: list[tuple[int, int]] = []
    while True:
        use = Counter(n for x in lists for n in x)
        where = defaultdict(list)
        for k, x in enumerate(lists):
            shared = sorted((n for n in x if use[n] > 1), key=lambda n: (-use[n], n))[:WIDTH]
            for pair in combinations(sorted(shared), 2):
                where[pair].append(k)
        made = False
        for (a, b), of in sorted((p for p in where.items() if len(p[1]) > 1), key=lambda p: (-len(p[1]), p[0])):
            left = [k for k in of if a in lists[k] and b in lists[k]]
            if len(left) < 2:
                continue
            node, made = leaves + len(pairs), True
            pairs.append((a, b))
            for k in left:
                lists[k] -= {a, b}
                lists[k].add(node)
        if not made:
            return pairs, [sorted(x) for x in lists]


def graph(items: Sequence[dict[bytes, int]], weight: dict[bytes, int]) -> Graph:
    """The graph of items given as term → occurrences; terms of no weight play no part."""
    numbers: dict[tuple[bytes, int], int] = {}
    lists = [[numbers.setdefault((t, q), len(numbers)) for t, q in sorted(x.items()) if weight.get(t)] for x in items]
    pairs, rest = shared_pairs(lists, len(numbers))
    return Graph([(t, q * weight[t]) for t, q in numbers], pairs, rest)


# --- tasks -----------------------------------------------------------------------------------

def count_terms(batches: Iterable[pa.RecordBatch], vocabulary: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
    """(id, n, terms, counts) per text: its number of terms, and how often it holds each
    of the vocabulary's."""
    for batch in batches:
        sizes, at, numbers, counts = [], [0], [], []
        for run in text_runs(batch.column(1), PART_BYTES):
            for text in run:
                n, found = 0, Counter()
                for part in terms(text):
                    n += len(part)
                    found.update(map(vocabulary.get, part))
                found.pop(None, None)
                sizes.append(n)
                numbers.extend(found)
                counts.extend(found.values())
                at.append(len(numbers))
        offsets = pa.array(at, type=pa.int32())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, type=pa.int64()),
             *(pa.ListArray.from_arrays(offsets, pa.array(x, type=pa.int32())) for x in (numbers, counts))],
            names=["id", "n", "terms", "counts"])


class _Best:
    """The best documents of each item so far: score descending, then id, null last."""

    def __init__(self, items: int, top: int) -> None:
        self.top, self.least = top, np.ones(items, dtype=np.int64)
        empty = np.empty(0, dtype=np.int64)
        self.rows = [(empty, empty, empty) for _ in range(items)]   # score, id is null, id

    def add(self, item: int, score: np.ndarray, null: np.ndarray, ids: np.ndarray) -> None:
        joined = [np.concatenate(x) for x in zip(self.rows[item], (score, null, ids), strict=True)]
        order = np.lexsort((joined[2], joined[1], -joined[0]))[:self.top]
        self.rows[item] = tuple(x[order] for x in joined)
        if len(order) == self.top:
            self.least[item] = self.rows[item][0][-1]


def best_documents(batches: Iterable[pa.RecordBatch], plan: Graph, vocabulary: dict[bytes, int], docs: int,
                   words: int, top: int) -> Iterator[pa.RecordBatch]:
    """A task's ``top`` documents of each item, from rows of ``count_terms``."""
    leaf_term = np.array([vocabulary[t] for t, _ in plan.leaves], dtype=np.int64)
    weight = np.array([w for _, w in plan.leaves], dtype=np.int64)
    leaves, nodes = len(plan.leaves), len(plan.leaves) + len(plan.pairs)
    width = max(1, SLICE_CELLS // max(1, nodes + len(vocabulary) + len(plan.items)))
    best = _Best(len(plan.items), top)
    for batch in batches:
        for start in range(0, batch.num_rows, width):
            part = batch.slice(start, width)
            n = part.column(1).to_numpy(zero_copy_only=False)
            lists = [part.column(k).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for k in (2, 3)]
            per = np.diff(part.column(2).offsets.to_numpy())
            of = np.repeat(np.arange(part.num_rows), per)
            m = 75 + 25 * n * docs // words
            held_by = np.zeros((len(vocabulary), part.num_rows), dtype=np.int64)
            held_by[lists[0], of] = 1_000_000_000 * lists[1] // (1000 * lists[1] + 12 * m[of])
            sums = np.empty((nodes, part.num_rows), dtype=np.int64)
            np.multiply(held_by[leaf_term], weight[:, None], out=sums[:leaves])
            for k, (a, b) in enumerate(plan.pairs, leaves):
                np.add(sums[a], sums[b], out=sums[k])
            ids, null = part.column(0).fill_null(0).to_numpy(), part.column(0).is_null().to_numpy(zero_copy_only=False).astype(np.int64)
            for item, own in enumerate(plan.items):
                score = sums[own].sum(axis=0) if len(own) != 1 else sums[own[0]]
                at = np.flatnonzero(score >= best.least[item])
                if len(at):
                    best.add(item, score[at], null[at], ids[at])
    for item, (score, null, ids) in enumerate(best.rows):
        if len(score):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(score), item, dtype=np.int32)), pa.array(ids, mask=null.astype(bool)), pa.array(score)],
                names=["item", "doc_id", "score"])


# --- the search ------------------------------------------------------------------------------

def _item_terms(items: DataFrame) -> DataFrame:
    """(key, item_id, term, q): how often each item's text holds each of its terms."""

    def count(batches):
        for batch in batches:
            rows = defaultdict(list)
            for key, item, text in zip(batch.column(0), batch.column(1), batch.column(2), strict=True):
                found = Counter()
                for part in terms((text.as_py() or "").encode()):
                    found.update(part)
                for t, q in found.items():
                    for name, value in zip(("key", "item_id", "term", "q"), (key.as_py(), item.as_py(), t, q), strict=True):
                        rows[name].append(value)
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows["key"], type=pa.int64()), pa.array(rows["item_id"], type=pa.int64()),
                     pa.array(rows["term"], type=pa.binary()), pa.array(rows["q"], type=pa.int64())],
                    names=["key", "item_id", "term", "q"])

    return items.select(F.xxhash64("item_id", "text").alias("key"), "item_id", "text").mapInArrow(
        count, "key bigint, item_id bigint, term binary, q bigint")


def _search_block(docs: DataFrame, spark: SparkSession, rows: list, top: int) -> DataFrame:
    """(item_id, rank, doc_id, score) of one block of items, given as their terms' rows."""
    of_items: dict = defaultdict(dict)
    for r in rows:
        of_items[r["key"], r["item_id"]][bytes(r["term"])] = r["q"]
    keys = sorted(of_items, key=lambda k: (k[1] is None, k[1] if k[1] is not None else 0, k[0]))
    vocabulary = {t: i for i, t in enumerate(sorted({t for x in of_items.values() for t in x}))}
    sent = spark.sparkContext.broadcast(vocabulary)
    counted = checkpointed(docs.mapInArrow(lambda batches: count_terms(batches, sent.value),
                                           "id bigint, n bigint, terms array<int>, counts array<int>"))
    total = counted.agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("words")).first()
    having = counted.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("df")).toArrow().to_pydict()
    df = dict(zip(having["t"], having["df"], strict=True))
    n_docs, n_words = int(total["docs"] or 0), int(total["words"] or 0)
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[i] + 1))) for t, i in vocabulary.items() if i in df}
    plan = spark.sparkContext.broadcast(graph([of_items[k] for k in keys], weight))
    few = counted.where(F.size("terms") > 0).mapInArrow(
        lambda batches: best_documents(batches, plan.value, sent.value, n_docs, n_words, top), "item int, doc_id bigint, score bigint")
    # One row per item of the block: bounded by the block.
    names = spark.createDataFrame([(i, k[1]) for i, k in enumerate(keys)], "item int, item_id bigint")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return few.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top) \
        .join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def search(df: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
           item_text_col: str = "text", top: int = 20, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``top`` documents with a score above 0,
    best first, equal scores by ascending id (a null id last). Ids are whole numbers.

    Terms are runs of ASCII letters and digits and of all characters beyond ASCII, A-Z as
    a-z. A document with n terms has m = 75 + 25 n N div L (N documents with a term, L
    terms in all); an item's occurrence of a term held by df documents, tf times by this
    one, adds floor(1000 ln((2 N + 2) / (2 df + 1))) * (10^9 tf div (1000 tf + 12 m)).

    Null and empty texts have no terms: such a document is never found and such an item
    finds nothing. A repeated document is found as often as it comes; a repeated item is
    one, and items that share an id but not their text are ranked apart. Other columns
    play no part; empty tables give no rows.
    """
    spark = df.sparkSession
    docs = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    distinct = items.select(F.col(item_col).cast("bigint").alias("item_id"), F.col(item_text_col).alias("text")).distinct()
    rows = checkpointed(_item_terms(distinct))
    blocks = max(1, math.ceil(rows.count() / block_terms))
    out = None
    for k in range(blocks):
        # About block_terms rows: items are dealt to blocks by their hash.
        block = rows.where(F.pmod("key", F.lit(blocks)) == k).toArrow().to_pylist()
        if block:
            found = _search_block(docs, spark, block, top)
            out = found if out is None else out.unionByName(found)
    empty = "item_id bigint, rank int, doc_id bigint, score bigint"
    return spark.createDataFrame([], empty) if out is None else out

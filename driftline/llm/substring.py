"""Substring dedup over difference-cover anchors.

A window of ``window`` words is removed wherever its words also start anywhere else.
Hashing every window would shuffle one row per word. A difference cover of a period v
is a set D such that any two positions get both into D modulo v by moving the same
distance below v. So if two windows are equal, some aligned shorter window inside
them, an anchor of ``window - v + 1`` words, starts at a cover position in both. Only
those |D| of v positions are hashed and shuffled. A window that holds no anchor which
comes again is unique; around the others the match is extended to whole windows,
which are compared by a 128-bit hash.

Equal texts are one text with a count. Hashes that come again are found by sorting
each hash partition and reading it as a stream: no group of copies is ever gathered.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.llm.common import partitions
from driftline.llm.words import window_hashes, word_hashes

#: Perfect difference sets, by period.
COVERS = {7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18)}
#: Stands for "again in the same text" among the texts that hold a hash.
AGAIN = 0


def cover(window: int) -> tuple[int, np.ndarray, int]:
    """(period, cover positions, words of an anchor) for a window: the largest period
    that leaves an anchor at least two fifths of the window; else every position."""
    fits = [v for v in COVERS if 5 * (window - v + 1) >= 2 * window]
    if not fits:
        return 1, np.zeros(1, dtype=np.int64), window
    return max(fits), np.array(COVERS[max(fits)]), window - max(fits) + 1


def _anchors(words: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of a text's anchors; none if it has no whole window."""
    if len(words) < window:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    period, places, size = cover(window)
    hashes = window_hashes(words, size, 1).view(np.int64)
    at = np.flatnonzero(np.isin(np.arange(period), places)[np.arange(len(hashes)) % period])
    return at, hashes[at]


def _windows(words: np.ndarray, window: int) -> np.ndarray:
    """Two 64-bit hashes of each window, one row each."""
    return np.stack([window_hashes(words, window, seed).view(np.int64) for seed in (2, 3)], axis=1)


def _batch(names: str, *columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names.split())


def _emit_anchors(window: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()                 # texts of this task: a copy adds nothing
        for batch in batches:
            hashes, owners = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
                if key in seen:
                    continue
                seen.add(key)
                found, times = np.unique(_anchors(word_hashes(text.as_py()), window)[1], return_counts=True)
                again = found[times > 1]
                hashes += [found, again]
                owners += [np.full(len(found), key), np.full(len(again), AGAIN)]
            yield _batch("hash class", np.concatenate(hashes), np.concatenate(owners))

    return run


def _shared(keys: int):
    """mapInArrow function over rows sorted by key columns and then class: rows whose
    key has two classes or more, one per key and class. Holds one batch at a time."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, given = None, False              # the row before, and if it was given out
        for batch in batches:
            table = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1)
            if not len(table):
                continue
            if last is not None:
                table = np.concatenate([last[None], table])
            new_key = np.ones(len(table), dtype=bool)
            new_key[1:] = (table[1:, :keys] != table[:-1, :keys]).any(axis=1)
            first = new_key.copy()
            first[1:] |= table[1:, keys] != table[:-1, keys]
            run_of = np.cumsum(new_key) - 1
            several = np.bincount(run_of, first) > 1
            if last is not None:
                several[0] |= given
            out = first & several[run_of]
            again = given and last is not None
            last, given = table[-1], bool(several[-1])
            if again:
                out[0] = False                 # given out with the batch before
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in table[out].T], names=batch.schema.names)

    return run


def _in_two_texts(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows (keys, class, more) whose key occurs with at least two classes."""
    order = [*keys, "class", *[c for c in rows.columns if c not in (*keys, "class")]]
    return rows.select(*order).repartition(partitions(rows.sparkSession), *keys) \
        .sortWithinPartitions(*keys, "class") \
        .mapInArrow(_shared(len(keys)), rows.select(*order).schema).where(F.col("class") != AGAIN)


def _emit_windows(window: int):
    period = cover(window)[0]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            parts = [np.empty((0, 4), np.int64)]
            get = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            for key, text, found in zip(get["class"].to_pylist(), get["text"].cast(pa.binary()),
                                        get["found"], strict=True):
                if not found.is_valid or key in seen:
                    continue
                seen.add(key)
                words = word_hashes(text.as_py())
                at, hashes = _anchors(words, window)
                held = np.zeros(max(0, len(words) - window + 1) + period, dtype=np.int64)
                held[at[np.isin(hashes, found.values.to_numpy(zero_copy_only=False))] + 1] = 1
                count = np.cumsum(held)
                starts = np.arange(len(words) - window + 1)
                starts = starts[count[starts + period] > count[starts]]
                if not len(starts):
                    continue
                made, first, times = np.unique(_windows(words, window)[starts], axis=0,
                                               return_index=True, return_counts=True)
                rows = np.column_stack([made, np.full(len(made), key), starts[first]])
                again = rows[times > 1].copy()
                again[:, 2] = AGAIN
                parts += [rows, again]
            yield _batch("w1 w2 class place", *np.concatenate(parts).T)

    return run


def _remove(window: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            get = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            kept, sizes, gone = [], [], []
            for text, other, places, whole in zip(get["text"].cast(pa.binary()), get["class2"].to_pylist(),
                                                  get["found"], get["whole"].to_pylist(), strict=True):
                data = text.as_py()
                words = data.split()
                n = len(words)
                drop = np.zeros(n + 1, dtype=np.int64)
                if n >= window and whole and other in whole:
                    drop[0] = 1                # the whole text comes again
                elif n >= window and places.is_valid:
                    made = window_hashes(word_hashes(data), window, 2)
                    starts = np.flatnonzero(np.isin(made, made[places.values.to_numpy(zero_copy_only=False)]))
                    np.add.at(drop, starts, 1)
                    np.add.at(drop, starts + window, -1)
                stay = np.cumsum(drop)[:n] == 0
                left = words if stay.all() else [w for w, s in zip(words, stay.tolist(), strict=True) if s]
                kept.append(b" ".join(left))
                sizes.append(n)
                gone.append(n - len(left))
            yield pa.RecordBatch.from_arrays(
                [get["id"], pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()),
                 pa.array(kept, pa.binary()).cast(pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_text"])

    return run


def remove_repeats(df: DataFrame, window: int = 35, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text) per row of ``df``.

    Removes every word covered by a window whose word sequence also starts anywhere
    else, in the same text too, judged on the input. Kept words are joined by one
    space. Null, empty and wordless texts have no words; texts shorter than a window
    stay whole. Repeated rows and rows that share an id are texts of their own. No
    rows give no rows. Texts are shuffled once.
    """
    docs = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    # Texts are named by 64 bits; where it matters a second 64 must agree.
    named = docs.withColumn("class", F.xxhash64("text", F.lit(1))).withColumn("class2", F.xxhash64("text", F.lit(2)))
    copied = named.groupBy("class", "class2").agg(F.count("*").alias("c")).where("c > 1") \
        .groupBy("class").agg(F.collect_set("class2").alias("whole"))
    anchors = named.select("class", "text").mapInArrow(_emit_anchors(window), "hash bigint, class bigint")
    held = _in_two_texts(anchors, ["hash"]).groupBy("class").agg(F.collect_list("hash").alias("found"))

    def beside(found: DataFrame) -> DataFrame:
        both = found.join(copied, "class", "full_outer")
        return named.join(both.hint("shuffle_hash"), "class", "left")

    windows = beside(held).mapInArrow(_emit_windows(window), "w1 bigint, w2 bigint, class bigint, place bigint")
    places = _in_two_texts(windows, ["w1", "w2"]).groupBy("class") \
        .agg(F.collect_list(F.col("place").cast("int")).alias("found"))
    schema = f"doc_id {df.schema[id_col].dataType.simpleString()}, n_words bigint, n_removed bigint, kept_text string"
    return beside(places).mapInArrow(_remove(window), schema)

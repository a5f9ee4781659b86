"""Phrase collocations from count streams in prefix and suffix order.

Phrases of up to five words are counted level by level. A phrase occurs no more often than
any part of it, so words seen fewer than ``least`` times end a window, and so do, from four
words on, word triples seen fewer than ``least`` times: no phrase that reaches the threshold
is lost. Pairs and triples come from one pass over windows of three known words. The known
words and triples are sent to the tasks only while they are counted to be few (``KNOWN``);
beyond that all windows are counted, with the same result.

The counts make one stream of (lang, phrase, f). Every cut of a phrase reads the stream
twice: its first part in prefix order, its rest in suffix order. A phrase one word longer
gives its count to its first words (prefix order) and to its last words (suffix order), the
extension counts: a longer phrase occurs as often as a part of it only if every phrase in
between does, so one word more is enough to know. All streams are sorted by (lang, phrase)
and merge-joined in lockstep; there is no table of phrases in memory.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftline.llm.common import checkpointed, partitions, small, text_runs

#: Known words, and known triples, that may be sent to the tasks.
KNOWN = 1_000_000
#: Parts a pair of very frequent words is counted in.
SALTS = 64
#: Bytes of text and rows of counts that a task holds at a time.
RUN_BYTES, HELD_ROWS, HELD_TRIPLES = 4 << 20, 1_000_000, 2_000_000

# Fixed values of the text rules: what ends a piece, letters that fold.
_ENDS = b".,;:!?\n\v\f\r"
_FOLD = bytes.maketrans(bytes(range(65, 91)) + _ENDS + b"\t", bytes(range(97, 123)) + b"\n" * len(_ENDS) + b" ")
_BREAK, _NOTHING = -1, -2

SCHEMA = "lang string, phrase string, c bigint"


def _runs(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    """(lang, folded texts with \\n between pieces) in runs of bounded size."""
    for batch in batches:
        langs = batch.column(0)
        for lang in pc.unique(langs):
            of = batch.column(1).filter(pc.equal(langs, lang))
            for texts in text_runs(of, RUN_BYTES):
                yield lang.as_py(), b"\n".join(texts).translate(_FOLD)


def _rows(lang: str, phrases: pa.Array, counts) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([lang] * len(phrases), type=pa.string()), phrases,
                                       pa.array(counts, type=pa.int64())], names=["lang", "phrase", "c"])


def _as_text(words: Iterable[bytes]) -> pa.Array:
    return pa.array(list(words), type=pa.binary()).cast(pa.string())


def count_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word counts of a task's texts, in parts of bounded size."""
    counts: dict[str, Counter] = defaultdict(Counter)
    for lang, data in _runs(batches):
        counts[lang].update(data.split())
        if len(counts[lang]) > HELD_ROWS:
            got = counts.pop(lang)
            yield _rows(lang, _as_text(got), list(got.values()))
    for lang, got in counts.items():
        yield _rows(lang, _as_text(got), list(got.values()))


def _ids(data: bytes, known: dict[bytes, int] | None) -> tuple[np.ndarray, list[bytes] | None]:
    """Word ids in text order, with a break at every end of a piece and unknown word;
    without known words the texts' own words are numbered and named."""
    parts = data.replace(b"\n", b" \n ").split(b" ")
    names = None
    if known is None:
        names = [w for w in dict.fromkeys(parts) if w not in (b"", b"\n")]
        known = {w: i for i, w in enumerate(names)} | {b"": _NOTHING}
    ids = np.fromiter(map(known.get, parts, repeat(_BREAK)), dtype=np.int64, count=len(parts))
    return ids[ids != _NOTHING], names


def _summed(rows: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows (words in columns) in ascending order with their counts."""
    if not rows.shape[1]:
        return rows, counts
    order = np.lexsort(rows[::-1])
    rows, counts = rows[:, order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], (rows[:, 1:] != rows[:, :-1]).any(axis=0))))
    return rows[:, first], np.add.reduceat(counts, first)


def _windows(ids: np.ndarray, size: int, least: int, begins: np.ndarray) -> np.ndarray:
    """Columns of words of each window of ``size`` words of which every ``least`` words in
    a row begin a shortest window."""
    n = len(ids) - size + 1
    if n <= 0:
        return np.empty((size, 0), dtype=np.int32)
    ok = begins[:n].copy()
    for k in range(1, size - least + 1):
        ok &= begins[k:n + k]
    at = np.flatnonzero(ok)
    return np.stack([ids[at + k] for k in range(size)]).astype(np.int32)


class Numbering:
    """Numbers of the known words, lang by lang in order: ``ids[lang]`` by word, and the
    words by number in ``names``. A pair and a triple are numbers as well, their words being
    digits to the base ``size``."""

    def __init__(self, words: dict[str, list[str]]) -> None:
        self.ids, names = {}, []
        self.langs = sorted(words)
        self.starts = []
        for lang in self.langs:
            of = [w.encode() for w in words[lang]]
            self.starts.append(len(names))
            self.ids[lang] = dict(zip(of, range(len(names), len(names) + len(of)), strict=True)) | {b"": _NOTHING}
            names += of
        self.names, self.size = _as_text(names), len(names) + 1

    def of(self, lang: str) -> dict[bytes, int]:
        return self.ids.get(lang, {b"": _NOTHING})

    def numbers(self, ids: np.ndarray) -> np.ndarray:
        """The windows of three words, or of two before a break, that begin in a run of
        ids; ``size - 1`` stands for no third word."""
        first, second = ids[:-1], ids[1:]
        third = np.append(ids[2:], _BREAK)
        third = np.where(third >= 0, third, self.size - 1)
        return ((first * self.size + second) * self.size + third)[(first >= 0) & (second >= 0)]

    def phrases(self, numbers: np.ndarray, words: int) -> tuple[list[str], pa.Array]:
        """Langs and phrases of numbers of pairs or triples."""
        digits = []
        for _ in range(words):
            numbers, digit = np.divmod(numbers, self.size)
            digits.insert(0, digit)
        at = np.searchsorted(np.array(self.starts), digits[0], side="right") - 1
        return [self.langs[i] for i in at], _phrases(np.stack(digits), self.names)


def count_triples(batches: Iterable[pa.RecordBatch], words: dict[str, list[str]], counts: np.ndarray,
                  limit: float) -> Iterator[pa.RecordBatch]:
    """(pair, salt, third, c) of the windows of up to three known words within pieces; null
    is no third word. A pair has salt 0, unless both its words occur more than ``limit``
    times (``counts`` by number): then each third word has one of SALTS."""
    known = Numbering(words)
    held, sums = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)

    def rows() -> pa.RecordBatch:
        pair, third = np.divmod(held, known.size)
        first, second = np.divmod(pair, known.size)
        hot = np.minimum(counts[first], counts[second]) > limit
        return pa.RecordBatch.from_arrays(
            [pa.array(pair), pa.array(np.where(hot, 1 + third % SALTS, 0).astype(np.int32)),
             pa.array(third.astype(np.int32), mask=third == known.size - 1), pa.array(sums)], names=["pair", "salt", "third", "c"])

    for lang, data in _runs(batches):
        ids, _ = _ids(data, known.of(lang))
        got, n = np.unique(known.numbers(ids), return_counts=True)
        held, at = np.unique(np.concatenate((held, got)), return_inverse=True)
        sums = np.bincount(at, weights=np.concatenate((sums, n)), minlength=len(held)).astype(np.int64)
        if len(held) > HELD_TRIPLES:
            yield rows()
            held, sums = held[:0], sums[:0]
    yield rows()


def _pairs_and_triples(texts: DataFrame, sent, size: int, limit: float, least: int) -> DataFrame:
    """(pair, third, f) of the pairs (null third) and triples that reach the threshold.

    The windows are shuffled once, by pair and salt. A pair without salt is whole in its
    partition; the sums of a salted one, in at most SALTS partitions, are added up after.
    """
    windows = texts.mapInArrow(lambda batches: count_triples(batches, *sent.value, limit),
                               "pair bigint, salt int, third int, c bigint")
    third, f = F.col("third"), F.col("f")
    summed = windows.repartition("pair", "salt").groupBy("pair", "salt", "third").agg(F.sum("c").alias("f"))
    either = F.array(F.struct(F.lit(None).cast("int").alias("third")),
                     F.when(third.isNotNull() & (f >= least), F.struct(third.alias("third"))))
    parts = summed.select("pair", "salt", F.inline(F.array_compact(either)), "f").groupBy("pair", "salt", "third") \
        .agg(F.sum("f").alias("f")).where((f >= least) | (F.col("salt") > 0) & third.isNull())
    return checkpointed(parts.groupBy("pair", "third").agg(F.sum("f").alias("f")).where(f >= least)) \
        .withColumn("triple", F.col("pair") * F.lit(size).cast("bigint") + F.col("third"))


def count_windows(batches: Iterable[pa.RecordBatch], sizes: Iterable[int], words: dict[str, list[str]] | None,
                  triples: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """Counts of the windows of each of ``sizes`` within pieces. ``words``: the known words
    by lang, or None for any; ``triples`` (only with words and sizes over three): the numbers
    of the known triples, ascending, or None for any."""
    sums: dict = {}
    known = Numbering(words) if words is not None else None

    def rows_of(key) -> pa.RecordBatch:
        return _rows(key[0], _phrases(sums[key][0], known.names), sums[key][1])

    for lang, data in _runs(batches):
        ids, names = _ids(data, known.of(lang) if known else None)
        # How many words the shortest window has, and where one begins.
        least, begins = 2, (ids[:-1] >= 0) & (ids[1:] >= 0)
        if triples is not None:
            least, begins = 3, begins[:-1] & begins[1:]
            number = (ids[:-2] * known.size + ids[1:-1]) * known.size + ids[2:]
            at = np.minimum(np.searchsorted(triples, number), max(0, len(triples) - 1))
            begins &= triples[at] == number if len(triples) else False
        for size in sizes:
            got = _windows(ids, size, least, begins)
            rows, counts = _summed(got, np.ones(got.shape[1], dtype=np.int64))
            if names is not None:   # numbers of this run alone
                yield _rows(lang, _phrases(rows, _as_text(names)), counts)
                continue
            key = (lang, size)
            if key in sums:
                rows, counts = np.concatenate((sums[key][0], rows), axis=1), np.concatenate((sums[key][1], counts))
                if rows.shape[1] > HELD_ROWS:
                    rows, counts = _summed(rows, counts)
            sums[key] = rows, counts
            if rows.shape[1] > HELD_ROWS // 2:
                yield rows_of(key)
                del sums[key]
    for key in list(sums):
        sums[key] = _summed(*sums[key])
        yield rows_of(key)


def _phrases(rows: np.ndarray, names: pa.Array) -> pa.Array:
    return pc.binary_join_element_wise(*(names.take(pa.array(r)) for r in rows), " ")


def _at_least(counted: DataFrame, least: int) -> DataFrame:
    """(lang, phrase, f) of the phrases that reach the threshold."""
    return counted.groupBy("lang", "phrase").agg(F.sum("c").alias("f")).where(F.col("f") >= least)


def _by_lang(df: DataFrame) -> dict[str, list]:
    got = defaultdict(list)
    for lang, phrase in zip(*(df.select("lang", "phrase").toArrow().to_pydict()[c] for c in ("lang", "phrase")), strict=True):
        got[lang].append(phrase)
    return {lang: sorted(x) for lang, x in got.items()}


def _counts_of(words: DataFrame, of: dict[str, list[str]]) -> np.ndarray:
    """Occurrences of the known words by their number."""
    got = {(r["lang"], r["phrase"]): r["f"] for r in words.toArrow().to_pylist()}
    return np.array([got[lang, w] for lang in sorted(of) for w in of[lang]], dtype=np.int64)


def phrase_counts(df: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = 100, longest: int = 5,
                  known: int = KNOWN) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, k, f) of all phrases of k = 1 to ``longest`` words that occur
    ``least`` times, (lang, n) with the number of word occurrences), both checkpointed."""
    spark = df.sparkSession
    texts = df.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.col(text_col).alias("text")).where("text IS NOT NULL")
    counted = texts.mapInArrow(count_words, SCHEMA).groupBy("lang", "phrase").agg(F.sum("c").alias("f"))
    # The words below the threshold are one row per lang.
    words = checkpointed(counted.groupBy("lang", F.when(F.col("f") >= least, F.col("phrase")).alias("phrase"))
                         .agg(F.sum("f").alias("f")))
    totals = checkpointed(words.groupBy("lang").agg(F.sum("f").alias("n")))
    words = words.where("phrase IS NOT NULL")
    levels = [words.withColumn("k", F.lit(1))]
    sent = few = None
    if words.count() <= known:
        of = _by_lang(words)
        sent = spark.sparkContext.broadcast(of)
    if longest >= 2 and sent is None:
        levels.append(checkpointed(_at_least(_window_counts(texts, [2], None, None), least)).withColumn("k", F.lit(2)))
    elif longest >= 2:
        # A pair in no more than a quarter of a partition's share of the words is not salted.
        limit = (totals.agg(F.sum("n")).first()[0] or 0) / (4 * partitions(spark))
        found = _pairs_and_triples(texts, spark.sparkContext.broadcast((of, _counts_of(words, of))),
                                   sum(map(len, of.values())) + 1, limit, least)
        for column, rows, k in (("pair", found.where("third IS NULL"), 2), ("triple", found.where("third IS NOT NULL"), 3))[:longest - 1]:
            levels.append(rows.select(column, "f").mapInArrow(_naming(sent, k), "lang string, phrase string, f bigint").withColumn("k", F.lit(k)))
        triples = found.where("third IS NOT NULL").select("triple")
        if triples.count() <= known:
            few = spark.sparkContext.broadcast(np.sort(triples.toArrow().column(0).to_numpy()))
    sizes = list(range(3 if sent is None else 4, longest + 1))
    if sizes:
        more = _at_least(_window_counts(texts, sizes, sent, few), least)
        levels.append(checkpointed(more).withColumn("k", F.size(F.split("phrase", " "))))
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    return out.select("lang", "phrase", F.col("k").cast("int").alias("k"), "f"), totals


def _naming(words, size: int):
    """mapInArrow function: (number, f) of pairs or triples to (lang, phrase, f)."""

    def named(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = None
        for batch in batches:
            known = known or Numbering(words.value)
            langs, phrases = known.phrases(batch.column(0).to_numpy(), size)
            yield pa.RecordBatch.from_arrays([pa.array(langs, type=pa.string()), phrases, batch.column(1)], names=["lang", "phrase", "f"])

    return named


def _window_counts(texts: DataFrame, sizes: list[int], words, triples) -> DataFrame:
    """``words``, ``triples``: broadcasts of what is known, or None."""
    return texts.mapInArrow(lambda batches: count_windows(
        batches, sizes, words.value if words else None, triples.value if triples else None), SCHEMA)


def _joined(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    return left.join(right.hint("merge"), on, how)


def collocations(df: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = 100, top: int = 2000,
                 longest: int = 5, known: int = KNOWN) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each lang's ``top`` phrases of two to
    ``longest`` words.

    A-Z count as a-z; pieces end at . , ; : ! ? and line ends, words at spaces and tabs.
    ``a`` counts the phrase, ``l`` and ``r`` its first part and its rest at the cut with
    the lowest score floor(1000 a n / (l r)), the first of equals; ``n`` all words of the
    lang. Phrases inside a longer phrase that occurs as often are left out. Equal scores go
    by ``a`` descending, then by phrase (UTF-8 bytes). Null texts hold nothing, a null lang
    is ``und``, repeated rows count again, an empty table gives no rows; other columns play
    no part. Products are decimals of 38 digits, so they are exact up to 10^38.
    """
    counts, totals = phrase_counts(df, lang_col, text_col, least, longest, known)
    split, size = F.split("phrase", " "), F.col("k")
    stream = counts.select("lang", "phrase", "f")
    cuts = counts.where("k > 1").select("lang", "phrase", F.col("f").alias("a"), "k", split.alias("w"),
                                        F.explode(F.sequence(F.lit(1), size - 1)).alias("cut"))
    cuts = cuts.select("lang", "phrase", "a", "cut", F.array_join(F.slice("w", F.lit(1), F.col("cut")), " ").alias("first"),
                       F.array_join(F.slice("w", F.col("cut") + 1, size - F.col("cut")), " ").alias("rest"))
    cuts = _joined(cuts, stream.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cuts = _joined(cuts, stream.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    whole = "decimal(19,0)"
    score = F.expr(f"(cast(1000 as decimal(4,0)) * (cast(a as {whole}) * cast(n as {whole}))) div (cast(l as {whole}) * cast(r as {whole}))")
    scored = cuts.join(small(totals), "lang").select("lang", "phrase", "a", "n", F.struct(score.alias("score"), "cut", "l", "r").alias("s"))
    best = scored.groupBy("lang", "phrase", "a", "n").agg(F.min("s").alias("s"))
    longer = counts.where("k > 2").select("lang", split.alias("w"), "k", "f")
    parts = [F.array_join(F.slice("w", F.lit(start), F.col("k") - 1), " ") for start in (1, 2)]
    extended = longer.select("lang", F.explode(F.array(*parts)).alias("phrase"), "f") \
        .groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    kept = _joined(best, extended, ["lang", "phrase"], "left").where("longer IS NULL OR longer < a")
    order = Window.partitionBy("lang").orderBy(F.desc("s.score"), F.desc("a"), "phrase")
    return kept.withColumn("rank", F.row_number().over(order).cast("bigint")).where(F.col("rank") <= top).select(
        "lang", "rank", "phrase", "a", "s.l", "s.r", "n", "s.score")

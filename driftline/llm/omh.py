"""Order MinHash fingerprints of texts.

A text is the list of its k-mers (runs of ``k`` code points), each numbered by how
often it came before, so that no two are equal. Each of ``size`` hash functions picks
the ``picks`` smallest numbered k-mers, puts them back in the order in which they
stand in the text, and hashes that tuple. Two texts agree at a place when they share
the k-mers in the same order, so the share of places that agree falls with edit
distance, also where the same k-mers stand in another order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.llm.common import partitions, range_bounds

K, PICKS, SIZE = 8, 2, 32
_ODD = np.uint64(0x9E3779B97F4A7C15)  # fixed value: an odd multiplier
_SEEDS = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(32)) * _ODD
    return x ^ x >> np.uint64(29)


def numbered_kmers(text: str, k: int = K) -> np.ndarray:
    """Hash of each k-mer with its occurrence number, in text order. A text shorter
    than k is one k-mer; an empty text has none."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    n = len(points)
    if not n:
        return points
    k = min(k, n)
    count = n - k + 1
    codes = np.full(count, k, dtype=np.uint64)
    for i in range(k):
        codes *= _ODD
        codes += points[i:i + count]
    codes = _mix(codes)
    # Sort with the position in the low bits: equal k-mers stand together, in order.
    low = np.uint64((1 << count.bit_length()) - 1)
    packed = np.sort(codes & ~low | np.arange(count, dtype=np.uint64))
    where, group = (packed & low).astype(np.int64), packed & ~low
    first = np.empty(count, dtype=bool)
    first[0] = True
    np.not_equal(group[1:], group[:-1], out=first[1:])
    if not first.all():
        index = np.arange(count)
        times = index - np.maximum.accumulate(np.where(first, index, 0))
        codes[where] += times.astype(np.uint64) * _SEEDS[0]
        codes = _mix(codes)
    return codes


def sketch(text: str, k: int = K, picks: int = PICKS, size: int = SIZE) -> np.ndarray:
    """``size`` 32-bit values; equal texts have equal sketches."""
    codes = numbered_kmers(text, k)
    picks = min(picks, len(codes))
    tuples = np.full(size, picks, dtype=np.uint64)
    if picks:
        chosen = np.empty((size, picks), dtype=np.int64)
        for j in range(size):
            hashed = (codes ^ _SEEDS[1 + j]) * _ODD
            for p in range(picks):
                at = chosen[j, p] = hashed.argmin()
                hashed[at] = np.uint64((1 << 64) - 1)
        chosen.sort(axis=1)
        for p in range(picks):
            tuples = _mix(tuples * _ODD + codes[chosen[:, p]])
    return (tuples >> np.uint64(32)).astype("<u4")


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal places of two sketches, 0 to 1."""
    return float(np.count_nonzero(a == b)) / len(a)


def fingerprint(text: Column) -> Column:
    """Sketch of each text of a column as hex; null is sketched as the empty text."""

    @F.arrow_udf("string")
    def hexes(texts: pa.Array) -> pa.Array:
        return pa.array([sketch(t or "").tobytes().hex() for t in texts.to_pylist()], type=pa.string())

    return hexes(text)


def fingerprint_documents(df: DataFrame, text_col: str = "text", out_col: str = "fingerprint") -> DataFrame:
    """``df`` with fingerprints in ``out_col`` (a column of that name is replaced)."""
    return df.withColumn(out_col, fingerprint(F.col(text_col)))


def edited(text: str, after: str) -> str:
    """The text with its last third replaced by as many first code points of the next
    (or all, if it has fewer)."""
    cut = len(text) // 3
    return text[:len(text) - cut] + after[:cut]


def _in_line(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(part, halo, id, text): ranges of ids, each followed by its successor's first
    document (halo), sorted, ids descending. Texts are shuffled once."""
    spark = df.sparkSession
    n = partitions(spark)
    rows = df.select(F.col(id_col).cast("bigint").alias("id"),
                     F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    bounds = range_bounds(rows, "id", n)

    none = -(1 << 63)                          # stands for a missing id, the last of all

    def parts_of(ids: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        values = ids.fill_null(none).to_numpy(zero_copy_only=False)
        return np.searchsorted(np.array(bounds, dtype=np.int64), values, side="right"), values

    @F.arrow_udf("int")
    def part_of(ids: pa.Array) -> pa.Array:
        return pa.array(parts_of(ids)[0].astype(np.int32))

    # One row per range: the id at which it begins.
    heads = {r.part: none if r.head is None else r.head for r in
             rows.select("id").groupBy(part_of("id").alias("part")).agg(F.max("id").alias("head")).collect()}
    order = sorted(heads, reverse=True)
    before = {part: order[i - 1] for i, part in enumerate(order)}  # the first follows the last
    place = pa.struct([("part", pa.int32()), ("halo", pa.int32())])

    @F.arrow_udf("array<struct<part:int,halo:int>>")
    def places(ids: pa.Array) -> pa.Array:
        out = []
        for part, value in zip(*(x.tolist() for x in parts_of(ids)), strict=True):
            own = [{"part": part, "halo": 0}]
            out.append(own + [{"part": before[part], "halo": 1}] if heads[part] == value else own)
        return pa.array(out, type=pa.list_(place))

    return rows.select("id", "text", F.inline(places("id"))) \
        .select("part", "halo", "id", "text") \
        .repartitionById(n, F.col("part")) \
        .sortWithinPartitions("part", "halo", F.desc_nulls_last("id"), "text")


NEXT_SCHEMA = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
               "edited_fingerprint string, near_edited double, near_next double")


def _compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in NEXT_SCHEMA.split(", ")]
    last = None                                # part, id, text, sketch of the row before
    for batch in batches:
        out = []
        for part, halo, key, text in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if halo and (last is None or last[0] != part):
                continue                       # a tie of a halo row that has been used
            mark = sketch(text)
            if last is not None and last[0] == part:
                _, id_before, before, its = last
                other = edited(before, text)
                new = sketch(other)
                out.append((id_before, len(before), hashlib.sha256(other.encode()).hexdigest(),
                            its.tobytes().hex(), new.tobytes().hex(), likeness(its, new),
                            likeness(its, mark)))
            last = None if halo else (part, key, text, mark)
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in out], type=t) for i, t in enumerate(
                [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2])], names=names)


def compare_with_next(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: its fingerprint, that of its text edited by the next document,
    and the likeness to both (``NEXT_SCHEMA``).

    Next is by descending id; the first follows the last, and a single document
    follows itself. Rows that share an id follow each other by text; rows without id
    come last. Null texts are empty. No rows give no rows. Each range of ids is read
    as a stream, so a task holds two texts at a time besides its Arrow batch.
    """
    return _in_line(df, id_col, text_col).mapInArrow(_compare, NEXT_SCHEMA)

"""Quality classifier: hashed word and character n-gram vectors, averaged.

Each feature of a text (a word, a run of 3 to 5 bytes of a word with its edge marks,
or a word n-gram whose first and last word are the same, named by its length alone)
is hashed to one of ``buckets`` learned vectors. A text is the mean of its
feature vectors, followed by a softmax over the labels; vectors and output weights
are trained together by stochastic gradient descent in numpy on a bounded sample
of labelled rows. All rows are then scored on the executors.

The softmax of two labels needs only the difference of their logits, and the mean
is linear, so a fitted model carries one number per bucket: its vector times the
difference of the output weights.
"""

from __future__ import annotations

import math
import uuid
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.llm.common import by_bytes, checkpointed, held, text_runs, utf8_values

#: Lengths of character n-grams; the base of their rolling hash (an odd number).
GRAMS, BASE = (3, 4, 5), np.uint64(0x9E3779B97F4A7C15)
#: Distances at which a word that comes again is a feature.
REPEATS = (1, 2, 3)
#: Words a worker keeps the sums of, the longest kept, bytes of text that are scored
#: together, and bytes of new words whose features are made together.
KEPT, LONGEST, TOGETHER, WORD_BYTES = 100_000, 64, 2 << 20, 128 << 10


@dataclass(frozen=True)
class Settings:
    """``max_rows`` bounds the labelled sample the driver trains on, ``max_features`` the
    distinct features of all its texts (8 bytes each there)."""

    max_rows: int = 4000
    max_features: int = 40_000_000
    buckets: int = 1 << 16
    size: int = 8
    epochs: int = 6
    rate: float = 8.0
    seed: int = 7


@dataclass(frozen=True)
class Model:
    """``weights``: logit difference per bucket; ``bias``: that of an empty text."""

    weights: np.ndarray
    bias: float
    key: str = field(default_factory=lambda: uuid.uuid4().hex)


def word_features(words: list[bytes], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all features of all words, and where each word's begin.

    The words are laid end to end with edge marks; a window that holds the end mark
    of a word before its last byte spans two words and is left out.
    """
    data = np.frombuffer(b"".join([b"<%b>" % w for w in words]), dtype=np.uint8)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 2
    starts = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(words)), sizes)
    code = data.astype(np.uint64) + np.uint64(1)
    owners = [np.arange(len(words))]
    hashes = [np.array([zlib.crc32(w) for w in words], dtype=np.uint64)]
    for n in GRAMS:
        count = len(data) - n + 1
        if count <= 0:
            continue
        rolled = np.full(count, n, dtype=np.uint64)
        for k in range(n):
            rolled = rolled * BASE + code[k:k + count]
        inside = owner[:count] == owner[n - 1:]
        hashes.append(rolled[inside])
        owners.append(owner[:count][inside])
    mixed = np.concatenate(hashes) * BASE
    mixed = (mixed ^ mixed >> np.uint64(32)) * BASE
    bucket = (mixed >> np.uint64(40)) % np.uint64(buckets)
    at = np.concatenate(owners)
    order = np.argsort(at, kind="stable")
    begins = np.searchsorted(at[order], np.arange(len(starts) + 1))
    return bucket[order].astype(np.int32), begins


def repeat_bucket(distance: int, buckets: int) -> int:
    return zlib.crc32(b"again %d" % distance) % buckets


def text_features(data: bytes, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct feature buckets of a text and their shares of all its features."""
    words = data.split()
    if not words:
        return np.empty(0, np.int32), np.empty(0, np.float32)
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    order = np.fromiter(map(number.__getitem__, words), dtype=np.int64, count=len(words))
    bucket, begins = word_features(list(number), buckets)
    weight = np.bincount(bucket, np.repeat(np.bincount(order), np.diff(begins)), buckets)
    for d in REPEATS:
        weight[repeat_bucket(d, buckets)] += np.count_nonzero(order[d:] == order[:-d])
    ids = np.flatnonzero(weight)
    return ids.astype(np.int32), (weight[ids] / weight.sum()).astype(np.float32)


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], settings: Settings = Settings()) -> Model:
    """Fit vectors and softmax on (buckets, shares, label 0 or 1) rows.

    Without rows, or with one label only, the model gives the share of label 1
    (0.5 without rows) to every text.
    """
    labels = [y for *_, y in rows]
    share = (sum(labels) + 0.5) / (len(labels) + 1)
    if len(set(labels)) < 2:
        return Model(np.zeros(settings.buckets), math.log(share / (1 - share)))
    rng = np.random.default_rng(settings.seed)
    vectors = rng.uniform(-1, 1, (settings.buckets, settings.size)).astype(np.float32) / settings.size
    output = np.zeros((2, settings.size), dtype=np.float32)
    bias = np.log(np.array([1 - share, share], dtype=np.float32))
    steps, step = settings.epochs * len(rows), 0
    for _ in range(settings.epochs):
        for r in rng.permutation(len(rows)):
            ids, shares, label = rows[r]
            rate = settings.rate * (1 - step / steps)
            step += 1
            picked = vectors[ids]
            mean = shares @ picked
            logits = output @ mean + bias
            wrong = np.exp(logits - logits.max())
            wrong /= wrong.sum()
            wrong[label] -= 1
            back = wrong @ output
            output -= np.float32(0.1 * rate) * np.outer(wrong, mean)
            bias -= np.float32(0.01 * rate) * wrong
            # Shares are small numbers: steps are scaled by the features' count.
            scaled = shares * np.float32(rate / max(float(shares.max()), 1e-6))
            vectors[ids] = picked - scaled[:, None] * back
    weights = vectors.astype(np.float64) @ (output[1] - output[0]).astype(np.float64)
    return Model(weights, float(bias[1] - bias[0]))


class Scorer:
    """Scores texts by a model; features of words are kept between batches."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.number: dict[bytes, int] = {}
        self.sums = np.empty(0)                # per word: sum over its features
        self.sizes = np.empty(0, dtype=np.int64)
        self.again = [model.weights[repeat_bucket(d, len(model.weights))] for d in REPEATS]

    def _learn(self, new: list[bytes]) -> None:
        at = len(self.number)
        sums, sizes = [self.sums[:at]], [self.sizes[:at]]
        for a, b in by_bytes(map(len, new), WORD_BYTES):
            bucket, begins = word_features(new[a:b], len(self.model.weights))
            sums.append(np.add.reduceat(self.model.weights[bucket], begins[:-1]))
            sizes.append(np.diff(begins))
        self.number.update(zip(new, range(at, at + len(new)), strict=True))
        self.sums, self.sizes = np.concatenate(sums), np.concatenate(sizes)

    def scores(self, texts: list[bytes]) -> list[float]:
        if len(self.number) > KEPT:
            self.number.clear()
        cut = [t.split() for t in texts]
        new = list(set().union(*cut).difference(self.number))
        if new:
            self._learn(new)
        out = []
        for words in cut:
            logit = self.model.bias
            if words:
                order = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
                total, count = self.sums[order].sum(), int(self.sizes[order].sum())
                for d, weight in zip(REPEATS, self.again, strict=True):
                    times = int(np.count_nonzero(order[d:] == order[:-d]))
                    total += times * weight
                    count += times
                logit += total / count
            out.append(1 / (1 + math.exp(-logit)) if logit > -700 else 0.0)
        if any(len(w) > LONGEST for w in new):  # long words are not kept
            self.number.clear()
        return out


def score(text: Column, model: Model) -> Column:
    """Probability of label 1 of each text of a column; null is scored as empty."""

    @F.arrow_udf("double")
    def probability(texts: pa.Array) -> pa.Array:
        scorer, out = held(("quality", model.key), lambda: Scorer(model)), []
        for run in text_runs(texts, TOGETHER):
            out += scorer.scores(run)
        return pa.array(out, type=pa.float64())

    return probability(text)


def held_out(doc_id: Column, folds: int = 3, fold: int = 1) -> Column:
    """Whether a row is kept from training: crc32 of the id as text, modulo folds.
    A row without id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def fit(df: DataFrame, labels: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id",
        text_col: str = "text", label_col: str = "quality") -> Model:
    """Train on at most ``max_rows`` labelled documents that are not held out.

    The sample is that of the smallest hashes of ids: the first ``max_rows`` of them, as
    far as their features add up to ``max_features``. Ids alone are ordered; the chosen
    documents' features are made on the executors and come to the driver as arrays. An id
    labelled twice has the smaller label; of documents that share an id one counts, that
    with the smallest text hash; null labels and ids are left out.
    """
    chosen = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")) \
        .where(F.col("id").isNotNull() & F.col("y").isNotNull() & ~held_out(F.col("id"))) \
        .groupBy("id").agg(F.min("y").alias("y")) \
        .orderBy(F.xxhash64("id"), "id").limit(settings.max_rows)
    chosen = checkpointed(chosen)
    texts = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("h")) \
        .join(F.broadcast(chosen), "id")  # at most max_rows small rows
    one = texts.groupBy("id").agg(F.min("h").alias("h"))   # at most max_rows again
    # Copies are one row before they leave their task.
    rows = texts.join(F.broadcast(one), ["id", "h"]).groupBy("id", "h", "y").agg(F.first("text").alias("text"))
    buckets = settings.buckets
    made = pa.struct([("ids", pa.list_(pa.int32())), ("shares", pa.list_(pa.float32()))])

    @F.arrow_udf("struct<ids:array<int>,shares:array<float>>")
    def features(texts: pa.Array) -> pa.Array:
        got = (text_features(t, buckets) for t in utf8_values(texts))
        return pa.array([{"ids": i, "shares": w} for i, w in got], type=made)

    found = checkpointed(rows.select("id", "y", "h", features("text").alias("f")).select("id", "y", "h", "f.ids", "f.shares"))
    sizes = found.select("id", F.size("ids").alias("n"), F.xxhash64("id").alias("o")).toArrow().to_pylist()
    total, kept = 0, []
    for r in sorted(sizes, key=lambda r: (r["o"], r["id"])):
        total += r["n"]
        if total > settings.max_features:
            break
        kept.append(r["id"])
    if len(kept) < len(sizes):
        few = df.sparkSession.createDataFrame([(i,) for i in kept], found.select("id").schema)
        found = found.join(F.broadcast(few), "id")
    found = found.toArrow()
    made = []                                  # views of the Arrow buffers, in a set order
    for batch in found.to_batches():
        ids, shares, ends = (batch["ids"].values.to_numpy(), batch["shares"].values.to_numpy(),
                             batch["ids"].offsets.to_numpy())
        made += [(key, h, ids[a:b], shares[a:b], int(y == 1)) for key, h, y, a, b in zip(
            *(batch[c].to_pylist() for c in ("id", "h", "y")), ends[:-1], ends[1:], strict=True)]
    made.sort(key=lambda r: r[:2])
    arrays = [r[2:] for r in made]
    return train(arrays, settings)


def score_documents(df: DataFrame, model: Model, text_col: str = "text",
                    out_col: str = "score") -> DataFrame:
    """``df`` with the scores of its texts in ``out_col`` (replaced if it exists).
    Whole texts are scored where they lie: no shuffle."""
    return df.withColumn(out_col, score(F.col(text_col), model))

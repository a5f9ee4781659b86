"""Byte-level BPE encoding and decoding with a rank queue over a bitmap tree.

A pre-token is a linked list of symbols. Every adjacent pair that has a merge rank
is put in the bucket of that rank; a tree of 64-bit words marks the buckets that
hold anything, so the lowest rank is found by a find-first-set on each level. An
entry whose symbols have been merged meanwhile is stale and skipped when it is
taken. A merge costs a constant number of steps besides the sort of its bucket, so a
pre-token of n bytes takes about O(n) however long it is. Many pre-tokens share one
queue, and the entries of a large bucket are merged together.
"""

from __future__ import annotations

import base64
import hashlib
from array import array

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.llm.common import held, text_runs

#: Words a worker keeps the ids of, and the longest it keeps; bytes of text that
#: are encoded together.
KEPT, LONGEST, TOGETHER = 200_000, 64, 2 << 20
#: Entries from which a bucket is merged by numpy; below, one by one.
MANY = 48


class RankQueue:
    """Positions in buckets by rank; the lowest rank that has any is found by a
    find-first-set on each level of a bitmap tree."""

    def __init__(self, ranks: int) -> None:
        self.levels = []
        while True:
            ranks = (ranks + 63) // 64
            self.levels.append([0] * ranks)
            if ranks == 1:
                break
        self.buckets: dict[int, list[int]] = {}

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is not None:
            bucket.append(position)
        else:
            self.open(rank).append(position)

    def open(self, rank: int) -> list[int]:
        """The bucket of a rank, marked in the tree."""
        bucket = self.buckets.get(rank)
        if bucket is None:
            bucket = self.buckets[rank] = []
            at = rank
            for words in self.levels:
                old = words[at >> 6]
                words[at >> 6] = old | 1 << (at & 63)
                if old:
                    break
                at >>= 6
        return bucket

    def lowest(self) -> int:
        """The lowest rank with entries, -1 if there is none."""
        if not self.levels[-1][0]:
            return -1
        at = 0
        for words in reversed(self.levels):
            word = words[at]
            at = at << 6 | (word & -word).bit_length() - 1
        return at

    def take(self, rank: int) -> list[int]:
        """All positions of a rank, ascending; its bucket is closed."""
        at = rank
        for words in self.levels:
            words[at >> 6] &= ~(1 << (at & 63))
            if words[at >> 6]:
                break
            at >>= 6
        return sorted(self.buckets.pop(rank))


class _Symbols:
    """Linked symbols of pre-tokens laid end to end. The same memory is read by
    position (arrays) and by bucket (numpy views, ``v``)."""

    def __init__(self, text: np.ndarray, stops: np.ndarray, byte_ids: np.ndarray, first: np.ndarray) -> None:
        n = len(text)
        kinds = {"ids": byte_ids[text], "ends": np.arange(1, n + 1), "before": np.arange(-1, n - 1),
                 "pair": np.append(first, -1)}   # id, end, start of the one before, rank with the next
        self.v = {}
        for name, values in kinds.items():
            cells = array("i", values.astype(np.int32).tobytes())
            setattr(self, name, cells)
            self.v[name] = np.frombuffer(cells, dtype=np.int32)
        for name, size in (("alive", n), ("edge", n + 1)):
            cells = bytearray(size)
            setattr(self, name, cells)
            self.v[name] = np.frombuffer(cells, dtype=np.uint8)
        self.v["alive"][:] = 1
        self.v["edge"][0] = 1
        self.v["edge"][stops] = 1


class Bpe:
    """A vocabulary of ranked byte strings and the pattern that cuts pre-tokens."""

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b)
                          for a, b in (line.split() for line in lines if line.strip())}
        self.tokens = {i: t for t, i in self.ranks.items()}
        if max(self.tokens) >= 1 << 20:
            raise ValueError("ranks of 20 bits at most")
        get = self.ranks.get
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)])
        self.byte_pairs = np.array([get(bytes([a, b]), -1) for a in range(256) for b in range(256)])
        # Rank of two symbols put together, by their ids: every way to cut a token.
        self.pairs = {}
        for token, rank in self.ranks.items():
            for i in range(1, len(token)):
                a, b = get(token[:i]), get(token[i:])
                if a is not None and b is not None:
                    self.pairs[a << 20 | b] = rank
        keys = np.array(sorted(self.pairs), dtype=np.int64)
        self.pair_keys, self.pair_ranks = keys, np.array([self.pairs[k] for k in keys.tolist()], dtype=np.int64)
        self.pattern = regex.compile(pattern)
        # What a space is to the pattern: a cut before the last space of a run of
        # white space is a cut between pre-tokens.
        self.words = regex.compile(r" (?=\S)")
        self.odd_space = regex.compile(r" (?:\s|$)")
        self.queue = RankQueue(max(self.ranks.values()) + 1)
        self.heads: dict[str, bytes] = {}      # packed ids of first words of texts,
        self.spaced: dict[str, bytes] = {}     # and of a space and a word

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Packed ids of each pre-token. All share one queue, laid end to end; no
        pair reaches over the edge between two. A symbol's id is its own rank."""
        if not pieces:
            return []
        queue, text = self.queue, np.frombuffer(b"".join(pieces), dtype=np.uint8)
        stops = np.cumsum([len(p) for p in pieces])
        first = self.byte_pairs[text[:-1].astype(np.int64) << 8 | text[1:]]
        first[stops[:-1] - 1] = -1
        s = _Symbols(text, stops, self.byte_ids, first)
        self._push_all(first, np.arange(len(first)))
        while (rank := queue.lowest()) >= 0:
            bucket = queue.take(rank)
            if len(bucket) < MANY or not self._merge_bucket(s, rank, bucket):
                self._merge_each(s, rank, bucket)
        left = s.v["alive"].astype(bool)
        packed = s.v["ids"][left].astype("<i4").tobytes()
        at = [0, *(4 * np.cumsum(left)[stops - 1]).tolist()]
        return [packed[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]

    def _merge_each(self, s: _Symbols, rank: int, bucket: list[int]) -> None:
        """Merge the pairs of a bucket from left to right. If that makes a pair of a
        lower rank, the rest of the bucket goes back into the queue."""
        pairs, push = self.pairs, self.queue.push
        ids, ends, before, pair, alive, edge = s.ids, s.ends, s.before, s.pair, s.alive, s.edge
        for done, i in enumerate(bucket, 1):
            if pair[i] != rank:
                continue                       # stale: its symbols were merged
            middle = ends[i]
            end = ends[i] = ends[middle]
            alive[middle] = 0
            ids[i] = rank
            pair[middle] = pair[i] = -1
            below = False
            if not edge[end]:
                before[end] = i
                made = pairs.get(rank << 20 | ids[end], -1)
                if made >= 0:
                    pair[i] = made
                    push(made, i)
                    below = made < rank
            if not edge[i]:
                left = before[i]
                pair[left] = made = pairs.get(ids[left] << 20 | rank, -1)
                if made >= 0:
                    push(made, left)
                    below = below or made < rank
            if below and done < len(bucket):
                self.queue.open(rank).extend(bucket[done:])
                return

    def _merge_bucket(self, s: _Symbols, rank: int, bucket: list[int]) -> bool:
        """Merge all pairs of a bucket at once, where the order makes no difference.
        False, with nothing done, if a pair of a lower rank would come up between."""
        v = s.v
        ids, ends, before, pair, edge = v["ids"], v["ends"], v["before"], v["pair"], v["edge"]
        at = np.array(bucket)
        at = at[pair[at] == rank]
        if not len(at):
            return True
        at = at[np.append(True, at[1:] != at[:-1])]
        # Of pairs that overlap in a run (aaaa), every second one is merged.
        chained = np.append(False, ends[at[:-1]] == at[1:])
        if chained.any():
            index = np.arange(len(at))
            at = at[(index - np.maximum.accumulate(np.where(chained, 0, index))) % 2 == 0]
        middle = ends[at]
        end = ends[middle]
        old = ids[at]
        inner = ~edge[end].astype(bool)
        touching = np.flatnonzero(end[:-1] == at[1:])
        touching = touching[inner[touching]]
        between = self._ranks(np.full(len(touching), rank), old[touching + 1])
        if ((between >= 0) & (between < rank)).any():
            return False
        ids[at] = rank
        right = np.full(len(at), -1, dtype=np.int64)
        right[inner] = self._ranks(np.full(inner.sum(), rank), ids[end[inner]])
        has_left = ~edge[at].astype(bool)
        # The one before is a symbol merged just now where its end is here.
        prior = before[at]
        prior[touching + 1] = at[touching]
        lefts = prior[has_left]
        left = self._ranks(ids[lefts], np.full(len(lefts), rank))
        if ((right >= 0) & (right < rank)).any() or ((left >= 0) & (left < rank)).any():
            ids[at] = old
            return False
        v["alive"][middle] = 0
        ends[at] = end
        pair[middle] = -1
        before[end[inner]] = at[inner]
        pair[lefts] = left
        pair[at] = right
        places = np.concatenate([lefts, at])
        made = np.concatenate([left, right])
        keep = pair[places] == made            # a left one may itself have been merged
        self._push_all(made[keep], places[keep])
        return True

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids put together, -1 where there is none."""
        keys = a.astype(np.int64) << 20 | b
        at = np.searchsorted(self.pair_keys, keys)
        at[at == len(self.pair_keys)] = 0
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], -1)

    def _push_all(self, ranks: np.ndarray, places: np.ndarray) -> None:
        some = ranks >= 0
        ranks, places = ranks[some], places[some]
        order = np.argsort(ranks, kind="stable")
        found, starts = np.unique(ranks[order], return_index=True)
        sorted_places = places[order].tolist()
        stops = [*starts[1:].tolist(), len(sorted_places)]
        for rank, a, b in zip(found.tolist(), starts.tolist(), stops):
            self.queue.open(rank).extend(sorted_places[a:b])

    def _learn(self, known: dict[str, bytes], words: set[str], lead: str) -> list[str]:
        """Put the packed ids of ``lead + word`` into ``known``; the new words."""
        new = list(words.difference(known))
        cut = [self.pattern.findall(lead + w) for w in new]
        pieces = list({p for found in cut for p in found})
        get = dict(zip(pieces, self.merge([p.encode() for p in pieces]), strict=True)).__getitem__
        known.update((w, b"".join(map(get, found))) for w, found in zip(new, cut, strict=True))
        return new

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of whole texts, without special tokens.

        A text is cut before each space that a non-space follows, which is always
        an edge between pre-tokens; ids of such words are kept for later texts and
        dropped when they have outgrown ``KEPT`` (nothing depends on it but time).
        """
        if len(self.spaced) + len(self.heads) > KEPT:
            self.spaced.clear()
            self.heads.clear()
        cut = [self.words.split(t) if self.odd_space.search(t) else t.split(" ") for t in texts]
        heads = [words.pop(0) for words in cut]
        new = [(self.heads, self._learn(self.heads, set(heads), "")),
               (self.spaced, self._learn(self.spaced, set().union(*cut), " "))]
        out = [np.frombuffer(b"".join([self.heads[head], *map(self.spaced.__getitem__, words)]), "<i4")
               for head, words in zip(heads, cut, strict=True)]
        for kept, words in new:
            for long in [w for w in words if len(w) > LONGEST]:
                del kept[long]
        return out

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def vocabulary(path: str, pattern: str) -> Bpe:
    """The vocabulary, read once per Python worker. ``path`` is on every machine."""
    return held(("bpe", path, pattern), lambda: Bpe(path, pattern))


def encode(text: Column, path: str, pattern: str) -> Column:
    """Token ids of a text column as array<int>; null and empty texts: no ids."""

    @F.arrow_udf("array<int>")
    def ids(texts: pa.Array) -> pa.Array:
        return _id_lists(_encoded(texts, vocabulary(path, pattern)))

    return ids(text)


def _encoded(texts: pa.Array, bpe: Bpe) -> list[np.ndarray]:
    return [r for run in text_runs(texts, TOGETHER)
            for r in bpe.encode([t.decode("utf-8", "replace") for t in run])]


def _id_lists(rows: list[np.ndarray]) -> pa.ListArray:
    offsets = np.zeros(len(rows) + 1, dtype=np.int32)
    np.cumsum([len(r) for r in rows], out=offsets[1:])
    flat = np.concatenate(rows) if rows else np.empty(0, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, type=pa.int32()))


def round_trip(text: Column, path: str, pattern: str) -> Column:
    """struct<ids, ids_sha256, sha256>: token ids of a text column, the lower-case hex
    SHA-256 of the ids as little-endian unsigned 32-bit integers, and that of the bytes
    that the ids give back. All fields come from one encoding of each text."""

    @F.arrow_udf("struct<ids:array<int>,ids_sha256:string,sha256:string>")
    def both(texts: pa.Array) -> pa.Array:
        bpe = vocabulary(path, pattern)
        rows = _encoded(texts, bpe)
        digests = [hashlib.sha256(r.astype("<u4").tobytes()).hexdigest() for r in rows]
        decoded = [hashlib.sha256(bpe.decode(r.tolist())).hexdigest() for r in rows]
        return pa.StructArray.from_arrays(
            [_id_lists(rows), *(pa.array(x, type=pa.string()) for x in (digests, decoded))],
            ["ids", "ids_sha256", "sha256"])

    return both(text)


def _rows(ids: pa.Array):
    flat, ends = ids.values.to_numpy(zero_copy_only=False), ids.offsets.to_numpy()
    for a, b in zip(ends[:-1], ends[1:], strict=True):
        yield flat[a:b]


def decode(ids: Column, path: str, pattern: str) -> Column:
    """Bytes of an array of token ids; null or no ids: no bytes. Ids outside the
    vocabulary raise ``KeyError``."""

    @F.arrow_udf("binary")
    def data(column: pa.Array) -> pa.Array:
        bpe = vocabulary(path, pattern)
        return pa.array([bpe.decode(r.tolist()) for r in _rows(column)], type=pa.binary())

    return data(ids)


def id_digest(ids: Column) -> Column:
    """Lower-case hex SHA-256 of ids as little-endian unsigned 32-bit integers."""

    @F.arrow_udf("string")
    def digest(column: pa.Array) -> pa.Array:
        return pa.array([hashlib.sha256(r.astype("<u4").tobytes()).hexdigest()
                         for r in _rows(column)], type=pa.string())

    return digest(ids)


def encode_documents(df: DataFrame, path: str, pattern: str, text_col: str = "text",
                     out_col: str = "ids") -> DataFrame:
    """``df`` with the ids of its texts in ``out_col`` (replaced if it exists).

    Rows are encoded alone, whole, wherever they lie: no shuffle. Each further Python
    function of ``out_col`` in one plan encodes the texts anew: use ``round_trip`` for
    digests, or write the ids first.
    """
    return df.withColumn(out_col, encode(F.col(text_col), path, pattern))

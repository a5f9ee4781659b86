"""Words and word windows of texts as 64-bit hashes, made with numpy inside tasks."""

from __future__ import annotations

import numpy as np
import xxhash

from driftline.llm.common import held

_ODD = np.uint64(0x9E3779B97F4A7C15)  # fixed value: an odd multiplier
#: Words a worker keeps the hashes of.
KEPT = 100_000


class WordHashes(dict):
    """64-bit hash of a word's bytes, made when first asked for."""

    def __missing__(self, word: bytes) -> int:
        got = xxhash.xxh64_intdigest(word, 1)
        if len(word) <= 64:
            self[word] = got
        return got


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(32)) * _ODD
    x = (x ^ x >> np.uint64(29)) * _ODD
    return x ^ x >> np.uint64(32)


def word_hashes(text: bytes) -> np.ndarray:
    """Hash of each word: the runs of bytes between ASCII white space."""
    hashes = held("words", WordHashes)
    if len(hashes) > KEPT:
        hashes.clear()
    words = text.split()
    return np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words))


def window_hashes(words: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """Hash of each run of n consecutive words, by the position it starts at.

    Doubling: the hash of 2k words is made of the hashes of its two halves, so a
    window costs the logarithm of its length.
    """
    count = len(words) - n + 1
    if count <= 0:
        return np.empty(0, dtype=np.uint64)
    step = mix(words + np.uint64(seed))
    size, out, done = 1, None, 0
    while True:
        if n & size:
            part = step[done:done + count]
            out = part.copy() if out is None else mix(out * _ODD + part)
            done += size
        if size * 2 > n:
            return out
        step = mix(step[:-size] * _ODD + step[size:])
        size *= 2


_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def shingles(text: bytes, n: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the n-word shingles of a text, A-Z lower-cased. With
    fewer words the whole sequence is one; without words there is none."""
    words = word_hashes(text.translate(_LOWER))
    if not len(words):
        return words
    return np.unique(window_hashes(words, min(n, len(words)), len(words) if len(words) < n else n))

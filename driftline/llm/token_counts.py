"""Token counts: batches go through a tokenizer inside Arrow functions and only
lengths come back.

Texts are split at ASCII white space, which is a safe boundary for a tokenizer
that drops white space: no token, merge, normal form or special string reaches
over it. So a text of any length is counted in pieces, and equal pieces of a
worker's batches are encoded once. Encoder batches hold about equal numbers of
bytes, whatever the lengths of the texts.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.llm.common import by_bytes, held, text_runs

#: Pieces a worker keeps the counts of, the longest it keeps, and the bytes of
#: texts and of pieces that are handled together.
KEPT, LONGEST, TEXT_BYTES, PIECE_BYTES = 300_000, 64, 4 << 20, 256 << 10


class Counter:
    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.kept: dict[bytes, int] = {}
        apart = [len(e) for e in self._encode(["a", "'s b", "a 's\n b", " "])]
        if apart[0] + apart[1] != apart[2] or apart[3]:
            raise ValueError(f"{path} does not drop white space: texts can't be split there")

    def _encode(self, texts: list[str]):
        return self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)

    def counts(self, texts: list[bytes]) -> list[int]:
        if len(self.kept) > KEPT:
            self.kept.clear()
        cut = [t.split() for t in texts]       # bytes: ASCII white space only
        kept = self.kept
        new = list(set().union(*cut).difference(kept))
        for a, b in by_bytes(map(len, new), PIECE_BYTES):
            some = new[a:b]
            made = self._encode([w.decode("utf-8", "replace") for w in some])
            kept.update(zip(some, map(len, made), strict=True))
        get = kept.__getitem__
        out = [sum(map(get, words)) for words in cut]
        for word in new:
            if len(word) > LONGEST:
                del kept[word]
        return out


def counter(path: str) -> Counter:
    """The tokenizer, read once per Python worker. ``path`` is on every machine."""
    return held(("token_counts", path), lambda: Counter(path))


def count_tokens(text: Column, path: str) -> Column:
    """Number of tokens of a text column as bigint, without begin, end or added
    special tokens; null and empty texts have 0. Special strings inside a text are
    handled as the tokenizer does by default."""

    @F.arrow_udf("bigint")
    def lengths(texts: pa.Array) -> pa.Array:
        count, out = counter(path).counts, []
        for run in text_runs(texts, TEXT_BYTES):
            out += count(run)
        return pa.array(np.array(out, dtype=np.int64))

    return lengths(text)


def count_documents(df: DataFrame, path: str, text_col: str = "text",
                    out_col: str = "n_tokens") -> DataFrame:
    """``df`` with token counts in ``out_col`` (a column of that name is replaced).
    Rows are counted where they lie: no shuffle."""
    return df.withColumn(out_col, count_tokens(F.col(text_col), path))

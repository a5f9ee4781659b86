"""Sharding by jump consistent hashing.

A key's shard follows from the key and the shard count alone: no ring or table is
kept. When a shard is appended, a key either stays or moves to the new shard, and
1/(n+1) of all keys move. Slots number the rows of a shard from 0 without gaps, in
order of the key, by counting per range of keys first: no shard is ever sorted or
numbered in one task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftline.llm.common import free_name, partitions, range_bounds

#: Fixed value: the multiplier of the published jump hash.
MULTIPLIER = 2862933555777941757


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each unsigned 64-bit key, 0 to ``shards - 1``."""
    keys = keys.astype(np.uint64)
    home = np.zeros(len(keys), dtype=np.int64)
    active = np.arange(len(keys))
    while len(active):
        keys[active] = keys[active] * np.uint64(MULTIPLIER) + np.uint64(1)
        step = ((keys[active] >> np.uint64(33)) + np.uint64(1)).astype(np.float64)
        jump = ((home[active] + 1) * (float(1 << 31) / step)).astype(np.int64)
        inside = jump < shards
        active = active[inside]
        home[active] = jump[inside]
    return home


def shard_of(key: Column, shards: int) -> Column:
    """Shard of an integer key column; a null key has key 0's shard."""
    if shards < 1:
        raise ValueError("shards must be at least 1")

    @F.arrow_udf("int")
    def shard(keys: pa.Array) -> pa.Array:
        whole = keys.cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False)
        return pa.array(jump_hash(whole.view(np.uint64), shards).astype(np.int32))

    return shard(key.cast("bigint"))


def _bucket_of(key: Column, bounds: list[int]) -> Column:
    """Which of the ranges between the cut points a key is in; null is below all."""

    @F.arrow_udf("int")
    def bucket(keys: pa.Array) -> pa.Array:
        whole = keys.cast(pa.int64())
        at = np.searchsorted(np.array(bounds, dtype=np.int64),
                             whole.fill_null(0).to_numpy(zero_copy_only=False), side="right") + 1
        at[whole.is_null().to_numpy(zero_copy_only=False)] = 0
        return pa.array(at.astype(np.int32))

    return bucket(key.cast("bigint"))


def assign(df: DataFrame, shards: int, key_col: str = "doc_id", ties: list[Column] | None = None,
           shard_col: str = "shard", slot_col: str = "slot", ranges: int | None = None) -> DataFrame:
    """``df`` with ``shard_col`` and ``slot_col`` (columns of those names are replaced).

    Slots go by key, null first, then by ``ties``; rows equal in all of these are
    numbered in no set order. The key is meant to be near unique: all rows of one
    key share a shard and a range. Give a narrow frame: its rows are shuffled once.
    ``ranges`` (default: the session's shuffle partitions) sets only how the work is
    split; the shard and slot of a row do not depend on it.
    """
    spark = df.sparkSession
    ranges = ranges or partitions(spark)
    bounds = range_bounds(df, key_col, ranges)
    df = df.drop(*[c for c in df.columns if c.lower() in (shard_col.lower(), slot_col.lower())])
    part, before, nth = (free_name(df, s) for s in ("_range", "_before", "_nth"))
    key = F.col(key_col)
    placed = df.select("*", shard_of(key, shards).alias(shard_col),
                       _bucket_of(key, bounds).alias(part))
    # One row per shard and range of keys: at most shards x (ranges + 1) rows.
    counts = placed.groupBy(shard_col, part).agg(F.count("*").alias(nth))
    running = Window.partitionBy(shard_col).orderBy(part).rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = counts.select(shard_col, part, F.coalesce(F.sum(nth).over(running), F.lit(0))
                            .alias(before))
    within = Window.partitionBy(shard_col, part).orderBy(key, *(ties or []))
    return placed.withColumn(nth, F.row_number().over(within)) \
        .join(F.broadcast(offsets), [shard_col, part]) \
        .withColumn(slot_col, (F.col(before) + F.col(nth) - 1).cast("bigint")) \
        .drop(part, before, nth)


def write_shards(df: DataFrame, path: str, shards: int, key_col: str = "doc_id",
                 shard_col: str = "shard") -> None:
    """Write ``df`` as one Parquet folder per shard, in as many files as its
    partitions hold of the shard: nothing is gathered per shard."""
    df.drop(shard_col).withColumn(shard_col, shard_of(F.col(key_col), shards)) \
        .write.partitionBy(shard_col).mode("overwrite").parquet(path)

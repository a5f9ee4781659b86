"""Helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import wraps

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.session import ensure_checkpoint_dir, shuffle_partitions


#: Rows of an Arrow batch: texts are large rows, and a batch is held on both sides.
BATCH_ROWS = 2000


def in_text_batches(run):
    """A query or stage (spark, ...) that runs with Arrow batches for texts."""

    @wraps(run)
    def wrapped(spark: SparkSession, *rest):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
        return run(spark, *rest)

    return wrapped


_HELD: dict = {}


def held(key, make):
    """A worker's table for ``key``, made once and shared by its tasks. Asking for
    another drops it: a worker holds the tables of one operator at a time."""
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = make()
    return _HELD[key]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that no column of ``df`` has, compared without case."""
    taken = {c.lower() for c in df.columns}
    name, n = stem, 0
    while name.lower() in taken:
        n += 1
        name = f"{stem}_{n}"
    return name


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it from there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Rows of a few numbers each that may be broadcast; larger sides are shuffled.
BROADCAST_ROWS = 200_000


def small(df: DataFrame) -> DataFrame:
    """A checkpointed frame of narrow rows, marked for broadcast if it is counted to
    be small."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def partitions(spark: SparkSession) -> int:
    """Partitions of an explicit repartition: the session's shuffle setting."""
    return max(1, shuffle_partitions(spark))


def utf8_values(column: pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of each text of an Arrow column, null as empty.

    Reads the Arrow buffers, so no Python string is made on the way.
    """
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    for v in column.cast(kind):
        yield v.as_py() or b""


def text_runs(column: pa.Array, most: int) -> Iterator[list[bytes]]:
    """The texts of an Arrow column as UTF-8, in runs of about ``most`` bytes."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
    for a, b in by_bytes(sizes, most):
        yield list(utf8_values(column[a:b]))


def by_bytes(sizes: Iterable[int], most: int) -> Iterator[tuple[int, int]]:
    """Cut a sequence of sizes into runs [start, end) of about ``most`` bytes."""
    start = total = 0
    end = 0
    for end, size in enumerate(sizes, 1):
        total += size
        if total >= most:
            yield start, end
            start, total = end, 0
    if start < end:
        yield start, end


def range_bounds(df: DataFrame, column: str, n: int) -> list[int]:
    """At most ``n - 1`` ascending cut points that split an integer column into
    buckets of about equal row counts (a sketch per partition, merged; only the
    cut points reach the driver). The cuts are approximate; what they cut is not.
    """
    probs = [i / n for i in range(1, n)]
    got = df.select(F.col(column).cast("double").alias("v")).where("v IS NOT NULL") \
        .approxQuantile("v", probs, 1.0 / (4 * n)) if probs else []
    return sorted({int(x) for x in got})

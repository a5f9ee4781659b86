"""Drift of windows that are still open, and rows that come too late.

The append-mode streams of ``drift`` say nothing of a window before it closes, and Spark
drops what arrives after that without a word. Here each (window, column) is one state of
counts with an event-time timer at the window's end. A micro-batch that touches an open
window gives its provisional row; the timer gives the final one and clears the state; rows
of a closed window are counted as late and change nothing.

Before the shuffle every task adds its rows up by (window, column, bin or category), so a
window with a third of the rows sends as little as any other. The watermark is kept on a
column of its own that goes no further: Spark's filter on it would drop the late rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.exprs import as_category
from ..operators.drift import column_kinds
from .drift import _report, coded_rows, fit_baseline, fit_category_baseline, window_chi_square, window_psi

OPEN, CLOSED, LATE = "open", "closed", "late"

_PARTIAL = "window_start timestamp, window_end timestamp, column string, code int, category string, cnt bigint"
_STATE = "code int, category string"
_COUNTS = _PARTIAL + ", phase string"


def _added_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a task counted by all their columns, batch by batch."""
    for batch in batches:
        keys = batch.schema.names
        counted = pa.Table.from_batches([batch]).group_by(keys).aggregate([([], "count_all")])
        counted = counted.rename_columns({"count_all": "cnt"}).select([*keys, "cnt"])
        yield from counted.combine_chunks().to_batches()


class _WindowCounts(StatefulProcessor):
    """Counts of one (window, column): provisional while open, final at the timer."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counts = handle.getMapState("counts", _STATE, "cnt bigint")
        self.end = handle.getValueState("end", "ms bigint")

    def _frame(self, key, end, rows: list, phase: str) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=["code", "category", "cnt"])
        out["code"] = out["code"].astype("Int32")
        out.insert(0, "column", key[1])
        out.insert(0, "window_end", pd.Timestamp(end))
        out.insert(0, "window_start", pd.Timestamp(key[0]))
        out["phase"] = phase
        return out

    def _held(self) -> list:
        return [(*cell, count[0]) for cell, count in self.counts.iterator()]

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        got = pd.concat(list(rows))
        end = got["window_end"].iloc[0]
        ms = int(end.tz_localize("UTC").timestamp() * 1000) if end.tzinfo is None else int(end.timestamp() * 1000)
        if ms <= timerValues.getCurrentWatermarkInMs():
            yield self._frame(key, end, [(None, None, int(got["cnt"].sum()))], LATE)
            return
        for code, category, cnt in zip(got["code"], got["category"], got["cnt"], strict=True):
            cell = (None if pd.isna(code) else int(code), None if pd.isna(category) else category)
            old = self.counts.getValue(cell)[0] if self.counts.containsKey(cell) else 0
            self.counts.updateValue(cell, (old + int(cnt),))
        if not self.end.exists():
            self.end.update((ms,))
            self.handle.registerTimer(ms)
        yield self._frame(key, end, self._held(), OPEN)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.end.exists():
            end = pd.Timestamp(self.end.get()[0], unit="ms")
            yield self._frame(key, end, self._held(), CLOSED)
            self.counts.clear()
            self.end.clear()

    def close(self) -> None:
        pass


@contextmanager
def _rocksdb(spark: SparkSession):
    """Timers and map states need this state store; a query keeps what it started with."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def open_windows_stream(stream: DataFrame, ts_col: str, base: DataFrame, sink_path: str, checkpoint: str,
                        id_cols: Sequence[str] = (), window: str = "1 day", watermark: str = "1 hour",
                        method: str = "exact", available_now: bool = True):
    """Start the report of open and closed windows. Each micro-batch writes its own
    ``epoch=<id>`` folder (overwritten on a retry) of rows in the report's columns plus
    ``phase`` (open, closed, late) and ``late_rows``; ``current_windows`` reads them."""
    cols = [c for c in base.columns if c != ts_col and c not in set(id_cols)]
    num, cat = column_kinds(base, cols)
    edges, bins = fit_baseline(base, num, method) if num else (None, None)
    bins = bins.cache() if num else None
    categories = fit_category_baseline(base, cat).cache() if cat else None
    timed = stream.select(F.col(ts_col).cast("timestamp").alias("_ts"), *num, *[as_category(c).alias(c) for c in cat]) \
        .withColumn("_event_time", F.col("_ts")).withWatermark("_event_time", watermark).drop("_event_time")
    parts = []
    if num:
        parts.append(coded_rows(timed, num, edges, ids=["_ts"]).withColumn("category", F.lit(None).cast("string")))
    if cat:
        parts.append(timed.unpivot(["_ts"], list(cat), "column", "category")
                     .select("_ts", "column", F.lit(None).cast("int").alias("code"), "category"))
    long = parts[0].unionByName(parts[1]) if len(parts) == 2 else parts[0]
    placed = long.where("_ts IS NOT NULL").withColumn("_w", F.window("_ts", window)) \
        .select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), "column", "code", "category")
    counts = placed.mapInArrow(_added_up, _PARTIAL).groupBy("window_start", "column") \
        .transformWithStateInPandas(_WindowCounts(), _COUNTS, "append", "eventtime")

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        held = batch.persist()
        keys = ["window_start", "window_end", "column"]
        try:
            parts = []
            for phase in (OPEN, CLOSED):
                of = held.where(F.col("phase") == phase).withColumnRenamed("cnt", "a_cnt")
                psi = window_psi(of.where("code IS NOT NULL").select(*keys, "code", "a_cnt"), bins) if num else None
                chi = window_chi_square(of.where("category IS NOT NULL").select(*keys, "category", "a_cnt"), categories) if cat else None
                n_new = of.groupBy(*keys).agg(F.sum("a_cnt").alias("rows"))
                parts.append(_report(psi, chi).join(n_new, keys).withColumn("phase", F.lit(phase)))
            late = held.where(F.col("phase") == LATE).groupBy(*keys).agg(F.sum("cnt").alias("late_rows"))
            out = parts[0].unionByName(parts[1]).withColumn("late_rows", F.lit(0).cast("bigint")) \
                .unionByName(late.withColumn("phase", F.lit(LATE)), allowMissingColumns=True)
            out.write.mode("overwrite").parquet(f"{sink_path.rstrip('/')}/epoch={epoch_id}")
        finally:
            held.unpersist()

    writer = counts.writeStream.outputMode("append").foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    with _rocksdb(stream.sparkSession):
        return writer.start()


def current_windows(spark: SparkSession, sink_path: str) -> DataFrame:
    """One row per (window, column) as it stands: its last report, the phase it is in,
    and all rows that came late for it."""
    rows = spark.read.parquet(sink_path)
    keys = ["window_start", "window_end", "column"]
    late = rows.groupBy(*keys).agg(F.sum("late_rows").alias("late_rows"))
    last = Window.partitionBy(*keys).orderBy(F.desc("epoch"), F.asc("phase"))   # closed before open
    stands = rows.where(F.col("phase") != LATE).withColumn("_at", F.row_number().over(last)).where("_at = 1")
    return stands.drop("_at", "epoch", "late_rows").join(late, keys)

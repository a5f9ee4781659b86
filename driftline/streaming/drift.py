"""Drift per event-time window against a fixed baseline.

The baseline is static: its bin edges and bin counts are fitted once. The
arriving rows are binned against the same edge table (a stream-static
broadcast join, one row per column) and counted per (window, column, bin):
that count is the only streaming state. With a
watermark and append mode a window is emitted once, when it has closed; each
micro-batch then turns its closed windows into PSI rows. The batch form runs
the same code on a static frame.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import as_category, clip_share, parse_double, psi_status
from ..operators.drift import (BASE, SIDE, BinEdges, chi_square_finish, chi_square_stats,
                               code_from_table, column_kinds, histogram, is_numeric_type, to_long)

#: Code of a value that is no number, in a column that is numeric in the baseline.
MISFIT = -3


def fit_baseline(base: DataFrame, cols: Sequence[str], method: str = "exact"):
    """(edges, baseline bin counts (column, code, e_cnt))."""
    edges = BinEdges.fit(to_long(base, cols), cols, method=method)
    sides = base.select(F.lit(BASE).alias(SIDE), *cols)
    counts = (histogram(sides, cols, edges)
              .where(F.col("code") >= 0)
              .select("column", "code", F.col("cnt").alias("e_cnt")))
    return edges, counts


def coded_rows(df: DataFrame, cols: Sequence[str], edges: BinEdges, ids: Sequence[str]) -> DataFrame:
    """(ids..., column, code) of columns that are numeric in the baseline, whatever they
    are here: text is parsed, and what does not parse (or has no number in it, such as a
    date) gets the code ``MISFIT`` and neither stops the job nor turns into a null."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    cells = []
    for c in cols:
        if is_numeric_type(kinds[c]):
            value, misfit = F.col(c).cast("double"), F.lit(False)
        else:
            text = F.col(c).cast("string") if kinds[c].simpleString() == "string" else F.lit(None).cast("string")
            value = parse_double(text)
            misfit = F.col(c).isNotNull() & value.isNull()
        cells.append(F.struct(value.alias("value"), misfit.alias("misfit")).alias(c))
    long = df.select(*ids, *cells).unpivot(list(ids), list(cols), "column", "cell") \
        .select(*ids, "column", "cell.*")
    joined = long.join(F.broadcast(edges.table(df.sparkSession)), "column", "left")
    code = F.when(F.col("misfit"), F.lit(MISFIT)).otherwise(code_from_table("value", edges.bins))
    return joined.select(*ids, "column", code.alias("code"))


def window_counts(df: DataFrame, ts_col: str, cols: Sequence[str], edges: BinEdges,
                  window: str = "1 day", watermark: str | None = None) -> DataFrame:
    """(window_start, window_end, column, code, a_cnt); works on a stream.

    Event time must be a TIMESTAMP (a watermark on TIMESTAMP_NTZ is refused),
    so NTZ input is cast in the session time zone.
    """
    ts = F.col(ts_col)
    if dict(df.dtypes)[ts_col] == "timestamp_ntz":
        ts = ts.cast("timestamp")
    timed = df.select(ts.alias("_ts"), *cols)
    if watermark:
        timed = timed.withWatermark("_ts", watermark)
    # Stream-static broadcast join with the fixed edge table.
    long = coded_rows(timed, cols, edges, ids=["_ts"])
    return (long.groupBy(F.window("_ts", window).alias("w"), "column", "code")
                .agg(F.count(F.lit(1)).alias("a_cnt"))
                .select(F.col("w.start").alias("window_start"),
                        F.col("w.end").alias("window_end"), "column", "code", "a_cnt"))


def window_psi(counts: DataFrame, base_counts: DataFrame) -> DataFrame:
    """PSI per (window, column) from window counts and the baseline counts.

    Works on small frames: one row per (window, column, bin). Bins empty in
    a window but filled in the baseline still count (share clipped to 1e-6),
    so every window is paired with all baseline bins of its column. A window with values
    that are no number (``n_misfit``) has no PSI and the status ``type_mismatch``.
    """
    keys = ["window_start", "window_end", "column"]
    # Every window of a column counts, also one whose values are all null or NaN.
    n_new = counts.groupBy(*keys).agg(
        F.sum(F.when(F.col("code") >= -1, F.col("a_cnt")).otherwise(0)).alias("n_new"),
        F.sum(F.when(F.col("code") == MISFIT, F.col("a_cnt")).otherwise(0)).alias("n_misfit"))
    in_range = counts.where(F.col("code") >= 0)
    # Baseline bins: at most bins x columns rows, safe to broadcast.
    grid = n_new.select(*keys).join(F.broadcast(base_counts), "column")
    cells = grid.join(in_range, keys + ["code"], "full_outer")
    cells = cells.select(*keys, "code", F.coalesce("e_cnt", F.lit(0)).alias("e_cnt"),
                         F.coalesce("a_cnt", F.lit(0)).alias("a_cnt"))
    w = Window.partitionBy(*keys)
    e = clip_share(F.col("e_cnt"), F.sum("e_cnt").over(w))
    a = clip_share(F.col("a_cnt"), F.sum("a_cnt").over(w))
    per = cells.select(*keys, ((a - e) * F.log(a / e)).alias("term"),
                       F.col("e_cnt"))
    agg = per.groupBy(*keys).agg(F.sum("term").alias("psi"), F.sum("e_cnt").alias("n_base"))
    out = n_new.join(agg, keys, "left")
    psi = F.when((F.col("n_misfit") == 0) & (F.col("n_new") > 0) & (F.coalesce(F.col("n_base"), F.lit(0)) > 0),
                 F.coalesce(F.col("psi"), F.lit(0.0)))
    status = F.when(F.col("n_misfit") > 0, F.lit("type_mismatch")).otherwise(psi_status(F.col("psi")))
    return out.select(*keys, F.col("n_new").cast("long").alias("n_new"), F.col("n_misfit").cast("long").alias("n_misfit"),
                      psi.alias("psi")).withColumn("status", status)


def drift_by_window_batch(df: DataFrame, ts_col: str, cols: Sequence[str],
                          base: DataFrame, window: str = "1 day",
                          method: str = "exact") -> DataFrame:
    edges, base_counts = fit_baseline(base, cols, method)
    return window_psi(window_counts(df, ts_col, cols, edges, window), base_counts)


def drift_by_window_stream(stream: DataFrame, ts_col: str, cols: Sequence[str],
                           base: DataFrame, sink_path: str, checkpoint: str,
                           window: str = "1 day", watermark: str = "1 hour",
                           method: str = "exact", available_now: bool = True):
    """Start the streaming form; closed windows' PSI rows land under
    ``sink_path`` in one folder per micro-batch (``epoch=<id>``), rewritten
    whole if the batch is retried, so a restart never duplicates rows."""
    edges, base_counts = fit_baseline(base, cols, method)
    base_counts = base_counts.cache()  # reused by every micro-batch; tiny
    counts = window_counts(stream, ts_col, cols, edges, window, watermark)

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        # One folder per micro-batch, overwritten on a retry: exactly once.
        out = f"{sink_path.rstrip('/')}/epoch={epoch_id}"
        window_psi(batch, base_counts).write.mode("overwrite").parquet(out)

    writer = (counts.writeStream.outputMode("append").foreachBatch(per_batch)
              .option("checkpointLocation", checkpoint))
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


# ---------------------------------------------------------------------------
# Categorical columns: chi-square per window against the baseline categories
# ---------------------------------------------------------------------------

def fit_category_baseline(base: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, category, e_cnt) of the baseline; null is the category 'nan'."""
    coded = base.select(*[as_category(c).alias(c) for c in cols])
    return (coded.unpivot([], list(cols), "column", "category")
                 .groupBy("column", "category").agg(F.count(F.lit(1)).alias("e_cnt")))


def window_category_counts(df: DataFrame, ts_col: str, cols: Sequence[str],
                           window: str = "1 day", watermark: str | None = None) -> DataFrame:
    """(window_start, window_end, column, category, a_cnt); works on a stream."""
    ts = F.col(ts_col)
    if dict(df.dtypes)[ts_col] == "timestamp_ntz":
        ts = ts.cast("timestamp")
    timed = df.select(ts.alias("_ts"), *[as_category(c).alias(c) for c in cols])
    if watermark:
        timed = timed.withWatermark("_ts", watermark)
    long = timed.unpivot(["_ts"], list(cols), "column", "category")
    return (long.groupBy(F.window("_ts", window).alias("w"), "column", "category")
                .agg(F.count(F.lit(1)).alias("a_cnt"))
                .select(F.col("w.start").alias("window_start"),
                        F.col("w.end").alias("window_end"), "column", "category", "a_cnt"))


def window_chi_square(counts: DataFrame, base_counts: DataFrame) -> DataFrame:
    """Chi-square per (window, column): the 2 x K table over the union of the
    baseline's and the window's categories (absent ones count 0).

    Categories that a window lacks are one pooled cell: without a correction a
    category of c baseline rows adds c * n_new / n_base, which is linear in c, and
    with K = 2 (Yates) there is one such category at most. So a window has as many
    rows as its own categories plus one, however many the baseline has.
    """
    keys = ["window_start", "window_end", "column"]
    present = counts.join(base_counts, ["column", "category"], "left").select(
        *keys, F.coalesce("e_cnt", F.lit(0)).alias("n_base"), F.col("a_cnt").alias("n_new"),
        F.lit(1).cast("long").alias("kinds"), F.col("e_cnt").isNotNull().cast("long").alias("known"))
    # One row per monitored column.
    base = base_counts.groupBy("column").agg(F.sum("e_cnt").alias("rows"), F.count("*").alias("all"))
    absent = present.groupBy(*keys).agg(F.sum("n_base").alias("met"), F.sum("known").alias("known")) \
        .join(F.broadcast(base), "column") \
        .select(*keys, (F.col("rows") - F.col("met")).alias("n_base"), F.lit(0).cast("long").alias("n_new"),
                (F.col("all") - F.col("known")).alias("kinds")).where("kinds > 0")
    cells = present.drop("known").unionByName(absent)
    return chi_square_finish(chi_square_stats(cells, keys, broadcast_totals=False), keys)


def chi_square_by_window_batch(df: DataFrame, ts_col: str, cols: Sequence[str],
                               base: DataFrame, window: str = "1 day") -> DataFrame:
    return window_chi_square(window_category_counts(df, ts_col, cols, window),
                             fit_category_baseline(base, cols))


def chi_square_by_window_stream(stream: DataFrame, ts_col: str, cols: Sequence[str],
                                base: DataFrame, sink_path: str, checkpoint: str,
                                window: str = "1 day", watermark: str = "1 hour",
                                available_now: bool = True):
    """Streaming form: closed windows' chi-square rows appended to Parquet."""
    base_counts = fit_category_baseline(base, cols).cache()
    counts = window_category_counts(stream, ts_col, cols, window, watermark)

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        out = f"{sink_path.rstrip('/')}/epoch={epoch_id}"
        window_chi_square(batch, base_counts).write.mode("overwrite").parquet(out)

    writer = (counts.writeStream.outputMode("append").foreachBatch(per_batch)
              .option("checkpointLocation", checkpoint))
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


# ---------------------------------------------------------------------------
# Both kinds per window, in the report's shape
# ---------------------------------------------------------------------------

def report_by_window_batch(df: DataFrame, ts_col: str, base: DataFrame,
                           id_cols: Sequence[str] = (), window: str = "1 day",
                           method: str = "exact") -> DataFrame:
    """(window_start, window_end, column, kind, psi, statistic, dof, p_value,
    status) for every column but the event time and ids; numeric columns get
    PSI (4 places), the others chi-square (6 places), as in the batch report."""
    cols = [c for c in base.columns if c != ts_col and c not in set(id_cols)]
    num, cat = column_kinds(base, cols)
    return _report(drift_by_window_batch(df, ts_col, num, base, window, method) if num else None,
                   chi_square_by_window_batch(df, ts_col, cat, base, window) if cat else None)


def _report(psi: DataFrame | None, chi: DataFrame | None) -> DataFrame:
    """PSI and chi-square rows per window in the report's columns."""
    keys = ["window_start", "window_end", "column"]
    parts = []
    if psi is not None:
        parts.append(psi.select(
            *keys, F.lit("numeric").alias("kind"), F.round("psi", 4).alias("psi"),
            F.lit(None).cast("double").alias("statistic"), F.lit(None).cast("int").alias("dof"),
            F.lit(None).cast("double").alias("p_value"), "status"))
    if chi is not None:
        parts.append(chi.select(
            *keys, F.lit("categorical").alias("kind"), F.lit(None).cast("double").alias("psi"),
            F.round("statistic", 6).alias("statistic"), "dof", F.round("p_value", 6).alias("p_value"),
            "status"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def report_by_window_stream(stream: DataFrame, ts_col: str, base: DataFrame, sink_path: str,
                            checkpoint: str, id_cols: Sequence[str] = (), window: str = "1 day",
                            watermark: str = "1 hour", method: str = "exact",
                            available_now: bool = True):
    """Start the streaming form of the report: one query keeps the counts of both kinds of
    columns, and each micro-batch writes the rows of its closed windows to its own folder."""
    cols = [c for c in base.columns if c != ts_col and c not in set(id_cols)]
    num, cat = column_kinds(base, cols)
    edges, bins = fit_baseline(base, num, method) if num else (None, None)
    categories = fit_category_baseline(base, cat).cache() if cat else None
    bins = bins.cache() if num else None
    ts = F.col(ts_col).cast("timestamp")
    timed = stream.select(ts.alias("_ts"), *num, *[as_category(c).alias(c) for c in cat]) \
        .withWatermark("_ts", watermark)
    parts = []
    if num:
        parts.append(coded_rows(timed, num, edges, ids=["_ts"])
                     .withColumn("category", F.lit(None).cast("string")))
    if cat:
        parts.append(timed.unpivot(["_ts"], list(cat), "column", "category")
                     .select("_ts", "column", F.lit(None).cast("int").alias("code"), "category"))
    long = parts[0].unionByName(parts[1]) if len(parts) == 2 else parts[0]
    counts = long.groupBy(F.window("_ts", window).alias("w"), "column", "code", "category") \
        .agg(F.count(F.lit(1)).alias("a_cnt")) \
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                "column", "code", "category", "a_cnt")

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        psi = window_psi(batch.where("code IS NOT NULL").drop("category"), bins) if num else None
        chi = window_chi_square(batch.where("category IS NOT NULL").drop("code"), categories) if cat else None
        _report(psi, chi).write.mode("overwrite").parquet(f"{sink_path.rstrip('/')}/epoch={epoch_id}")

    writer = (counts.writeStream.outputMode("append").foreachBatch(per_batch)
              .option("checkpointLocation", checkpoint))
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()

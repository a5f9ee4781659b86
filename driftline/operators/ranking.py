"""Distributed running totals and exact order statistics.

Exact quantiles (NumPy's linear interpolation, or the lower element that an
exact ``approxQuantile`` returns) and exact ROC AUC both need the running
count of rows in value order. The ordered keys are range-partitioned (and
checkpointed, so the partition ids are fixed); each partition adds the totals
of the partitions before it (a table of at most ``P + groups`` rows), so no
task ever holds more than one range partition. Inputs of every size take this
one path.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, shuffle_partitions

_PID = "_dl_pid"


def running_totals(df: DataFrame, order_col: str | Sequence[str], sum_cols: Sequence[str],
                   by: Sequence[str] = (), num_partitions: int | None = None,
                   suffix: str = "_cum", bounded_groups: bool = True) -> DataFrame:
    """Add inclusive running sums ``<c><suffix>`` of ``sum_cols`` in
    ``order_col`` order (one column or several) within each ``by`` group.

    Rows tied on ``(by..., order)`` fall in the same range partition and get
    distinct running sums in arbitrary order (like ``row_number``); callers
    that need exact ranks aggregate first, so a hot value is one row.
    Shuffles: one range exchange on ``(by, order)`` and one hash exchange on
    ``(partition, by)`` for the in-partition window. The partition offsets
    have at most ``num_partitions + groups`` rows: broadcast when the caller
    knows the groups are few (``bounded_groups``, e.g. monitored columns),
    else the join strategy is left to Spark's runtime size check.
    """
    spark = df.sparkSession
    n_parts = num_partitions or shuffle_partitions(spark)
    by = list(by)
    order = [order_col] if isinstance(order_col, str) else list(order_col)
    ranged = (df.repartitionByRange(n_parts, *[F.col(c) for c in by + order])
                .withColumn(_PID, F.spark_partition_id()))
    # The partition totals and the rows must see the same range bounds. Two
    # branches over one DataFrame may be planned as two exchanges, each
    # sampling its own bounds, so the partition ids are materialized once in
    # the shared checkpoint folder (this also cuts the lineage: a lost
    # executor re-reads them instead of re-sampling).
    ensure_checkpoint_dir(spark)
    ranged = ranged.checkpoint(eager=True)
    part_totals = ranged.groupBy(_PID, *by).agg(
        *[F.sum(c).alias(f"_dl_t_{c}") for c in sum_cols])
    before = Window.partitionBy(*by).orderBy(_PID).rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = part_totals.select(
        F.col(_PID).alias("_dl_opid"), *[F.col(c).alias(f"_dl_k_{c}") for c in by],
        *[F.coalesce(F.sum(f"_dl_t_{c}").over(before), F.lit(0)).alias(f"_dl_o_{c}")
          for c in sum_cols])
    # One row per (range partition, group) pair that has data. Group keys
    # match null-safely, so a null group keeps its rows.
    cond = F.col(_PID) == F.col("_dl_opid")
    for c in by:
        cond = cond & F.col(c).eqNullSafe(F.col(f"_dl_k_{c}"))
    joined = ranged.join(F.broadcast(offsets) if bounded_groups else offsets, on=cond,
                         how="inner")
    within = Window.partitionBy(_PID, *by).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    out = joined.select(
        *df.columns,
        *[(F.col(f"_dl_o_{c}") + F.sum(c).over(within)).alias(f"{c}{suffix}")
          for c in sum_cols])
    return out


def value_counts(df: DataFrame, key_col: str, value_col: str) -> DataFrame:
    """``(key, value, cnt)`` over non-null, non-NaN values: the distinct-value
    table. Partial aggregation collapses a hot value before the shuffle."""
    v = F.col(value_col)
    return (df.where(v.isNotNull() & ~F.isnan(v))
              .groupBy(key_col, value_col).agg(F.count(F.lit(1)).alias("cnt")))


def linear_positions(n: int, probs: Iterable[float]) -> list[tuple[int, int, float]]:
    """NumPy 'linear' quantile positions: (lower rank, upper rank, gamma)."""
    out = []
    for q in probs:
        pos = (n - 1) * q
        if pos >= n - 1:
            out.append((n - 1, n - 1, 0.0))
        elif pos < 0:
            out.append((0, 0, 0.0))
        else:
            lo = math.floor(pos)
            out.append((int(lo), int(lo) + 1, pos - lo))
    return out


def lerp(a: float, b: float, t: float) -> float:
    """NumPy's interpolation step, same operation order (two branches)."""
    d = b - a
    if t >= 0.5:
        return b - d * (1 - t)
    return a + d * t


def lower_rank(n: int, q: float) -> int:
    """Rank returned by an exact approxQuantile (relative error 0)."""
    return max(int(math.ceil(q * n)) - 1, 0)


def _values_at(cum: DataFrame, key_col: str, value_col: str, ranks: dict) -> dict:
    """key → {rank: value} from a table with running counts ``cnt_cum``. Only the
    selected values (at most ``sum(len(ranks))`` rows) reach the driver; a rank that
    falls on a row without value is left out."""
    wanted = [(k, int(r)) for k, rs in ranks.items() for r in sorted(set(rs))]
    if not wanted:
        return {}
    key_type = cum.schema[key_col].dataType.simpleString()
    targets = cum.sparkSession.createDataFrame(wanted, f"_dl_key {key_type}, _dl_rank long")
    hit = cum.join(
        F.broadcast(targets),
        on=(F.col(key_col) == F.col("_dl_key"))
        & ((F.col("cnt_cum") - F.col("cnt")) <= F.col("_dl_rank"))
        & (F.col("_dl_rank") < F.col("cnt_cum")),
        how="inner",
    ).where(F.col(value_col).isNotNull())
    out: dict = {}
    for k, r, v in hit.select(key_col, "_dl_rank", value_col).collect():
        out.setdefault(k, {})[int(r)] = float(v)
    return out


def order_statistics(df: DataFrame, key_col: str, value_col: str,
                     ranks: dict, num_partitions: int | None = None) -> dict:
    """Values at the given 0-based ranks, per key, exactly.

    ``ranks`` maps key → iterable of ranks. Returns key → {rank: value}.
    """
    cum = running_totals(value_counts(df, key_col, value_col), value_col, ["cnt"],
                         by=[key_col], num_partitions=num_partitions)
    return _values_at(cum, key_col, value_col, ranks)


def _positions(n: int, probs: Sequence[float], method: str):
    """Per probability: (ranks needed, how to combine them)."""
    if method == "linear":
        pos = linear_positions(n, probs)
        return [(lo, hi) for lo, hi, _ in pos], pos
    if method == "lower":
        rs = [lower_rank(n, q) for q in probs]
        return [(r, r) for r in rs], rs
    raise ValueError(f"unknown quantile method {method!r}")


def _combine(got: dict, plan, method: str) -> list:
    if method == "linear":
        return [lerp(got[lo], got[hi], t) for lo, hi, t in plan]
    return [got[r] for r in plan]


def disjoint(brackets: Iterable[tuple[float, float]]) -> list[tuple[float, float]]:
    """Closed intervals merged where they meet, ascending."""
    out: list[tuple[float, float]] = []
    for a, b in sorted(brackets):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def bracket_order_statistics(df: DataFrame, key_col: str, value_col: str, brackets: dict,
                             ranks: dict, num_partitions: int | None = None) -> dict:
    """Exact values at given ranks, keeping only values inside brackets.

    ``brackets`` maps key → disjoint ascending intervals (a, b). One pass looks each
    row's interval up in a one-row-per-key table and counts rows per (key, interval,
    value), where all values between two intervals are one row; running totals of
    those counts are the rows' ranks. A rank outside the brackets is left out of the
    result (the caller falls back). Returns key → {rank: value}.
    """
    spark = df.sparkSession
    key_type = df.schema[key_col].dataType.simpleString()
    if not any(brackets.values()):
        return {}
    # One row per monitored column: bounded by the schema. Bounds are columns, not arrays,
    # so that comparing a row with them stays in generated code.
    width = max(len(iv) for iv in brackets.values())
    rows = [(k, *(float(a) for a, _ in iv), *[None] * (width - len(iv)),
             *(float(b) for _, b in iv), *[None] * (width - len(iv))) for k, iv in brackets.items()]
    names = [f"_dl_{side}{i}" for side in "ab" for i in range(width)]
    table = spark.createDataFrame(rows, f"_dl_key {key_type}, " + ", ".join(f"{n} double" for n in names))
    v = F.col(value_col)
    valid = df.where(v.isNotNull() & ~F.isnan(v)).select(key_col, v.cast("double").alias(value_col))
    met = valid.join(F.broadcast(table), F.col(key_col) == F.col("_dl_key"))

    def passed(side: str) -> Column:
        """Brackets that begin at or before the value, or that end before it."""
        found = [(v >= F.col(n) if side == "a" else v > F.col(n)) for n in names if n.startswith(f"_dl_{side}")]
        return sum((F.coalesce(f, F.lit(False)).cast("int") for f in found), F.lit(0))

    # Intervals are disjoint: the value lies in the last begun one unless that has ended.
    counts = (met.select(key_col, v, (passed("a") - 1).alias("_dl_at"), passed("b").alias("_dl_ended"))
                 .withColumn("_dl_gap", F.col("_dl_ended") != F.col("_dl_at"))
                 .select(key_col, "_dl_at", "_dl_gap", F.when(~F.col("_dl_gap"), v).alias(value_col))
                 .groupBy(key_col, "_dl_at", "_dl_gap", value_col)
                 .agg(F.count(F.lit(1)).alias("cnt")))
    cum = running_totals(counts, ["_dl_at", "_dl_gap", value_col], ["cnt"], by=[key_col],
                         num_partitions=num_partitions)
    return _values_at(cum, key_col, value_col, ranks)


def exact_quantiles(df: DataFrame, key_col: str, value_col: str,
                    probs: Sequence[float], method: str = "linear",
                    num_partitions: int | None = None, accuracy: int = 10000) -> dict:
    """Exact quantiles per key.

    ``method="linear"`` reproduces ``numpy.quantile`` (default method);
    ``method="lower"`` returns the element an exact ``approxQuantile`` returns.
    Result: key → dict(n, min, max, quantiles=[...]).

    Inputs of every size take the same two passes. The first gives count, minimum,
    maximum and a ``percentile_approx`` sketch at q -/+ 3/accuracy per key; the second
    ranks the values inside those brackets (about 6/accuracy of the rows per
    quantile). A rank found outside (the sketch's error bound failed) sends the key to
    whole ranking with running totals.
    """
    v = F.col(value_col)
    valid = df.where(v.isNotNull() & ~F.isnan(v))
    delta = 3.0 / accuracy
    lows = [min(max(q - delta, 0.0), 1.0) for q in probs]
    highs = [min(max(q + delta, 0.0), 1.0) for q in probs]
    sketch_probs = sorted(set(lows) | set(highs))
    sizes, plans, ranks, brackets = {}, {}, {}, {}
    for k, n, mn, mx, found in valid.groupBy(key_col).agg(
            F.count(F.lit(1)), F.min(v), F.max(v),
            F.percentile_approx(v, sketch_probs, accuracy)).collect():
        sizes[k] = (int(n), float(mn), float(mx))
        pairs, plans[k] = _positions(int(n), probs, method)
        ranks[k] = sorted({r for pair in pairs for r in pair})
        sketch = dict(zip(sketch_probs, map(float, found)))
        brackets[k] = disjoint((float(mn) if lo <= 0.0 else sketch[lo],
                                float(mx) if hi >= 1.0 else sketch[hi])
                               for lo, hi in zip(lows, highs))
    stats = bracket_order_statistics(valid, key_col, value_col, brackets, ranks, num_partitions)
    missed = {k: rs for k, rs in ranks.items() if not set(rs) <= set(stats.get(k, {}))}
    if missed:
        stats.update(order_statistics(valid.where(F.col(key_col).isin(list(missed))), key_col,
                                      value_col, missed, num_partitions))
    return {k: {"n": n, "min": mn, "max": mx, "quantiles": _combine(stats.get(k, {}), plans[k], method)}
            for k, (n, mn, mx) in sizes.items()}


def approx_quantiles(df: DataFrame, key_col: str, value_col: str,
                     probs: Sequence[float], accuracy: int = 10000) -> dict:
    """``percentile_approx`` per key: one pass, bounded sketch per group."""
    v = F.col(value_col)
    rows = (df.where(v.isNotNull() & ~F.isnan(v))
              .groupBy(key_col)
              .agg(F.count(F.lit(1)).alias("n"), F.min(v).alias("mn"), F.max(v).alias("mx"),
                   F.percentile_approx(v, list(probs), accuracy).alias("q"))
              .collect())
    return {r[key_col]: {"n": int(r["n"]), "min": float(r["mn"]), "max": float(r["mx"]),
                         "quantiles": [float(x) for x in r["q"]]} for r in rows}

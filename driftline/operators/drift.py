"""Distribution drift between a baseline and a new batch.

Numeric columns: population stability index over ten bins whose edges are the
baseline's deciles (NumPy's linear quantiles; too few distinct edges fall back
to ten even bins between min and max). Categorical columns: chi-square test of
independence on the 2 x K table of category counts, with Yates' correction
when K = 2.

Both sides travel as one DataFrame with a ``side`` column ('base' / 'new'),
so a table split by a predicate is scanned once. All columns are handled by
one scan and one aggregation (unpivot to long form), never a loop of jobs.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import N_BINS, as_category, clip_share, p_status, psi_status
from ..functions.stats import chi2_sf
from ..session import ensure_checkpoint_dir
from .ranking import approx_quantiles, exact_quantiles

BASE, NEW = "base", "new"
SIDE = "side"
_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType, T.BooleanType)


# ---------------------------------------------------------------------------
# Column bookkeeping (schema metadata only, no data touched)
# ---------------------------------------------------------------------------

def is_numeric_type(dt: T.DataType) -> bool:
    """Numeric as pandas sees it: numbers and booleans."""
    return isinstance(dt, _NUMERIC)


def column_kinds(df: DataFrame, cols: Sequence[str] | None = None) -> tuple[list, list]:
    """Split columns into (numeric, categorical) by the frame's types."""
    cols = list(cols) if cols is not None else df.columns
    types = {f.name: f.dataType for f in df.schema.fields}
    num = [c for c in cols if is_numeric_type(types[c])]
    cat = [c for c in cols if not is_numeric_type(types[c])]
    return num, cat


def common_columns(base: DataFrame, new: DataFrame, id_cols: Sequence[str] = ()) -> list:
    """Columns of ``base`` (in its order) also in ``new``, minus ids."""
    drop = set(id_cols)
    new_cols = set(new.columns)
    return [c for c in base.columns if c in new_cols and c not in drop]


def sided(base: DataFrame, new: DataFrame, cols: Sequence[str],
          cast: dict | None = None) -> DataFrame:
    """Stack two frames under a ``side`` column, keeping ``cols``."""
    cast = cast or {}

    def pick(df, side):
        return df.select(F.lit(side).alias(SIDE),
                         *[(F.col(c).cast(cast[c]) if c in cast else F.col(c)).alias(c)
                           for c in cols])
    return pick(base, BASE).unionByName(pick(new, NEW))


def split_sides(df: DataFrame, base_condition: Column, cols: Sequence[str]) -> DataFrame:
    """One table split by a predicate: rows matching it are the baseline."""
    return df.select(F.when(base_condition, F.lit(BASE)).otherwise(F.lit(NEW)).alias(SIDE),
                     *[F.col(c) for c in cols])


def to_long(df: DataFrame, cols: Sequence[str], ids: Sequence[str] = (),
            key: str = "column", value: str = "value") -> DataFrame:
    """Unpivot numeric ``cols`` to (ids..., key, value double)."""
    wide = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in cols])
    return wide.unpivot(list(ids), list(cols), key, value)


# ---------------------------------------------------------------------------
# Bin edges
# ---------------------------------------------------------------------------

def decile_probs(bins: int = N_BINS) -> list[float]:
    """``numpy.linspace(0, 1, bins + 1)``: i * step, last exactly 1."""
    step = 1.0 / bins
    return [i * step + 0.0 for i in range(bins)] + [1.0]


def even_edges(mn: float, mx: float, bins: int = N_BINS) -> list[float]:
    """``numpy.linspace(mn, mx, bins + 1)``."""
    step = (mx - mn) / bins
    return [i * step + mn for i in range(bins)] + [mx]


@dataclass
class BinEdges:
    """Per-column bin edges fitted on the baseline (like an ML estimator's
    model: a small summary, at most ``bins + 1`` doubles per column)."""

    edges: dict = field(default_factory=dict)
    bins: int = N_BINS

    @classmethod
    def fit(cls, base_long: DataFrame, cols: Sequence[str], bins: int = N_BINS,
            method: str = "exact", accuracy: int = 10000, key: str = "column",
            value: str = "value") -> "BinEdges":
        """Fit from a long (key, value) baseline.

        ``method="exact"``: NumPy-equal deciles by distributed order
        statistics. ``method="approx"``: ``percentile_approx`` (one pass,
        rank error at most n / accuracy); edges are then data values.
        """
        probs = decile_probs(bins)
        if method == "exact":
            qs = exact_quantiles(base_long, key, value, probs, "linear")
        elif method == "approx":
            qs = approx_quantiles(base_long, key, value, probs, accuracy)
        else:
            raise ValueError(f"unknown edge method {method!r}")
        edges = {}
        for c in cols:
            info = qs.get(c)
            if info is None:
                edges[c] = None  # no baseline value: insufficient data
                continue
            uniq = sorted(set(info["quantiles"]))
            if len(uniq) < 3:
                uniq = even_edges(info["min"], info["max"], bins)
            edges[c] = uniq
        return cls(edges=edges, bins=bins)

    def to_df(self, spark: SparkSession) -> DataFrame:
        rows = [(c, i, float(e)) for c, es in self.edges.items() if es
                for i, e in enumerate(es)]
        return spark.createDataFrame(rows, "column string, edge_index int, edge double")

    def table(self, spark: SparkSession) -> DataFrame:
        """(column, m, hi, e0 .. e<bins>): one row per column that has edges,
        ``m`` edges, ``hi`` the last one, unused slots null. Joined to the rows by broadcast (its
        size is bounded by the number of monitored columns), so the
        generated code does not change with the edge values."""
        width = self.bins + 1
        rows = []
        for c, es in self.edges.items():
            if es:
                rows.append((c, len(es), float(es[-1]), *[float(e) for e in es],
                             *([None] * (width - len(es)))))
        schema = ("column string, m int, hi double, "
                  + ", ".join(f"e{i} double" for i in range(width)))
        return spark.createDataFrame(rows, schema)


def code_from_table(value: str = "value", bins: int = N_BINS) -> Column:
    """Bin code of ``value`` against the joined edge row (e0.., m).

    Bins are half open [e_i, e_i+1) except the last, which is closed, as in
    ``numpy.histogram``; values outside [e0, e_(m-1)] are dropped (-1), null
    and NaN are -2. Comparisons with the null padding count as false.
    """
    v = F.col(value)
    m = F.col("m")
    idx = sum((F.coalesce(v >= F.col(f"e{i}"), F.lit(False)).cast("int")
               for i in range(1, bins + 1)), F.lit(0))
    return (F.when(v.isNull() | F.isnan(v), F.lit(-2))
             .when(m.isNull(), F.lit(-1))
             .when((v >= F.col("e0")) & (v <= F.col("hi")), F.least(idx, m - 2))
             .otherwise(F.lit(-1)))


def coded_long(df: DataFrame, cols: Sequence[str], edges: BinEdges,
               ids: Sequence[str] = (SIDE,)) -> DataFrame:
    """(ids..., column, code): unpivot, then look the column's edges up in
    the broadcast edge table."""
    spark = df.sparkSession
    long = to_long(df, cols, ids=ids)
    table = F.broadcast(edges.table(spark))
    joined = long.join(table, "column", "left")
    return joined.select(*ids, "column", code_from_table("value", edges.bins).alias("code"))


def histogram(sides: DataFrame, cols: Sequence[str], edges: BinEdges) -> DataFrame:
    """(column, side, code, cnt): counts per bin, plus code -1 (out of range)
    and -2 (null/NaN). One scan; partial aggregation leaves at most
    2 * columns * (bins + 2) rows per task before the shuffle."""
    return (coded_long(sides, cols, edges)
            .groupBy("column", SIDE, "code").agg(F.count(F.lit(1)).alias("cnt")))


def _columns_frame(spark: SparkSession, cols: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([(c, i) for i, c in enumerate(cols)],
                                 "column string, ordinal int")


def psi_from_histogram(hist: DataFrame, cols: Sequence[str]) -> DataFrame:
    """PSI per column from the (tiny) histogram table.

    Bins empty on both sides add (1e-6 - 1e-6) * ln(1) = 0, so only bins seen
    on some side are summed; no bin grid is needed.
    """
    spark = hist.sparkSession
    per_bin = hist.groupBy("column", "code").agg(
        F.sum(F.when(F.col(SIDE) == BASE, F.col("cnt")).otherwise(0)).alias("e_cnt"),
        F.sum(F.when(F.col(SIDE) == NEW, F.col("cnt")).otherwise(0)).alias("a_cnt"))
    w = Window.partitionBy("column")  # at most bins + 2 rows per column
    in_range = F.col("code") >= 0
    valid = F.col("code") >= -1
    per_bin = per_bin.select(
        "column", "code", "e_cnt", "a_cnt",
        F.sum(F.when(in_range, F.col("e_cnt")).otherwise(0)).over(w).alias("e_in"),
        F.sum(F.when(in_range, F.col("a_cnt")).otherwise(0)).over(w).alias("a_in"))
    e = clip_share(F.col("e_cnt"), F.col("e_in"))
    a = clip_share(F.col("a_cnt"), F.col("a_in"))
    term = F.when(in_range, (a - e) * F.log(a / e))
    agg = per_bin.groupBy("column").agg(
        F.sum(F.when(valid, F.col("e_cnt")).otherwise(0)).alias("n_base"),
        F.sum(F.when(valid, F.col("a_cnt")).otherwise(0)).alias("n_new"),
        F.sum(term).alias("psi_raw"))
    out = _columns_frame(spark, cols).join(agg, "column", "left")
    n_base = F.coalesce(F.col("n_base"), F.lit(0)).cast("long")
    n_new = F.coalesce(F.col("n_new"), F.lit(0)).cast("long")
    psi = F.when((n_base > 0) & (n_new > 0), F.coalesce(F.col("psi_raw"), F.lit(0.0)))
    return out.select("column", "ordinal", n_base.alias("n_base"), n_new.alias("n_new"),
                      psi.alias("psi")).withColumn("status", psi_status(F.col("psi")))


def psi(sides: DataFrame, cols: Sequence[str], bins: int = N_BINS,
        method: str = "exact", edges: BinEdges | None = None,
        accuracy: int = 10000) -> DataFrame:
    """(column, ordinal, n_base, n_new, psi, status) for numeric ``cols`` of a
    sided frame. Edges are fitted on the baseline rows unless given."""
    if edges is None:
        base_long = to_long(sides.where(F.col(SIDE) == BASE), cols)
        edges = BinEdges.fit(base_long, cols, bins, method, accuracy)
    return psi_from_histogram(histogram(sides, cols, edges), cols)


# ---------------------------------------------------------------------------
# Chi-square
# ---------------------------------------------------------------------------

def contingency(sides: DataFrame, cols: Sequence[str], ordered: bool = False) -> DataFrame:
    """(column, category, n_base, n_new) over the union of categories of both
    sides; a category absent on one side gets 0 there without any join.
    ``ordered=True`` sorts by (column, category) for display; the tests do
    not need an order."""
    coded = sides.select(SIDE, *[as_category(c).alias(c) for c in cols])
    long = coded.unpivot([SIDE], list(cols), "column", "category")
    table = long.groupBy("column", "category").agg(
        F.count_if(F.col(SIDE) == BASE).alias("n_base"),
        F.count_if(F.col(SIDE) == NEW).alias("n_new"))
    return table.orderBy("column", "category") if ordered else table


def chi_square(sides: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, ordinal, k, dof, statistic, p_value, status, n_base, n_new).

    Statistic: sum over the 2 x K cells of (|O - E| - y)^2 / E with
    E = row total * column total / N; y = min(0.5, |O - E|) when K = 2
    (Yates), else 0. Fewer than two categories: p = 1. An empty side has no
    defined expected counts: insufficient_data.
    """
    return chi_square_from_table(contingency(sides, cols), cols)


def drift_counts(sides: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                 edges: BinEdges) -> DataFrame:
    """Both count tables of a drift report from one scan and one aggregation:
    (column, side, code, category, cnt). Numeric columns carry a bin code
    (category null); categorical ones carry their category (code null)."""
    spark = sides.sparkSession
    cells = ([F.struct(F.col(c).cast("double").alias("v"), F.lit(None).cast("string").alias("c"))
              .alias(c) for c in numeric]
             + [F.struct(F.lit(None).cast("double").alias("v"), as_category(c).alias("c"))
                .alias(c) for c in categorical])
    cols = list(numeric) + list(categorical)
    long = sides.select(SIDE, *cells).unpivot([SIDE], cols, "column", "val")
    joined = long.select(SIDE, "column", F.col("val.v").alias("value"), F.col("val.c").alias("category")) \
        .join(F.broadcast(edges.table(spark)), "column", "left")
    code = F.when(F.col("category").isNull(), code_from_table("value", edges.bins))
    return (joined.select("column", SIDE, code.alias("code"), "category")
                  .groupBy("column", SIDE, "code", "category")
                  .agg(F.count(F.lit(1)).alias("cnt")))


def psi_and_chi_square(sides: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                       bins: int = N_BINS, method: str = "exact", accuracy: int = 10000):
    """(psi frame, chi-square frame) sharing one counting pass."""
    edges = BinEdges(edges={}, bins=bins)
    if numeric:
        base_long = to_long(sides.where(F.col(SIDE) == BASE), numeric)
        edges = BinEdges.fit(base_long, numeric, bins, method, accuracy)
    # Both tests read the aggregated counts (bins and categories per column,
    # not rows). Checkpointed once: otherwise each test's filter is pushed
    # below the aggregate and the input is scanned twice.
    ensure_checkpoint_dir(sides.sparkSession)
    counts = drift_counts(sides, numeric, categorical, edges).checkpoint(eager=True)
    hist = (counts.where(F.col("category").isNull())
                  .select("column", SIDE, "code", "cnt"))
    table = (counts.where(F.col("category").isNotNull())
                   .groupBy("column", "category")
                   .agg(F.sum(F.when(F.col(SIDE) == BASE, F.col("cnt")).otherwise(0)).alias("n_base"),
                        F.sum(F.when(F.col(SIDE) == NEW, F.col("cnt")).otherwise(0)).alias("n_new")))
    psi_df = psi_from_histogram(hist, numeric) if numeric else None
    chi_df = chi_square_from_table(table, categorical) if categorical else None
    return psi_df, chi_df


def chi_square_stats(table: DataFrame, keys: Sequence[str] = ("column",),
                     broadcast_totals: bool = True) -> DataFrame:
    """Chi-square per ``keys`` group of a (keys..., category, n_base, n_new)
    table: (keys..., k, n_base, n_new, statistic) before the final checks.

    ``broadcast_totals``: the per-group totals are one row per monitored
    column when keys = (column,), bounded by the schema; for other keys
    (e.g. windows) Spark's own size check decides."""
    keys = list(keys)
    # A cell may stand for several categories (``kinds``) that one side lacks.
    kinds = F.sum("kinds") if "kinds" in table.columns else F.count(F.lit(1))
    totals = table.groupBy(*keys).agg(
        F.sum("n_base").alias("r_base"), F.sum("n_new").alias("r_new"), kinds.alias("k"))
    cells = table.join(F.broadcast(totals) if broadcast_totals else totals, keys)
    total = (F.col("r_base") + F.col("r_new")).cast("double")
    cat_total = (F.col("n_base") + F.col("n_new")).cast("double")
    defined = (F.col("r_base") > 0) & (F.col("r_new") > 0)

    def cell(observed: str, row_total: str) -> Column:
        expected = F.col(row_total).cast("double") * cat_total / total
        diff = F.abs(F.col(observed).cast("double") - expected)
        yates = F.when(F.col("k") == 2, F.least(F.lit(0.5), diff)).otherwise(F.lit(0.0))
        return F.pow(diff - yates, 2) / expected

    term = F.when(defined, cell("n_base", "r_base") + cell("n_new", "r_new"))
    return cells.groupBy(*keys).agg(
        F.first("k").alias("k"), F.first("r_base").alias("n_base"),
        F.first("r_new").alias("n_new"), F.sum(term).alias("statistic"))


def chi_square_finish(stats: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Degrees of freedom, p-value and status from (keep..., k, n_base,
    n_new, statistic); a group without rows counts as k = 0."""
    k = F.coalesce(F.col("k"), F.lit(0))
    n_base = F.coalesce(F.col("n_base"), F.lit(0)).cast("long")
    n_new = F.coalesce(F.col("n_new"), F.lit(0)).cast("long")
    dof = F.greatest(k - 1, F.lit(0)).cast("int")
    stat = F.when(k < 2, F.lit(0.0)).when((n_base > 0) & (n_new > 0), F.col("statistic"))
    out = stats.select(*keep, k.cast("int").alias("k"), dof.alias("dof"),
                       stat.alias("statistic"), n_base.alias("n_base"), n_new.alias("n_new"))
    p = (F.when(F.col("k") < 2, F.lit(1.0))
          .when(F.col("statistic").isNotNull(), chi2_sf(F.col("statistic"), F.col("dof"))))
    return out.withColumn("p_value", p).withColumn("status", p_status(F.col("p_value")))


def chi_square_from_table(table: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Chi-square per column from a (column, category, n_base, n_new) table."""
    spark = table.sparkSession
    stats = chi_square_stats(table, ["column"])
    out = _columns_frame(spark, cols).join(stats, "column", "left")
    return chi_square_finish(out, ["column", "ordinal"])

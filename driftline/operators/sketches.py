"""Quantile sketches of the baseline, kept per day and merged.

A KLL sketch summarises a column's values of one day in bounded space; sketches of days
merge into the sketch of a period. The table of daily sketches is partitioned by day: a new
or corrected day is one scan of that day's rows and replaces its own partition, and edges of
any period come from the sketches alone, without the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .drift import BinEdges, N_BINS, decile_probs, even_edges, to_long

#: Size parameter: about this many values per level are kept.
K = 4096


def rank_error(k: int = K) -> float:
    """Normalised rank error of one quantile, met with 99 % confidence."""
    return 2.296 / k ** 0.9021  # fixed values: the published fit of the sketch's error


def daily_sketches(df: DataFrame, day: Column, cols: Sequence[str], k: int = K) -> DataFrame:
    """(day, column, n, min, max, sketch) per day and numeric column; values that are
    null or NaN are left out. One scan; partial sketches are merged, not rows."""
    long = to_long(df.withColumn("_dl_day", day), cols, ids=["_dl_day"])
    valid = long.where(F.col("value").isNotNull() & ~F.isnan("value"))
    return valid.groupBy(F.col("_dl_day").alias("day"), "column").agg(
        F.count("*").alias("n"), F.min("value").alias("min"), F.max("value").alias("max"),
        F.kll_sketch_agg_double("value", F.lit(k)).alias("sketch"))


def write_sketches(sketches: DataFrame, path: str) -> str:
    """Put days into the sketch table; days written again replace their partitions."""
    sketches.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)
    return path


def merged(sketches: DataFrame) -> DataFrame:
    """(column, n, min, max, sketch) over all given days."""
    return sketches.groupBy("column").agg(
        F.sum("n").alias("n"), F.min("min").alias("min"), F.max("max").alias("max"),
        F.kll_merge_agg_double("sketch").alias("sketch"))


def quantiles(sketches: DataFrame, probs: Sequence[float]) -> DataFrame:
    """(column, n, min, max, quantiles array<double>) of merged sketches; the first and
    last are exact when their probability is 0 or 1."""
    at = F.array(*[F.when(F.lit(p <= 0.0), F.col("min")).when(F.lit(p >= 1.0), F.col("max"))
                   .otherwise(F.kll_sketch_get_quantile_double("sketch", F.lit(float(p)))) for p in probs])
    return merged(sketches).select("column", "n", "min", "max", at.alias("quantiles"))


def sketch_edges(sketches: DataFrame, cols: Sequence[str], bins: int = N_BINS) -> BinEdges:
    """Decile edges from daily sketches: one row per column reaches the driver."""
    rows = {r["column"]: r for r in quantiles(sketches, decile_probs(bins)).collect()}
    edges: dict = {}
    for c in cols:
        r = rows.get(c)
        values = sorted(set(r["quantiles"])) if r else None
        edges[c] = even_edges(r["min"], r["max"], bins) if r and len(values) < 3 else values
    return BinEdges(edges=edges, bins=bins)


def sketch_medians(sketches: DataFrame) -> dict[str, float]:
    """The median of each column that has values, from daily sketches."""
    return {r["column"]: r["quantiles"][0] for r in quantiles(sketches, [0.5]).collect()}

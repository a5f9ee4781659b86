"""Classifier evaluation as aggregations: accuracy, exact ROC AUC, confusion
matrix. AUC comes whole or by group, e.g. by fold and grid point."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranking import running_totals


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: share of rows whose prediction equals the label."""
    hit = (F.col(label).cast("double") == F.col(prediction).cast("double")).cast("double")
    return df.agg(F.avg(hit).alias("accuracy"), F.count(F.lit(1)).alias("n"))


def auc_exact(df: DataFrame, label: str = "label", score: str = "score",
              num_partitions: int | None = None) -> DataFrame:
    """Exact area under the ROC curve (ties count one half): one row, as ``auc_by``
    gives it for one group."""
    found = auc_by(df.withColumn("_all", F.lit(0)), ["_all"], label, score, num_partitions, bounded_groups=True)
    return found.agg(F.first("auc").alias("auc"), F.coalesce(F.first("positives"), F.lit(0)).alias("positives"),
                     F.coalesce(F.first("negatives"), F.lit(0)).alias("negatives"))


def auc_by(df: DataFrame, by: Sequence[str], label: str = "label", score: str = "score",
           num_partitions: int | None = None, bounded_groups: bool = False) -> DataFrame:
    """(by..., auc, positives, negatives): the exact area under the ROC curve of every
    group at once; null where a group has one class only.

    AUC = sum over scores s of pos(s) * (neg(< s) + neg(s) / 2) / (P * N).
    Rows are first grouped by score (a hot score collapses map-side), then
    the running negative count is a distributed running total over the
    score order, so no task sees more than one range partition, however the rows are
    spread over the groups. Rows without label or score are left out.
    """
    by = list(by)
    y = F.col(label).cast("double")
    by_score = (df.where(F.col(score).isNotNull() & y.isNotNull())
                  .groupBy(*by, F.col(score).cast("double").alias("_dl_s"))
                  .agg(F.sum(F.when(y > 0.5, 1).otherwise(0)).cast("long").alias("_dl_pos"),
                       F.sum(F.when(y > 0.5, 0).otherwise(1)).cast("long").alias("_dl_neg")))
    cum = running_totals(by_score, "_dl_s", ["_dl_neg"], by=by, num_partitions=num_partitions,
                         bounded_groups=bounded_groups)
    below = (F.col("_dl_neg_cum") - F.col("_dl_neg")).cast("double")
    part = cum.groupBy(*by).agg(
        F.sum(F.col("_dl_pos").cast("double") * (below + F.col("_dl_neg").cast("double") / 2.0)).alias("_dl_u"),
        F.sum("_dl_pos").alias("positives"), F.sum("_dl_neg").alias("negatives"))
    both = (F.col("positives") > 0) & (F.col("negatives") > 0)
    return part.select(
        *by, F.when(both, F.col("_dl_u") / (F.col("positives").cast("double") * F.col("negatives").cast("double"))).alias("auc"),
        "positives", "negatives")


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction",
              classes=(0.0, 1.0)) -> DataFrame:
    """Rows: label; columns: one count per predicted class (zeros filled) and
    ``pred_other`` for every other prediction, null included, so that the counts of a
    label add up to its rows. The class list is given: no distinct job."""
    pred = F.col(prediction).cast("double")
    counts = [F.count_if(pred == c).alias(f"pred_{int(c)}") for c in classes]
    other = F.count_if(~F.coalesce(pred.isin(list(classes)), F.lit(False))).alias("pred_other")
    return df.groupBy(F.col(label).cast("double").alias("label")).agg(*counts, other)

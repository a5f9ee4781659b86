"""Model fitting: logistic regression or random forest in one PipelineModel
with the feature stages, optional k-fold cross-validation by AUC."""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shuffle_partitions
from .evaluate import accuracy, auc_by
from .features import FeatureSpec, fold_column, split_by_hash
from .forest import bag_bytes, fit_counted

# Fixed values of the reference's training configuration: logistic
# regression with at most 50 iterations, forests of 100 trees, a 20 % test
# share with seed 42, and a grid of regParam {0, 0.01, 0.1} x
# elasticNetParam {0, 0.5} searched by 3-fold CV with parallelism 2.
MAX_ITER = 50
NUM_TREES = 100
TEST_FRACTION = 0.2
SEED = 42
REG_GRID = (0.0, 0.01, 0.1)
ELASTIC_GRID = (0.0, 0.5)
CV_FOLDS = 3
CV_PARALLELISM = 2
# Beyond this many bytes of row-wise draws a forest is trained on counted rows.
BAG_BYTES = 2_000_000_000


def classifier(model_type: str = "logreg", max_iter: int = MAX_ITER,
               num_trees: int = NUM_TREES, seed: int = SEED):
    if model_type == "random_forest":
        # Seeded: PySpark's default seed depends on the process.
        return RandomForestClassifier(labelCol="label", featuresCol="features",
                                      numTrees=num_trees, seed=seed)
    if model_type == "logreg":
        return LogisticRegression(labelCol="label", featuresCol="features", maxIter=max_iter)
    raise ValueError(f"unknown model type {model_type!r}")


@dataclass
class TrainResult:
    model: PipelineModel
    metrics: dict = field(default_factory=dict)
    test: DataFrame | None = None


def fit(df: DataFrame, spec: FeatureSpec, model_type: str = "logreg", *,
        split_key: str | None = None, test_fraction: float = TEST_FRACTION,
        seed: int = SEED, cv: bool = False, reg_grid: Sequence[float] = REG_GRID,
        elastic_grid: Sequence[float] = ELASTIC_GRID, folds: int = CV_FOLDS,
        parallelism: int = CV_PARALLELISM, max_iter: int = MAX_ITER,
        num_trees: int = NUM_TREES, partitions: int | None = None,
        most_bag_bytes: int = BAG_BYTES) -> TrainResult:
    """Split, fit, evaluate accuracy on the held-out rows.

    With ``split_key`` the training rows are hash-partitioned by the key into
    ``partitions`` (default: the session's shuffle partitions), at every size, and
    sorted within each by the key, ties by all columns that are used. Each iteration
    reads them in parallel, and the bootstrap of a forest draws from the same rows in
    the same places however the input was laid out: the same rows, seed and
    ``partitions`` give the same forest, and the same linear model up to the order in
    which partial sums of floats arrive.

    With ``split_key`` the split is a stable hash of the key; without, it is
    ``randomSplit`` with the seed (the reference's behaviour, which depends
    on the partitioning). Cross-validation (logreg only) uses a hash fold
    column when a key is given.

    Spark ML draws the bootstrap of a forest row by row and holds all draws. Where these
    would pass ``most_bag_bytes`` (2 GB: 3.9 million rows for 100 trees) the draws are made
    per group of equal binned rows (``forest.fit_counted``): every row still counts and the
    law of the trees is the same, but the drawn trees are others.
    """
    data = spec.prepare(df)
    if split_key:
        train_df, test_df = split_by_hash(data, split_key, seed, test_fraction)
    else:
        train_df, test_df = data.randomSplit([1.0 - test_fraction, test_fraction], seed=seed)
    use_cv = cv and model_type == "logreg"
    if use_cv and split_key:
        train_df = train_df.withColumn("_fold", fold_column(split_key, seed, folds))
    if split_key:
        train_df = train_df.repartition(partitions or shuffle_partitions(df.sparkSession), split_key)
    # Every stage, iteration, fold and grid point re-reads the training rows: keep
    # the columns they use for the fit. The null check is the first reader.
    kept = list(dict.fromkeys(spec.input_cols(train_df) + (["_fold"] if use_cv and split_key else [])))
    if split_key:
        train_df = train_df.sortWithinPartitions(split_key, *[c for c in kept if c != split_key])
    train_df = train_df.select(*kept).persist(StorageLevel.MEMORY_AND_DISK)
    stages = spec.stages()
    t0 = time.time()
    try:
        rows = spec.check(train_df, numeric_nulls=True)
        if use_cv:
            lr = classifier("logreg", max_iter=max_iter)
            grid = (ParamGridBuilder().addGrid(lr.regParam, list(reg_grid))
                    .addGrid(lr.elasticNetParam, list(elastic_grid)).build())
            if not split_key:
                train_df = train_df.withColumn("_fold", F.floor(F.rand(seed) * folds).cast("int")) \
                    .persist(StorageLevel.MEMORY_AND_DISK)
            auc = cross_validate(train_df, stages, lr, grid, folds, parallelism)
            model = Pipeline(stages=stages + [lr.copy(grid[auc.index(max(auc))])]).fit(train_df)
            extra = {"cv_avg_auc": auc}
        elif model_type == "random_forest" and bag_bytes(rows, num_trees) > most_bag_bytes:
            model = fit_counted(train_df, spec, rows, num_trees, seed, partitions or shuffle_partitions(df.sparkSession))
            extra = {}
        else:
            clf = classifier(model_type, max_iter=max_iter, num_trees=num_trees, seed=seed)
            model = Pipeline(stages=stages + [clf]).fit(train_df)
            extra = {}
    finally:
        train_df.unpersist()
    fit_time = time.time() - t0
    preds = model.transform(test_df)
    acc_row = accuracy(preds).collect()[0]
    metrics = {"model_type": model_type, "fit_time_sec": fit_time,
               "accuracy": float(acc_row["accuracy"] or 0.0),
               "test_rows": int(acc_row["n"]), "train_rows": rows,
               "feature_count": feature_count(model, spec), **extra}
    return TrainResult(model=model, metrics=metrics, test=preds)


def cross_validate(df: DataFrame, stages: Sequence, estimator, grid: Sequence[dict], folds: int,
                   parallelism: int = CV_PARALLELISM) -> list[float]:
    """Mean AUC of each grid point over the folds named in ``_fold`` (a fold whose held
    rows have one class only counts as 0.5). The feature stages are fitted once per fold;
    only the classifier is fitted per point. The held rows are scored by all of a fold's
    models in one plan, and one job gives the exact AUC of every point."""
    totals = [0.0] * len(grid)
    for k in range(folds):
        features = Pipeline(stages=list(stages)).fit(df.where(F.col("_fold") != k))
        ready = features.transform(df).select("features", "label", "_fold") \
            .persist(StorageLevel.MEMORY_AND_DISK)
        rest, held = ready.where(F.col("_fold") != k), ready.where(F.col("_fold") == k)
        with ThreadPool(parallelism) as pool:
            models = pool.map(lambda point: estimator.fit(rest, point), grid)
        found = {r["point"]: r["auc"] for r in auc_by(grid_scores(models, held), ["point"], bounded_groups=True).collect()}
        for i in range(len(grid)):
            value = found.get(i)
            totals[i] += 0.5 if value is None else value
        ready.unpersist()
    return [t / folds for t in totals]


def grid_scores(models: Sequence, df: DataFrame) -> DataFrame:
    """(point, label, score): the raw score of class 1 by each model, unpivoted."""
    out = df
    for i, model in enumerate(models):
        scorer = model.copy().setRawPredictionCol(f"_raw_{i}").setProbabilityCol("").setPredictionCol("")
        out = scorer.transform(out)
    cells = [F.struct(F.lit(i).alias("point"), F.get(vector_to_array(F.col(f"_raw_{i}")), F.lit(1)).alias("score"))
             for i in range(len(models))]
    return out.select("label", F.inline(F.array(*cells)))


def final_stage(model: PipelineModel):
    return model.stages[-1] if hasattr(model, "stages") and model.stages else None


def feature_count(model: PipelineModel, spec: FeatureSpec) -> int:
    stage = final_stage(model)
    n = getattr(stage, "numFeatures", None)
    return int(n) if n is not None else -1


def feature_names(model: PipelineModel, spec: FeatureSpec) -> list:
    """Slot names of the assembled vector: numeric names, then
    ``<column>=<category>`` for each one-hot slot."""
    names = list(spec.numeric)
    labels_by_col = {}
    for stage in model.stages:
        if hasattr(stage, "labelsArray") and spec.categorical:
            for c, labels in zip(spec.categorical, stage.labelsArray):
                labels_by_col[c] = list(labels)
    for c in spec.categorical:
        names += [f"{c}={v}" for v in labels_by_col.get(c, [])]
    return names


def coefficients(spark: SparkSession, model: PipelineModel, spec: FeatureSpec) -> DataFrame:
    """(feature, weight) for logistic regression, (feature, importance) for
    forests, plus the intercept row for logistic regression."""
    stage = final_stage(model)
    names = feature_names(model, spec)
    if hasattr(stage, "coefficients"):
        weights = stage.coefficients.toArray().tolist()
        rows = [(n, float(w)) for n, w in zip(names, weights)]
        rows.append(("(intercept)", float(stage.intercept)))
    else:
        imp = stage.featureImportances.toArray().tolist()
        rows = [(n, float(w)) for n, w in zip(names, imp)]
    return spark.createDataFrame(rows, "feature string, weight double")



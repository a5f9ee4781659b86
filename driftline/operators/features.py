"""Feature encoding with Spark ML: category index, one-hot, vector assembly,
derived count features and a partition-independent train/test split."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import hash_bucket, hash_split
from ..session import shuffle_partitions
from .ranking import running_totals


class NullFeatureError(ValueError):
    """Nulls reached a numeric feature; logistic regression would fail on
    the NaN the assembler keeps, so we stop earlier with the column names."""


class HighCardinalityError(ValueError):
    """A categorical column has more categories than the index may collect
    to the driver."""


@dataclass
class FeatureSpec:
    """Which columns become features, and how.

    ``numeric`` go in as they are, then one one-hot block per
    ``categorical`` column (index: frequency descending, ties
    alphabetical; unseen or null values get the extra index K, whose
    one-hot is all zeros). ``derived`` (name → SQL expression) adds computed
    columns first, as a stage of the pipeline, so a saved model scores raw
    records. ``max_categories`` refuses wider columns (None: no limit; the labels
    of the index then live on the driver and in the model, whatever their number;
    ``index_categories`` indexes without that).
    """

    numeric: list = field(default_factory=list)
    categorical: list = field(default_factory=list)
    label: str | None = None
    derived: Mapping[str, str] = field(default_factory=dict)
    features_col: str = "features"
    max_categories: int | None = None

    def prepare(self, df: DataFrame) -> DataFrame:
        """Rename the target to ``label``."""
        out = df
        if self.label and self.label != "label" and self.label in out.columns:
            out = out.withColumnRenamed(self.label, "label")
        return out

    def index_cols(self) -> list:
        return [f"{c}_idx" for c in self.categorical]

    def onehot_cols(self) -> list:
        return [f"{c}_ohe" for c in self.categorical]

    def assembler_inputs(self) -> list:
        return list(self.numeric) + self.onehot_cols()

    def derive(self, df: DataFrame) -> DataFrame:
        """Add the derived columns, as the pipeline's first stage does."""
        return SQLTransformer(statement=self._statement()).transform(df) if self.derived else df

    def _statement(self) -> str:
        made = ", ".join(f"{expression} AS `{name}`" for name, expression in self.derived.items())
        return f"SELECT *, {made} FROM __THIS__"

    def input_cols(self, df: DataFrame) -> list:
        """The columns of ``df`` that training reads, without the others."""
        wanted = {*self.numeric, *self.categorical, "label"}
        if self.derived:
            return df.columns
        return [c for c in df.columns if c in wanted]

    def stages(self) -> list:
        stages = [SQLTransformer(statement=self._statement())] if self.derived else []
        if self.categorical:
            stages.append(StringIndexer(inputCols=list(self.categorical),
                                        outputCols=self.index_cols(),
                                        handleInvalid="keep",
                                        stringOrderType="frequencyDesc"))
            stages.append(OneHotEncoder(inputCols=self.index_cols(),
                                        outputCols=self.onehot_cols(),
                                        dropLast=True))
        stages.append(VectorAssembler(inputCols=self.assembler_inputs(),
                                      outputCol=self.features_col, handleInvalid="keep"))
        return stages

    def check(self, df: DataFrame, numeric_nulls: bool = True) -> int:
        """One aggregation: nulls in numeric inputs, category counts. Returns
        the row count."""
        aggs = [F.count(F.lit(1)).alias("_rows")]
        if numeric_nulls:
            aggs += [F.count_if(F.col(c).isNull() | F.isnan(F.col(c).cast("double")))
                     .alias(f"n_{i}") for i, c in enumerate(self.numeric)]
        if self.max_categories:
            aggs += [F.approx_count_distinct(c).alias(f"k_{i}")
                     for i, c in enumerate(self.categorical)]
        row = self.derive(df).agg(*aggs).collect()[0]
        if numeric_nulls:
            bad = [c for i, c in enumerate(self.numeric) if row[f"n_{i}"]]
            if bad:
                raise NullFeatureError(f"null or NaN values in numeric features: {bad}")
        if self.max_categories:
            wide = [c for i, c in enumerate(self.categorical)
                    if row[f"k_{i}"] > self.max_categories]
            if wide:
                raise HighCardinalityError(
                    f"more than {self.max_categories} categories in {wide}")
        return int(row["_rows"])

    def fit(self, df: DataFrame, check: bool = True) -> PipelineModel:
        prepared = self.prepare(df)
        if check:
            self.check(prepared, numeric_nulls=False)
        return Pipeline(stages=self.stages()).fit(prepared)


# The reference's column layouts for its passenger table.
# Training: [Pclass, Age, SibSp, Parch, Fare] as numbers (those present), then
# one-hot blocks for Sex, Embarked, Pclass in table order.
TRAIN_NUMERIC = ["Pclass", "Age", "SibSp", "Parch", "Fare"]
TRAIN_CATEGORICAL = ["Sex", "Embarked", "Pclass"]
# Fallback/serving layout: Age, Fare, FamilySize, IsAlone, then one-hot blocks
# for Sex, Embarked, Pclass.
SERVE_NUMERIC = ["Age", "Fare"]
SERVE_CATEGORICAL = ["Sex", "Embarked", "Pclass"]


def training_spec(columns: Sequence[str], target: str = "Survived") -> FeatureSpec:
    """The training layout over the columns that exist."""
    cols = list(columns)
    return FeatureSpec(numeric=[c for c in TRAIN_NUMERIC if c in cols],
                       categorical=[c for c in cols if c in TRAIN_CATEGORICAL],
                       label=target)


def serving_spec(columns: Sequence[str], target: str = "Survived") -> FeatureSpec:
    """The fallback layout: adds FamilySize and IsAlone when both counts exist."""
    cols = list(columns)
    numeric = [c for c in SERVE_NUMERIC if c in cols]
    derived = {}
    if "SibSp" in cols and "Parch" in cols:
        derived = {"FamilySize": "SibSp + Parch + 1",
                   "IsAlone": "CASE WHEN SibSp + Parch = 0 THEN 1 ELSE 0 END"}
        numeric += ["FamilySize", "IsAlone"]
    return FeatureSpec(numeric=numeric,
                       categorical=[c for c in SERVE_CATEGORICAL if c in cols],
                       label=target, derived=derived)


def encode(df: DataFrame, spec: FeatureSpec, model: PipelineModel | None = None,
           keep: Sequence[str] = ()) -> DataFrame:
    """Fit (unless given) and apply the feature stages."""
    model = model or spec.fit(df)
    out = model.transform(spec.prepare(df))
    if keep:
        return out.select(*keep)
    return out


def category_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(_dl_col, _dl_c, _dl_n): rows by category of every column, negated, from one scan
    of the table; nulls are no category."""
    wide = df.select(*[F.col(c).cast("string").alias(c) for c in cols])
    return wide.unpivot([], list(cols), "_dl_col", "_dl_c").where("_dl_c IS NOT NULL") \
        .groupBy("_dl_col", "_dl_c").agg((-F.count(F.lit(1))).alias("_dl_n"))


def index_categories(df: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, dict[str, int]]:
    """(``df`` with ``<c>_idx`` per column, number of categories by column).

    Index by frequency, ties alphabetical; null gets the extra index K, as in the
    pipeline. One unpivoted count serves all columns, and one distributed running total
    ranks the categories of each, so that no column's labels need to fit on the driver.

    The ranks come back by two joins per column. Categories that would fill a
    partition by themselves (at most as many as there are partitions) are broadcast; only
    the rows of other categories meet the rest of the ranks in a shuffle, and the rows
    already answered are spread over it by a salt.
    """
    spark = df.sparkSession
    parts = shuffle_partitions(spark)
    counts = category_counts(df, cols).withColumn("_dl_i", F.lit(1).cast("long"))
    ranked = running_totals(counts, ["_dl_n", "_dl_c"], ["_dl_i"], by=["_dl_col"], bounded_groups=True)
    ranked = ranked.select("_dl_col", "_dl_c", (F.col("_dl_i_cum") - 1).cast("double").alias("_dl_at"), "_dl_n").checkpoint()
    # One row per column.
    totals = {r["_dl_col"]: r for r in ranked.groupBy("_dl_col").agg(
        F.count("*").alias("k"), (-F.sum("_dl_n")).alias("rows"), F.max(-F.col("_dl_n")).alias("most"),
        F.min(-F.col("_dl_n")).alias("least")).collect()}
    sizes = {}
    for c in cols:
        of = totals.get(c)
        sizes[c] = int(of["k"]) if of else 0
        found = []
        if of:
            hot = -F.col("_dl_n") * parts > of["rows"]
            ranks = ranked.where(F.col("_dl_col") == c)
            if of["most"] * parts > of["rows"]:
                top = ranks.where(hot).select(F.col("_dl_c").alias("_dl_hot"), F.col("_dl_at").alias("_dl_hot_at"))
                df = df.join(F.broadcast(top), F.col(c).cast("string") == F.col("_dl_hot"), "left")
                found.append("_dl_hot_at")
            if of["least"] * parts <= of["rows"]:
                answered = F.col(c).isNull() | (F.col("_dl_hot_at").isNotNull() if found else F.lit(False))
                salt = F.when(answered, F.pmod(F.monotonically_increasing_id(), F.lit(parts)) + 1).otherwise(0)
                rest = ranks.where(~hot).select(F.lit(0).cast("long").alias("_dl_salt"), "_dl_c", "_dl_at")
                df = df.withColumns({"_dl_salt": salt.cast("long"), "_dl_c": F.when(~answered, F.col(c).cast("string")).otherwise("")}) \
                    .join(rest, ["_dl_salt", "_dl_c"], "left")
                found.append("_dl_at")
        at = F.coalesce(*found, F.lit(float(sizes[c])))
        df = df.withColumn(f"{c}_idx", at).drop("_dl_hot", "_dl_hot_at", "_dl_salt", "_dl_c", "_dl_at")
    return df, sizes


def hot_slot(index_col: str, size: int) -> Column:
    """Index of the 1 in the one-hot block of an index column, null for index K."""
    return F.when(F.col(index_col) < size, F.col(index_col).cast("int"))


def feature_slots(df: DataFrame, spec: FeatureSpec, model: PipelineModel,
                  keys: Sequence[str]) -> DataFrame:
    """The non-zero (keys..., slot, value) of encoded rows, from the numeric and index
    columns: no vector is expanded to its whole width."""
    labels = next((s.labelsArray for s in model.stages if hasattr(s, "labelsArray")), [])
    slots = [F.struct(F.lit(i).alias("slot"), F.col(c).cast("double").alias("value"))
             for i, c in enumerate(spec.numeric)]
    at = len(slots)
    for c, names in zip(spec.categorical, labels):
        hot = hot_slot(f"{c}_idx", len(names))
        slots.append(F.struct((hot + at).alias("slot"),
                              F.when(hot.isNotNull(), 1.0).otherwise(0.0).alias("value")))
        at += len(names)
    return df.select(*keys, F.inline(F.array(*slots))).where("value <> 0")


def split_by_hash(df: DataFrame, key: str, seed: int = 42, test_fraction: float = 0.2):
    """(train, test) by a hash of the key: the same rows whatever the
    partitioning, unlike ``randomSplit``."""
    flag = hash_split(key, seed, 1.0 - test_fraction)
    return df.where(flag), df.where(~flag)


def fold_column(key: str, seed: int, folds: int) -> Column:
    """Stable fold number in [0, folds) for CrossValidator's ``foldCol``."""
    return (hash_bucket(key, seed + 1, 1_000_000) % F.lit(folds)).cast("int")

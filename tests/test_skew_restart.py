"""Hot keys (a third of all rows in one group) and stream restarts."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import Window

from driftline.operators import drift as D
from driftline.operators import evaluate as E
from driftline.operators.runs import run_series
from driftline.session import scratch_path
from driftline.sources import io
from driftline.streaming import score as SC
from test_features_eval import auc_numpy


def test_run_index_with_hot_experiment(spark):
    n = 3000
    exp = ["hot"] * (n // 3) + [f"e{i % 50}" for i in range(n - n // 3)]
    pdf = pd.DataFrame({"experiment": exp,
                        "timestamp": [f"2024-01-01T00:00:{i:06d}Z" for i in range(n)],
                        "accuracy": ["0.5"] * n, "fit_time_sec": ["1.0"] * n,
                        "shuffle_partitions": ["8"] * n})
    df = spark.createDataFrame(pdf.sample(frac=1.0, random_state=1))
    got = run_series(df).select("experiment", "timestamp", "run_index")
    ref = df.select("experiment", "timestamp", F.row_number().over(
        Window.partitionBy("experiment").orderBy("timestamp")).alias("ref"))
    joined = got.join(ref, ["experiment", "timestamp"])
    assert joined.count() == n
    assert joined.where(F.col("run_index") != F.col("ref")).count() == 0


def test_auc_with_hot_score(spark):
    rng = np.random.default_rng(21)
    scores = np.concatenate([np.full(1500, 3.0), rng.normal(size=3000).round(2)])
    labels = (rng.random(4500) < 0.4).astype(float)
    df = spark.createDataFrame(pd.DataFrame({"label": labels, "score": scores}))
    got = E.auc_exact(df, "label", "score", num_partitions=6).collect()[0].auc
    assert got == pytest.approx(auc_numpy(labels, scores), abs=1e-12)


def test_chi_square_with_hot_category(spark):
    base = ["hot"] * 400 + ["a", "b", "c"] * 100
    new = ["hot"] * 300 + ["a", "b", "c", "d"] * 80
    df = spark.createDataFrame([("base", v) for v in base] + [("new", v) for v in new],
                               "side string, c string").repartition(7)
    r = D.chi_square(df, ["c"]).collect()[0]
    # 2 x 5 table computed by hand
    cats = ["a", "b", "c", "d", "hot"]
    obs = np.array([[base.count(c) for c in cats], [new.count(c) for c in cats]], float)
    exp = obs.sum(1, keepdims=True) * obs.sum(0, keepdims=True) / obs.sum()
    assert r.statistic == pytest.approx(((obs - exp) ** 2 / exp).sum(), rel=1e-12)


def test_score_stream_restart_has_no_duplicates(spark):
    from driftline.operators import features as FE
    from driftline.operators import train as TR
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"k": np.arange(300), "x1": rng.normal(size=300)})
    pdf["y"] = (pdf.x1 > 0).astype(float)
    df = spark.createDataFrame(pdf)
    spec = FE.FeatureSpec(numeric=["x1"], label="y")
    model_path = io.save_model(TR.fit(df, spec, "logreg", split_key="k").model,
                               scratch_path(spark, "rm"))
    src, sink, ck = (scratch_path(spark, "rsrc"), scratch_path(spark, "rsink"),
                     scratch_path(spark, "rck"))
    schema = df.drop("y").schema
    df.where("k < 150").drop("y").write.parquet(src + "/a")
    SC.score_stream(spark, spark.readStream.schema(schema).parquet(src + "/*"), model_path,
                    sink, ck, keys=["k"]).awaitTermination()
    df.where("k >= 150").drop("y").write.parquet(src + "/b")
    # Restart from the same checkpoint: only the new files are processed.
    SC.score_stream(spark, spark.readStream.schema(schema).parquet(src + "/*"), model_path,
                    sink, ck, keys=["k"]).awaitTermination()
    out = spark.read.parquet(sink)
    assert out.count() == 300 and out.select("k").distinct().count() == 300


def test_foreach_batch_retry_is_idempotent(spark):
    """Re-executing the same micro-batches (same epoch ids, as after a lost
    commit) replaces their output instead of appending to it."""
    from driftline.streaming import drift as SD
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    base = ev.where(F.col("ts") < F.lit("2024-01-08 00:00:00").cast("timestamp_ntz"))
    sink = scratch_path(spark, "isink")

    def run(ck):
        stream = (spark.readStream.schema(ev.schema).option("pathGlobFilter", "events.parquet")
                  .parquet("/root/testdata/sf0.001"))
        SD.drift_by_window_stream(stream, "ts", ["value"], base, sink, ck).awaitTermination()
        return spark.read.parquet(sink).count()

    first = run(scratch_path(spark, "ick1"))
    assert first > 0
    assert run(scratch_path(spark, "ick2")) == first

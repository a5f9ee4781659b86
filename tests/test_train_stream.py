import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from driftline.operators import features as FE
from driftline.operators import train as TR
from driftline.operators.runs import append_run, run_row, run_series
from driftline.plans import jobs
from driftline.session import scratch_path
from driftline.sources import io
from driftline.streaming import drift as SD
from driftline.streaming import score as SC
from conftest import SF_SMALL


def logistic_numpy(X, y, iters=50):
    """Newton-Raphson maximum likelihood (independent oracle)."""
    X1 = np.column_stack([X, np.ones(len(X))])
    w = np.zeros(X1.shape[1])
    for _ in range(iters):
        p = 1 / (1 + np.exp(-X1 @ w))
        g = X1.T @ (y - p)
        H = (X1 * (p * (1 - p))[:, None]).T @ X1
        w += np.linalg.solve(H, g)
    return w


def labelled(spark, n=600, seed=0):
    rng = np.random.default_rng(seed)
    x1, x2 = rng.normal(size=n), rng.normal(size=n)
    y = (1.5 * x1 - 0.7 * x2 + 0.3 + rng.logistic(size=n) > 0).astype(float)
    cat = np.where(rng.random(n) < 0.5, "u", "v")
    pdf = pd.DataFrame({"k": np.arange(n), "x1": x1, "x2": x2, "c": cat, "y": y})
    return spark.createDataFrame(pdf), pdf


def test_logreg_matches_newton(spark):
    df, pdf = labelled(spark)
    spec = FE.FeatureSpec(numeric=["x1", "x2"], label="y")
    res = TR.fit(df, spec, "logreg", split_key="k", test_fraction=0.2)
    train_keys = {r.k for r in FE.split_by_hash(df, "k")[0].collect()}
    sub = pdf[pdf.k.isin(train_keys)]
    w = logistic_numpy(sub[["x1", "x2"]].to_numpy(), sub.y.to_numpy())
    stage = TR.final_stage(res.model)
    assert np.allclose(stage.coefficients.toArray(), w[:2], atol=1e-3)
    assert stage.intercept == pytest.approx(w[2], abs=1e-3)
    assert 0.6 < res.metrics["accuracy"] <= 1.0
    coef = {r.feature: r.weight for r in TR.coefficients(spark, res.model, spec).collect()}
    assert set(coef) == {"x1", "x2", "(intercept)"}


def test_forest_seeded_is_deterministic(spark):
    df, _ = labelled(spark, 300, 1)
    spec = FE.FeatureSpec(numeric=["x1", "x2"], categorical=["c"], label="y")
    a = TR.fit(df, spec, "random_forest", split_key="k", num_trees=5)
    # The seed fixes the bootstrap for a given input layout (Spark samples
    # per partition), so the same frame gives the same forest.
    b = TR.fit(df, spec, "random_forest", split_key="k", num_trees=5)
    assert a.metrics["feature_count"] == 4
    assert a.metrics["accuracy"] == b.metrics["accuracy"]


def test_cross_validation_small_grid(spark):
    df, _ = labelled(spark, 200, 2)
    spec = FE.FeatureSpec(numeric=["x1", "x2"], label="y")
    res = TR.fit(df, spec, "logreg", split_key="k", cv=True, reg_grid=(0.0, 0.1),
                 elastic_grid=(0.0,), folds=2, parallelism=2)
    assert len(res.metrics["cv_avg_auc"]) == 2
    assert all(0.5 < m <= 1.0 for m in res.metrics["cv_avg_auc"])


def test_stream_scoring_equals_batch(spark):
    df, _ = labelled(spark, 400, 3)
    spec = FE.FeatureSpec(numeric=["x1", "x2"], categorical=["c"], label="y")
    res = TR.fit(df, spec, "logreg", split_key="k")
    model_path = io.save_model(res.model, scratch_path(spark, "m"))
    src = scratch_path(spark, "src")
    df.drop("y").repartition(4).write.parquet(src)
    stream = spark.readStream.schema(df.drop("y").schema).parquet(src)
    sink = scratch_path(spark, "sink")
    q = SC.score_stream(spark, stream, model_path, sink, scratch_path(spark, "ck"), keys=["k"])
    q.awaitTermination()
    got = {r.k: (r.prediction, tuple(r.probability)) for r in spark.read.parquet(sink).collect()}
    exp = {r.k: (r.prediction, tuple(r.probability))
           for r in SC.score_batch(io.load_model(model_path), df.drop("y"), ["k"]).collect()}
    assert got == exp and len(got) == 400


def test_follow_model_swaps_between_batches(spark):
    df, _ = labelled(spark, 200, 4)
    spec = FE.FeatureSpec(numeric=["x1", "x2"], label="y")
    m1 = io.save_model(TR.fit(df, spec, "logreg", split_key="k").model, scratch_path(spark, "m1"))
    m2 = io.save_model(TR.fit(df, spec, "logreg", split_key="k", max_iter=1).model,
                       scratch_path(spark, "m2"))
    pointer = scratch_path(spark, "pointer")
    src = scratch_path(spark, "fsrc")
    sink, ck = scratch_path(spark, "fsink"), scratch_path(spark, "fck")
    schema = df.drop("y").schema
    spark.createDataFrame([(m1,)], "value string").write.text(pointer)
    df.where("k < 100").drop("y").write.parquet(src + "/a")
    q = SC.follow_model(spark, spark.readStream.schema(schema).parquet(src + "/*"), pointer,
                        sink, ck, keys=["k"])
    q.awaitTermination()
    spark.createDataFrame([(m2,)], "value string").write.mode("overwrite").text(pointer)
    df.where("k >= 100").drop("y").write.parquet(src + "/b")
    q = SC.follow_model(spark, spark.readStream.schema(schema).parquet(src + "/*"), pointer,
                        sink, ck, keys=["k"])
    q.awaitTermination()
    out = spark.read.parquet(sink)
    used = {r.k: r.model_path for r in out.collect()}
    assert len(used) == 200
    assert {used[k] for k in range(100)} == {m1}
    assert {used[k] for k in range(100, 200)} == {m2}


def test_window_drift_stream_equals_batch(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    base = ev.where(F.col("ts") < F.lit("2024-01-08 00:00:00").cast("timestamp_ntz"))
    batch = {(r.window_start, r.column): r.psi
             for r in SD.drift_by_window_batch(ev, "ts", ["value"], base).collect()}
    stream = (spark.readStream.schema(ev.schema).option("pathGlobFilter", "events.parquet")
              .parquet(SF_SMALL))
    sink = scratch_path(spark, "wsink")
    q = SD.drift_by_window_stream(stream, "ts", ["value"], base, sink,
                                  scratch_path(spark, "wck"), watermark="1 hour")
    q.awaitTermination()
    got = {(r.window_start, r.column): r.psi for r in spark.read.parquet(sink).collect()}
    assert 0 < len(got) <= len(batch)
    assert len(got) >= len(batch) - 1  # the last window may still be open
    for key, v in got.items():
        assert v == pytest.approx(batch[key], abs=1e-12)


def test_run_rows_and_series(spark):
    path = scratch_path(spark, "runs")
    append_run(run_row(spark, "exp", "logreg", 1.234567, 0.8123456, 100, 5), path)
    append_run(run_row(spark, "exp", "logreg", 2.0, 0.9, 100, 5), path)
    runs = spark.read.parquet(path)
    r = runs.collect()[0]
    assert r.timestamp.endswith("Z") and len(r.timestamp) == 20
    assert r.fit_time_sec in (1.2346, 2.0)
    text = runs.select(*[F.col(c).cast("string").alias(c) for c in runs.columns])
    text = text.union(text.limit(1).withColumn("accuracy", F.lit("bad"))
                      .withColumn("timestamp", F.lit("9999-12-31T00:00:00Z")))
    series = run_series(text).orderBy("run_index").collect()
    assert [s.run_index for s in series] == [1, 2, 3]
    assert series[-1].accuracy == 0.0


def test_retrain_gate(spark):
    df, _ = labelled(spark, 300, 5)
    spec = FE.FeatureSpec(numeric=["x1", "x2"], label="y")
    base = df.select("x1", "x2")
    shifted = df.select((F.col("x1") + 3).alias("x1"), "x2")
    d, res = jobs.retrain_on_drift(base, shifted, df, spec, split_key="k")
    assert d.collect()[0].asDict() == {"drift": True, "check_failed": False, "check_error": None,
                                      "forced": False, "retrained": True}
    assert res is not None
    d, res = jobs.retrain_on_drift(base, base, df, spec, split_key="k")
    assert d.collect()[0].retrained is False and res is None
    d, res = jobs.retrain_on_drift(base, base, df, spec, split_key="k", force=True)
    assert d.collect()[0].retrained is True and res is not None


def test_records_to_frame_and_score(spark):
    from driftline.streaming.score import records_to_frame
    rows = [{"Age": 29.0, "Fare": 35.0, "SibSp": 1, "Parch": 0, "Sex": "male",
             "Embarked": "S", "Pclass": 3},
            {"Age": 22.0, "Fare": 7.25, "SibSp": 1, "Parch": 0, "Sex": "male",
             "Embarked": "S", "Pclass": 3}]
    df = records_to_frame(spark, rows)
    assert dict(df.dtypes) == {"Age": "double", "Fare": "double", "SibSp": "int", "Parch": "int",
                               "Sex": "string", "Embarked": "string", "Pclass": "int"}
    train = records_to_frame(spark, rows * 20).withColumn(
        "Survived", (F.col("Fare") > 10).cast("double"))
    spec = FE.serving_spec(train.columns)
    res = TR.fit(train.withColumn("k", F.monotonically_increasing_id()), spec, "logreg",
                 split_key="k")
    out = SC.score_batch(res.model, df).collect()
    assert [r.prediction for r in out] in ([1, 0], [0, 0], [1, 1], [0, 1])
    assert all(len(r.probability) == 2 for r in out)


def test_train_and_record(spark):
    df, _ = labelled(spark, 200, 6)
    spec = FE.FeatureSpec(numeric=["x1", "x2"], label="y")
    path = scratch_path(spark, "runs2")
    res = jobs.train_and_record(df, spec, path, experiment="e1", split_key="k",
                                model_path=scratch_path(spark, "m3"))
    row = spark.read.parquet(path).collect()[0]
    assert row.experiment == "e1" and row.dataset_rows == 200 and row.feature_count == 2
    assert row.accuracy == round(res.metrics["accuracy"], 6)


def test_read_runs_text_and_empty(spark):
    from driftline.operators.runs import EmptyRunHistory, read_runs
    path = scratch_path(spark, "runs-csv")
    spark.createDataFrame([("2024-01-01T00:00:00Z", "e", "0.9", "1.5", "8")],
                          "timestamp string, experiment string, accuracy string, "
                          "fit_time_sec string, shuffle_partitions string") \
        .write.option("header", True).csv(path)
    runs = read_runs(spark, path)
    assert set(t for _, t in runs.dtypes) == {"string"}
    assert run_series(runs).collect()[0].accuracy == 0.9
    empty = scratch_path(spark, "runs-empty")
    spark.createDataFrame([], "timestamp string, experiment string").write \
        .option("header", True).csv(empty)
    with pytest.raises(EmptyRunHistory):
        read_runs(spark, empty)


def test_report_prepare_both_and_include_new(spark):
    from driftline.operators.prep import fill_constants
    base = spark.createDataFrame([(float(i % 10), "a" if i % 3 else None) for i in range(60)],
                                 "x double, c string")
    new = spark.createDataFrame([(None if i % 4 == 0 else float(i % 10), "a") for i in range(60)],
                                "x double, c string")
    plain = {r.column: r for r in jobs.drift_report(base, new).collect()}
    filled = {r.column: r for r in jobs.drift_report(
        base, new, prepare_both=lambda d: fill_constants(d, {"x": 0.0, "c": "a"})).collect()}
    assert plain["c"].statistic != filled["c"].statistic   # 'nan' category gone after fill
    assert filled["c"].dof == 0 and filled["c"].p_value == 1.0
    df, _ = labelled(spark, 200, 7)
    spec = FE.FeatureSpec(numeric=["x1", "x2"], label="y")
    shifted = df.withColumn("x1", F.col("x1") + 5).withColumn("k", F.col("k") + 1000)
    ids = ["k", "y", "c"]
    d, res = jobs.retrain_on_drift(df, shifted, df, spec, id_cols=ids, split_key="k",
                                   include_new=False)
    d2, res2 = jobs.retrain_on_drift(df, shifted, df, spec, id_cols=ids, split_key="k",
                                     include_new=True)
    with pytest.raises(ValueError):
        jobs.retrain_on_drift(df, shifted.drop("y"), df, spec, id_cols=ids, split_key="k",
                              include_new=True)
    assert d.collect()[0].retrained and d2.collect()[0].retrained
    assert res2.metrics["test_rows"] > res.metrics["test_rows"]


def test_window_chi_square_stream_equals_batch(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    base = ev.where(F.col("ts") < F.lit("2024-01-08 00:00:00").cast("timestamp_ntz"))
    batch = {(r.window_start, r.column): (r.statistic, r.p_value, r.k)
             for r in SD.chi_square_by_window_batch(ev, "ts", ["event_type"], base).collect()}
    stream = (spark.readStream.schema(ev.schema).option("pathGlobFilter", "events.parquet")
              .parquet(SF_SMALL))
    sink = scratch_path(spark, "csink")
    SD.chi_square_by_window_stream(stream, "ts", ["event_type"], base, sink,
                                   scratch_path(spark, "cck")).awaitTermination()
    got = {(r.window_start, r.column): (r.statistic, r.p_value, r.k)
           for r in spark.read.parquet(sink).collect()}
    assert len(batch) - 1 <= len(got) <= len(batch)
    for key, (stat, p, k) in got.items():
        assert k == batch[key][2]
        assert stat == pytest.approx(batch[key][0], rel=1e-12)
        assert p == pytest.approx(batch[key][1], abs=1e-12)

"""CSV typing by pattern, JSON nulls, windows without values, streams over a file and
over a folder, and a model that scores raw records."""

import json

import pytest
from pyspark.sql import functions as F

from driftline.functions.exprs import tolerant_double, tolerant_int
from driftline.operators import features as FE
from driftline.operators import train as TR
from driftline.plans import jobs
from driftline.session import scratch_path
from driftline.sources import io
from driftline.streaming import drift as SD
from driftline.streaming import score as SC


def _csv(spark, rows, names):
    path = scratch_path(spark, "typed-csv")
    io.write_csv(spark.createDataFrame([tuple(map(str, r)) for r in rows], ", ".join(f"{n} string" for n in names)), path)
    return path


def test_types_by_pattern(spark):
    rows = [("33D", "True", "1", "1.5", "7", "1e3"), ("14F", "False", "2", "-.5", "x", "inf"), ("7d", "true", "-3", "2.", "8", "NA")]
    back = io.read_csv(spark, _csv(spark, rows, ["cabin", "flag", "whole", "real", "mixed", "exp"]))
    assert dict(back.dtypes) == {"cabin": "string", "flag": "boolean", "whole": "bigint", "real": "double",
                                 "mixed": "string", "exp": "double"}
    assert sorted(r.cabin for r in back.collect()) == ["14F", "33D", "7d"]
    assert back.where("flag").count() == 2


def test_schema_refuses_values_that_do_not_fit(spark):
    path = _csv(spark, [("1", "33D"), ("x", "2")], ["a", "b"])
    with pytest.raises(io.UnparsableValues, match="'a': 1, 'b': 1"):
        io.read_csv(spark, path, schema="a int, b double")
    assert io.read_csv(spark, path, schema="a string, b string").count() == 2


def test_tolerant_parse_refuses_suffixes(spark):
    df = spark.createDataFrame([("33D",), ("7f",), ("2.5",), (None,), (" 4 ",)], "s string")
    got = [tuple(r) for r in df.select(tolerant_double("s"), tolerant_int("s", -1)).collect()]
    assert got == [(0.0, -1), (0.0, -1), (2.5, 2), (0.0, -1), (4.0, 4)]


def test_report_file_is_json_with_nulls(spark):
    report = spark.createDataFrame([("x", "numeric", None, None, None, None, "insufficient_data")], jobs.REPORT_SCHEMA)
    path = scratch_path(spark, "report")
    io.write_json_report(jobs.report_json(report), path)
    read = json.loads(spark.read.text(path).first()[0])
    assert read["numeric"] == {"x": {"psi": None, "status": "insufficient_data"}}
    assert read["thresholds"] == {"psi": 0.25, "chi_square_p": 0.01}


def test_window_without_values_keeps_its_row(spark):
    rows = [(f"2024-01-0{d} 10:00:0{i}", None if d == 2 else float(i)) for d in (1, 2, 3) for i in range(6)]
    df = spark.createDataFrame(rows, "t string, v double").select(F.col("t").cast("timestamp").alias("ts"), "v")
    out = SD.drift_by_window_batch(df, "ts", ["v"], df.where("ts < '2024-01-02'")).orderBy("window_start").collect()
    assert [(r.n_new, r.status) for r in out] == [(6, "ok"), (0, "insufficient_data"), (6, "ok")]
    report = SD.report_by_window_batch(df, "ts", df.where("ts < '2024-01-02'"))
    assert report.where("status = 'insufficient_data'").count() == 1


@pytest.mark.parametrize("parts", [1, 4])
def test_stream_reads_a_file_and_a_folder(spark, tmp_path, parts):
    from driftline.plans.queries import lineitem_stream
    rows = spark.range(100).select(F.col("id").alias("l_orderkey"))
    folder = tmp_path / "lineitem.parquet"
    rows.repartition(parts).write.parquet(str(folder))
    if parts == 1:
        one = next(folder.glob("part-*.parquet"))
        single = tmp_path / "file"
        single.mkdir()
        one.rename(single / "lineitem.parquet")
        root = single
    else:
        root = tmp_path
    sink = scratch_path(spark, "sunk")
    lineitem_stream(spark, str(root)).writeStream.format("parquet").option("path", sink) \
        .option("checkpointLocation", scratch_path(spark, "sunk-ckpt")).trigger(availableNow=True).start().awaitTermination()
    assert spark.read.parquet(sink).count() == 100


def test_saved_serving_model_scores_raw_records(spark):
    rows = [{"Age": 20.0 + i, "Fare": 5.0 * i, "SibSp": i % 3, "Parch": i % 2, "Sex": "male" if i % 2 else "female",
             "Embarked": "S", "Pclass": 1 + i % 3} for i in range(60)]
    raw = SC.records_to_frame(spark, rows)
    train = raw.withColumn("Survived", (F.col("SibSp") + F.col("Parch") > 1).cast("double")) \
        .withColumn("k", F.monotonically_increasing_id())
    spec = FE.serving_spec(train.columns)
    path, pointer = scratch_path(spark, "serving"), scratch_path(spark, "pointer")
    io.save_model(TR.fit(train, spec, "logreg", split_key="k").model, path)
    for target in ("nowhere", path):
        SC.publish_pointer(spark, pointer, target)
    assert SC.read_pointer(spark, pointer) == path
    assert SC.score_batch(io.load_model(path), raw).count() == 60


def test_failed_check_keeps_its_text_and_bugs_rise(spark, monkeypatch):
    df = spark.range(20).selectExpr("double(id) AS x", "double(id % 2) AS y", "id AS k")
    spec = FE.FeatureSpec(numeric=["x"], label="y")

    def refuse(*args, **kw):
        raise io.MissingInput("input missing: batch")

    monkeypatch.setattr(jobs, "drift_report", refuse)
    row = jobs.retrain_on_drift(df.select("x"), df.select("x"), df, spec)[0].first()
    assert (row.check_failed, row.check_error, row.retrained) == (True, "input missing: batch", False)
    monkeypatch.setattr(jobs, "drift_report", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        jobs.retrain_on_drift(df.select("x"), df.select("x"), df, spec)


def test_same_rows_and_partitions_give_the_same_forest(spark):
    df = spark.range(400).selectExpr("double(id % 17) AS a", "double(id % 5) AS b", "double((id % 17) > 8) AS label", "id AS k")
    spec = FE.FeatureSpec(numeric=["a", "b"], label="label")
    weights = [[r.weight for r in TR.coefficients(spark, TR.fit(
        x, spec, "random_forest", split_key="k", num_trees=5, partitions=4).model, spec).collect()]
        for x in (df, df.repartition(3).orderBy("k"))]
    assert weights[0] == weights[1]


def test_index_categories_matches_the_indexer(spark):
    rows = [("b",), ("a",), ("b",), ("c",), ("a",), (None,), ("d",)]
    df = spark.createDataFrame(rows, "s string")
    got, sizes = FE.index_categories(df, ["s"])
    assert sizes == {"s": 4}
    assert {(r.s, r.s_idx) for r in got.collect()} == {("a", 0.0), ("b", 1.0), ("c", 2.0), ("d", 3.0), (None, 4.0)}


@pytest.mark.parametrize("kinds", [2, 3, 40])
def test_window_chi_square_with_absent_categories(spark, kinds):
    """Windows that lack most of the baseline's categories, against the plain table."""
    from driftline.operators import drift as D
    base = spark.range(400).selectExpr("timestamp '2024-01-01 00:00:00' AS ts", f"string(pmod(id * id, {kinds})) AS c")
    new = spark.range(90).selectExpr("timestamp '2024-01-02 00:00:00' AS ts",
                                     f"CASE WHEN id % 30 = 0 THEN 'new' ELSE string(pmod(id, 2)) END AS c") \
        if kinds > 2 else spark.range(50).selectExpr("timestamp '2024-01-02 00:00:00' AS ts", "'0' AS c")
    got = SD.chi_square_by_window_batch(new, "ts", ["c"], base).first()
    want = D.chi_square(D.sided(base, new, ["c"]), ["c"]).first()
    assert (got.k, got.dof, got.n_base, got.n_new, got.status) == (want.k, want.dof, want.n_base, want.n_new, want.status)
    assert got.statistic == pytest.approx(want.statistic, rel=1e-12) and got.p_value == pytest.approx(want.p_value, rel=1e-9)


def test_report_stream_equals_batch(spark, tmp_path):
    rows = spark.range(3000).selectExpr(
        "timestamp '2024-01-01 00:00:00' + make_dt_interval(0, 0, id * 3) AS ts",
        "CASE WHEN id BETWEEN 960 AND 1439 THEN NULL ELSE double(id * 37 % 101) END AS v",
        "string(id % 4) AS c", "id")
    rows.write.parquet(str(tmp_path / "t.parquet"))
    df = spark.read.parquet(str(tmp_path / "t.parquet"))
    base = df.where("ts < '2024-01-02'")
    sink = scratch_path(spark, "report-stream")
    SD.report_by_window_stream(
        spark.readStream.schema(df.schema).parquet(str(tmp_path / "t.parquet")), "ts", base, sink,
        scratch_path(spark, "report-ckpt"), id_cols=["id"]).awaitTermination()
    got = spark.read.parquet(sink).drop("epoch")
    want = SD.report_by_window_batch(df, "ts", base, id_cols=["id"])
    last = df.agg(F.max(F.col("ts") - F.expr("interval 1 hour"))).first()[0]
    closed = want.where(F.col("window_end") <= F.lit(last))
    assert sorted(map(tuple, got.select(*closed.columns).collect()), key=str) == sorted(map(tuple, closed.collect()), key=str)
    assert got.where("status = 'insufficient_data'").count() >= 1 and got.count() >= 8

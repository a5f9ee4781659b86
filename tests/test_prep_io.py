import glob
import os

import pytest
from pyspark.errors import AnalysisException

from driftline.operators.prep import (fill_constants, fill_median, fill_unknown,
                                      keep_columns, medians)
from driftline.plans import jobs
from driftline.session import local_path, scratch_path
from driftline.sources import io


def test_keep_columns_orders(spark):
    df = spark.createDataFrame([(1, 2, 3)], "c int, a int, b int")
    assert keep_columns(df, ["a", "c", "zz"]).columns == ["c", "a"]
    assert keep_columns(df, ["a", "c", "zz"], order="list").columns == ["a", "c"]


def test_fill_constants_also_nan(spark):
    df = spark.createDataFrame([(None, float("nan"), None)], "Age double, Fare double, Embarked string")
    r = fill_constants(df, {"Age": 0.0, "Fare": 0.0, "Embarked": "S"}).collect()[0]
    assert (r.Age, r.Fare, r.Embarked) == (0.0, 0.0, "S")


def test_fill_constants_missing_column_fails(spark):
    df = spark.createDataFrame([(1.0,)], "Age double")
    with pytest.raises(AnalysisException):
        fill_constants(df, {"Fare": 0.0})


def test_median_fill_element_and_int_cast(spark):
    df = spark.createDataFrame([(1.0, 1), (4.0, 4), (None, None)], "x double, n int")
    assert medians(df, ["x"], exact=True) == {"x": 1.0}
    out = fill_median(df, ["x", "n"], exact=True).collect()
    assert out[2].x == 1.0 and out[2].n == 1
    df2 = spark.createDataFrame([(1, 2.5), (None, None)], "n int, y double")
    assert fill_median(df2, ["y"], exact=True).collect()[1].y == 2.5


def test_all_null_column_skipped(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0)], "x double, y double")
    assert "x" not in medians(df, ["x", "y"], exact=True)
    assert "x" not in medians(df, ["x", "y"], exact=False)


def test_baseline_job(spark):
    df = spark.createDataFrame(
        [(1, 0, None, 7.25, "male", None, 3), (2, 1, 38.0, None, None, "C", 1),
         (3, 1, 26.0, 7.9, "female", "S", 3)],
        "PassengerId int, Survived int, Age double, Fare double, Sex string, Embarked string, Pclass int")
    out = jobs.baseline(df, exact=True)
    assert out.columns == ["PassengerId", "Survived", "Age", "Fare", "Sex", "Embarked", "Pclass"]
    rows = out.orderBy("PassengerId").collect()
    assert rows[0].Age == 26.0 and rows[1].Fare == 7.25
    assert rows[1].Sex == "Unknown" and rows[0].Embarked == "Unknown"


def test_prepare_job(spark):
    df = spark.createDataFrame([(5, 0, 3, None, None, "x")],
                               "PassengerId int, Survived int, Pclass int, Age double, Fare double, Embarked string")
    out = jobs.prepare(df)
    assert out.columns == ["Survived", "Pclass", "Age", "Fare", "Embarked"]
    assert out.collect()[0].Age == 0.0


def test_csv_na_tokens_and_inference(spark):
    path = scratch_path(spark, "na-csv")
    src = spark.createDataFrame([("1", "NA", "2.5"), ("2", "n/a", "x"), ("3", "7", "NULL")],
                                "a string, b string, c string")
    io.write_csv(src, path)
    back = io.read_csv(spark, path)
    types = dict(back.dtypes)
    assert types["a"] == "bigint" and types["b"] == "bigint" and types["c"] == "string"
    rows = back.orderBy("a").collect()
    assert rows[0].b is None and rows[1].b is None and rows[2].b == 7
    assert rows[2].c is None


def test_missing_input(spark):
    with pytest.raises(io.MissingInput):
        io.read_table(spark, "/nonexistent/driftline/table.parquet").count()
    with pytest.raises(io.MissingInput):
        io.read_csv(spark, "/nonexistent/driftline/x.csv")


def test_csv_folder_export(spark):
    path = scratch_path(spark, "folder")
    df = spark.range(1000).repartition(5)
    io.write_csv(df, path)
    assert len(glob.glob(os.path.join(local_path(path), "part-*.csv"))) == 5
    back = io.read_csv(spark, path, schema="id long")
    assert back.count() == 1000 and back.agg({"id": "sum"}).collect()[0][0] == 499500


def test_json_report_sink(spark):
    path = scratch_path(spark, "json")
    df = spark.createDataFrame([("a", 0.1)], "column string, psi double")
    io.write_json_report(df, path)
    assert spark.read.json(path).collect()[0].psi == 0.1


def test_missing_model(spark):
    with pytest.raises(io.MissingInput):
        io.load_model(scratch_path(spark, "no-model"))

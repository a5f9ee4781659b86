"""Physical-plan properties the scale design relies on."""

from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL
from driftline.operators import drift as D
from driftline.plans import queries as Q


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_histogram_is_one_pruned_scan_without_python(spark):
    sides, cols = Q.lineitem_psi_frame(spark, SF_MID)
    edges = D.BinEdges(edges={c: [0.0, 1.0, 2.0, 3.0] for c in cols})
    plan = plan_of(D.histogram(sides, cols, edges))
    assert "EvalPython" not in plan                      # no Python UDF on the row path
    assert plan.count("FileScan parquet") == 1           # both sides from one scan
    assert "l_comment" not in plan and "l_partkey" not in plan   # pruned read schema
    assert "BroadcastHashJoin" in plan                   # edge table joined by broadcast


def test_report_pushes_date_filters_to_the_scan(spark):
    od = Q.table(spark, SF_MID, "orders")
    sides = D.sided(od.where(Q.orders_base()), od.where(~Q.orders_base()),
                    ["o_orderstatus"], cast={"o_orderstatus": "string"})
    plan = plan_of(D.contingency(sides, ["o_orderstatus"]))
    assert "LessThan(o_orderdate" in plan and "GreaterThanOrEqual(o_orderdate" in plan
    assert "EvalPython" not in plan


def test_report_counts_scan_each_side_once(spark):
    od = Q.table(spark, SF_MID, "orders")
    base, new = od.where(Q.orders_base()), od.where(~Q.orders_base())
    sides = D.sided(base, new, ["o_totalprice", "o_orderstatus"],
                    cast={"o_totalprice": "double", "o_orderstatus": "string"})
    edges = D.BinEdges(edges={"o_totalprice": [0.0, 1e5, 2e5, 6e5]})
    plan = plan_of(D.drift_counts(sides, ["o_totalprice"], ["o_orderstatus"], edges))
    assert plan.count("FileScan parquet") == 2           # base and new, once each
    assert "EvalPython" not in plan


def test_chi_square_p_value_stays_in_the_jvm(spark):
    df = spark.createDataFrame([("base", "a"), ("new", "b"), ("base", "b")], "side string, c string")
    plan = plan_of(D.chi_square(df, ["c"]))
    assert "EvalPython" not in plan


def test_edge_fit_pushes_the_lineitem_date_to_the_scan(spark):
    li, cols = Q.lineitem_numbers(spark, SF_MID)
    plan = plan_of(D.to_long(li.where(Q.lineitem_base()), cols))
    assert "LessThan(l_shipdate" in plan


def test_single_rows_stand_side_by_side_without_a_join(spark):
    one = spark.createDataFrame([(True, 3)], "drift boolean, n bigint")
    two = spark.createDataFrame([(None, "x")], "runs bigint, name string")
    before = spark.conf.get("spark.sql.crossJoin.enabled")
    spark.conf.set("spark.sql.crossJoin.enabled", "false")   # a session may refuse joins without a condition
    try:
        out = Q.side_by_side([one, two])
        assert out.dtypes == [("drift", "boolean"), ("n", "bigint"), ("runs", "bigint"), ("name", "string")]
        assert out.collect() == [(True, 3, None, "x")]
        rows = Q.q_retrain_committed(spark, SF_SMALL).collect() + Q.q_retrain_job(spark, SF_SMALL).collect()
        assert [r["scored"] for r in rows] == [spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()] * 2
    finally:
        spark.conf.set("spark.sql.crossJoin.enabled", before)

import numpy as np
import pandas as pd
import pytest

from driftline.operators.ranking import (exact_quantiles, lower_rank, order_statistics,
                                         running_totals)


def _frame(spark, values, key="k"):
    pdf = pd.DataFrame({"column": [key] * len(values), "value": np.asarray(values, float)})
    return spark.createDataFrame(pdf)


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_running_totals_match_cumsum(spark, parts):
    rng = np.random.default_rng(7)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, 500), "x": rng.normal(size=500).round(2),
                        "w": rng.integers(1, 5, 500)})
    pdf = pdf.groupby(["g", "x"], as_index=False)["w"].sum()
    df = spark.createDataFrame(pdf)
    got = running_totals(df, "x", ["w"], by=["g"], num_partitions=parts).toPandas()
    exp = pdf.sort_values(["g", "x"]).assign(w_cum=lambda d: d.groupby("g")["w"].cumsum())
    merged = got.merge(exp, on=["g", "x", "w"], suffixes=("", "_exp"))
    assert len(merged) == len(pdf)
    assert (merged["w_cum"] == merged["w_cum_exp"]).all()


def test_running_totals_global_order(spark):
    pdf = pd.DataFrame({"s": np.arange(100, dtype=float)[::-1], "n": np.ones(100, dtype=int)})
    got = running_totals(spark.createDataFrame(pdf), "s", ["n"], num_partitions=4).toPandas()
    got = got.sort_values("s")
    assert got["n_cum"].tolist() == list(range(1, 101))


@pytest.mark.parametrize("values", [
    [1.0, 4.0], [5.0] * 7, [0.0, 1.0] * 20, list(np.random.default_rng(1).normal(size=501)),
    list(np.random.default_rng(2).integers(0, 50, 1000).astype(float)),
])
def test_exact_linear_quantiles_equal_numpy(spark, values):
    probs = [i * 0.1 + 0.0 for i in range(10)] + [1.0]
    got = exact_quantiles(_frame(spark, values), "column", "value", probs, "linear",
                          num_partitions=3)["k"]
    exp = np.quantile(np.asarray(values), np.linspace(0, 1, 11))
    assert got["n"] == len(values)
    assert got["quantiles"] == [float(x) for x in exp]


def test_lower_median_is_an_element(spark):
    got = exact_quantiles(_frame(spark, [1.0, 4.0]), "column", "value", [0.5], "lower")
    assert got["k"]["quantiles"] == [1.0]
    vals = [3.0, 1.0, 2.0, 5.0, 4.0]
    got = exact_quantiles(_frame(spark, vals), "column", "value", [0.5], "lower")
    assert got["k"]["quantiles"] == [3.0]
    assert lower_rank(4, 0.5) == 1 and lower_rank(5, 0.5) == 2


def test_hot_value_holding_a_third_of_rows(spark):
    rng = np.random.default_rng(3)
    vals = np.concatenate([np.full(3000, 7.0), rng.normal(size=6000)])
    got = exact_quantiles(_frame(spark, vals), "column", "value",
                          [0.0, 0.25, 0.5, 0.75, 1.0], "linear", num_partitions=8)["k"]
    assert got["quantiles"] == [float(x) for x in np.quantile(vals, [0, .25, .5, .75, 1])]


def test_order_statistics_ranks(spark):
    vals = [5.0, 1.0, 1.0, 3.0]
    got = order_statistics(_frame(spark, vals), "column", "value", {"k": [0, 1, 2, 3]}, 2)
    assert got["k"] == {0: 1.0, 1: 1.0, 2: 3.0, 3: 5.0}


@pytest.mark.parametrize("values", [
    list(np.random.default_rng(8).normal(size=3000).round(3)),
    list(np.concatenate([np.full(1000, 7.0), np.random.default_rng(9).normal(size=2000)])),
    list(np.random.default_rng(10).integers(0, 20, 2500).astype(float)),
])
@pytest.mark.parametrize("method", ["linear", "lower"])
def test_bracketed_path_equals_whole_ranking(spark, values, method):
    probs = [i * 0.1 + 0.0 for i in range(10)] + [1.0]
    df = _frame(spark, values)
    whole = exact_quantiles(df, "column", "value", probs, method, num_partitions=3)["k"]
    # a coarse sketch makes the brackets wide, so that some of them meet
    br = exact_quantiles(df, "column", "value", probs, method, num_partitions=3,
                         accuracy=200)["k"]
    assert br["quantiles"] == whole["quantiles"]
    if method == "linear":
        assert whole["quantiles"] == [float(x) for x in np.quantile(values, np.linspace(0, 1, 11))]


def test_bracket_miss_falls_back(spark):
    from driftline.operators.ranking import bracket_order_statistics
    df = _frame(spark, [float(i) for i in range(100)])
    got = bracket_order_statistics(df, "column", "value", {"k": [(10.0, 20.0), (70.0, 71.0)]},
                                   {"k": [15, 50, 71]}, 2)
    assert got["k"] == {15: 15.0, 71: 71.0}      # rank 50 lies between the brackets: left out


def test_missed_ranks_are_ranked_whole(spark, monkeypatch):
    from driftline.operators import ranking as R
    monkeypatch.setattr(R, "disjoint", lambda found: [(1e9, 1e9)])  # a sketch that is wrong
    vals = [float(i) for i in range(50)]
    got = R.exact_quantiles(_frame(spark, vals), "column", "value", [0.0, 0.3, 1.0])["k"]
    assert got["quantiles"] == [float(x) for x in np.quantile(vals, [0, 0.3, 1])]


def test_small_and_large_inputs_share_one_plan(spark, monkeypatch):
    """The same operators run for 50 and for 50,000 values."""
    from driftline.operators import ranking as R
    seen = []
    real = R._values_at

    def watched(cum, *rest):
        seen.append([line.split("[")[0].strip(" +-:*()0123456789") for line in
                     cum._jdf.queryExecution().optimizedPlan().toString().splitlines()])
        return real(cum, *rest)

    monkeypatch.setattr(R, "_values_at", watched)
    for n in (50, 50_000):
        R.exact_quantiles(spark.range(n).selectExpr("'k' AS column", "double(id) AS value"),
                          "column", "value", [0.1, 0.5])
    assert len(seen) == 2 and [x.split()[0] for x in seen[0] if x] == [x.split()[0] for x in seen[1] if x]


def test_bracket_path_with_bounded_window(spark):
    vals = list(np.random.default_rng(12).normal(size=4000).round(2))
    probs = [i * 0.1 + 0.0 for i in range(10)] + [1.0]
    got = exact_quantiles(_frame(spark, vals), "column", "value", probs, "linear",
                          accuracy=100)["k"]
    assert got["quantiles"] == [float(x) for x in np.quantile(vals, np.linspace(0, 1, 11))]


def test_running_totals_keep_null_groups(spark):
    pdf = pd.DataFrame({"g": [None, None, "a", "a", None], "x": [1.0, 2.0, 1.0, 2.0, 3.0],
                        "w": [1, 1, 1, 1, 1]})
    df = spark.createDataFrame(pdf, "g string, x double, w long")
    got = {(r.g, r.x): r.w_cum for r in running_totals(df, "x", ["w"], by=["g"],
                                                        num_partitions=3).collect()}
    assert got == {(None, 1.0): 1, (None, 2.0): 2, (None, 3.0): 3, ("a", 1.0): 1, ("a", 2.0): 2}

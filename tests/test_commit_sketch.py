"""Commit log, committed retrain, sketches, grouped AUC, layout-free forests, hot categories,
mismatched windows, quarantine and checked CSV."""

import os
import sys
import threading
import time

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from conftest import ROOT, SF_SMALL
from driftline.operators import drift as D
from driftline.operators import evaluate as E
from driftline.operators import features as FE
from driftline.operators import forest as FO
from driftline.operators import sketches as SK
from driftline.operators import train as TR
from driftline.operators.runs import append_run, run_row
from driftline.plans import jobs
from driftline.plans import queries as Q
from driftline.session import scratch_path
from driftline.sources import io
from driftline.sources.commit_log import CommitLog
from driftline.streaming import drift as SD
from driftline.streaming import score as SC


def labelled(spark, n=300, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 2))
    y = (x[:, 0] + 0.5 * x[:, 1] + rng.normal(scale=0.7, size=n) > 0).astype(float)
    rows = [(i, float(a), float(b), "c" * (i % 3 + 1), float(t)) for i, ((a, b), t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "k long, x1 double, x2 double, c string, y double")


SPEC = FE.FeatureSpec(numeric=["x1", "x2"], categorical=["c"], label="y")


# --- commit log -------------------------------------------------------------------------

def test_readers_never_miss_a_version(spark):
    path, seen, failed, done = scratch_path(spark, "log"), [], [], threading.Event()
    SC.publish_pointer(spark, path, "model-0")

    def poll():
        while not done.is_set():
            try:
                seen.append(SC.current_model(spark, path))
            except Exception as exc:
                failed.append(exc)
            time.sleep(0.002)

    reader = threading.Thread(target=poll)
    reader.start()
    for i in range(1, 51):
        SC.publish_pointer(spark, path, f"model-{i}")
    done.set()
    reader.join()
    assert not failed and seen == sorted(seen) and len(set(seen)) > 5
    assert all(model == f"model-{version - 1}" for version, model in seen)
    assert SC.current_model(spark, path) == (51, "model-50")


def test_writers_take_different_versions(spark):
    log, got = CommitLog(spark, scratch_path(spark, "log")), []
    assert log.versions() == [] and log.latest() is None and log.frame("a int").count() == 0
    threads = [threading.Thread(target=lambda i=i: got.extend(log.append({"a": 10 * i + j}) for j in range(5))) for i in range(6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(got) == list(range(1, 31)) == log.versions()
    assert sorted(r.a for r in log.frame("a int").collect()) == sorted(10 * i + j for i in range(6) for j in range(5))
    log.append({"b": 1})
    assert log.latest()[0] == 31 and log.latest("a")[0] == 30


def test_pointer_without_model(spark):
    with pytest.raises(io.MissingInput):
        SC.read_pointer(spark, scratch_path(spark, "nothing"))


# --- committed retrain -----------------------------------------------------------------------

def test_run_row_is_replaced_under_its_id(spark):
    path = scratch_path(spark, "runs")
    for accuracy in (0.5, 0.75):
        append_run(run_row(spark, "e", "logreg", 1.0, accuracy, 10, 2), path, "run-a")
    append_run(run_row(spark, "e", "logreg", 1.0, 0.25, 10, 2), path, "run-b")
    append_run(run_row(spark, "e", "logreg", 1.0, 0.125, 10, 2), path)
    assert sorted(r.accuracy for r in spark.read.parquet(path).collect()) == [0.125, 0.25, 0.75]
    with pytest.raises(ValueError):
        append_run(run_row(spark, "e", "logreg", 1.0, 0.5, 10, 2), path, "2024-01-01")


@pytest.mark.parametrize("broken", ["write_json_report", "save_model", "append_run", "CommitLog.append"])
def test_killed_retrain_leaves_nothing_and_its_retry_one_run(spark, monkeypatch, broken):
    df = labelled(spark)
    base, root = df.select("x1", "x2"), scratch_path(spark, "retrain")
    args = dict(split_key="k", force=True, experiment="e")
    real = CommitLog.append if broken == "CommitLog.append" else getattr(jobs, broken)

    def killed(*a, **b):
        if broken != "CommitLog.append":
            real(*a, **b)   # the output is there, what comes after it is not
        raise RuntimeError("killed")

    target = (CommitLog, "append") if broken == "CommitLog.append" else (jobs, broken)
    monkeypatch.setattr(*target, killed)
    with pytest.raises(RuntimeError):
        jobs.retrain_committed(base, base, df, SPEC, root, **args)
    assert CommitLog(spark, f"{root}/commits").versions() == []
    with pytest.raises(io.MissingInput):
        SC.read_pointer(spark, f"{root}/commits")
    monkeypatch.setattr(*target, real)
    first = jobs.retrain_committed(base, base, df, SPEC, root, **args).first()
    assert jobs.retrain_committed(base.repartition(5), base, df, SPEC, root, **args).first() == first
    assert first.version == 1 and CommitLog(spark, f"{root}/commits").versions() == [1]
    assert [r.dataset_rows for r in jobs.committed_runs(spark, root).collect()] == [300]
    assert spark.read.parquet(f"{root}/runs").count() == 1
    assert SC.score_batch(io.load_model(SC.read_pointer(spark, f"{root}/commits")), df).where("prediction IS NOT NULL").count() == 300


def test_a_check_without_retrain_keeps_the_model(spark):
    df = labelled(spark)
    base, root = df.select("x1", "x2"), scratch_path(spark, "retrain")
    jobs.retrain_committed(base, base, df, SPEC, root, split_key="k", force=True)
    later = jobs.retrain_committed(base, base, df, SPEC, root, split_key="k").first()
    assert (later.version, later.retrained, later.model_path) == (2, False, None)
    assert SC.current_model(spark, f"{root}/commits")[0] == 1
    assert jobs.committed_runs(spark, root).count() == 1


@pytest.mark.parametrize("query", [Q.q_retrain_committed, Q.q_retrain_job])
def test_a_retrain_needs_no_import_while_it_runs(spark, monkeypatch, query):
    folder = scratch_path(spark, "tables")
    k = F.col("id")
    spark.range(600).select(
        k.alias("l_orderkey"), (k % 7).cast("int").alias("l_linenumber"), (k * 37 % 50 + 1.0).alias("l_quantity"),
        (k * 7 % 11 / 100.0).alias("l_discount"), (k * 5 % 9 / 100.0).alias("l_tax"), (k * 91 % 1009 + 1.0).alias("l_extendedprice"),
        F.element_at(F.array(*map(F.lit, "ANR")), (k % 3 + 1).cast("int")).alias("l_returnflag"),
        F.when(k % 2 == 0, "O").otherwise("F").alias("l_linestatus"),
        F.make_timestamp_ntz((1995 + k % 7).cast("int"), *map(F.lit, (1, 1, 0, 0, 0))).alias("l_shipdate"),
    ).write.parquet(f"{folder}/lineitem.parquet")
    # A caller may load several versions of the package and forget each after its import.
    for name in [m for m in sys.modules if m.split(".")[0] == "driftline"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setattr(sys, "path", [p for p in sys.path if os.path.abspath(p) != ROOT])
    row = query(spark, folder).first()
    assert (row.scored, row.runs, row.dataset_rows, row.retrained) == (600, 1, 600, True)


def test_run_key_follows_content(spark):
    df = labelled(spark)
    key = jobs.run_key([df], a=1)
    assert key == jobs.run_key([df.repartition(7).orderBy("x1")], a=1) and key.startswith("run-")
    assert key not in (jobs.run_key([df], a=2), jobs.run_key([df.where("k <> 3")], a=1), jobs.run_key([df.union(df.limit(1))], a=1))


# --- sketches ---------------------------------------------------------------------------------

def test_merged_sketches_within_their_bound(spark):
    rng = np.random.default_rng(2)
    values = rng.gamma(2.0, size=30_000)
    df = spark.createDataFrame([(f"d{i % 5}", float(v), 1.0 if i % 9 else None) for i, v in enumerate(values)],
                               "day string, x double, y double").repartition(4)
    path = scratch_path(spark, "sk")
    SK.write_sketches(SK.daily_sketches(df, F.col("day"), ["x", "y"], k=400), path)
    table = spark.read.parquet(path)
    probs = D.decile_probs()
    got = {r["column"]: r for r in SK.quantiles(table, probs).collect()}
    assert got["x"].n == 30_000 and got["y"].n == sum(1 for i in range(30_000) if i % 9)
    assert (got["x"].quantiles[0], got["x"].quantiles[-1]) == (values.min(), values.max())
    for p, q in zip(probs, got["x"].quantiles):
        assert abs((values <= q).mean() - p) <= 3 * SK.rank_error(400)
    edges = SK.sketch_edges(table, ["x", "y", "z"])
    assert len(edges.edges["x"]) == 11 and edges.edges["z"] is None
    assert edges.edges["y"] == D.even_edges(1.0, 1.0)
    assert abs((values <= SK.sketch_medians(table)["x"]).mean() - 0.5) <= 3 * SK.rank_error(400)


def test_a_corrected_day_replaces_its_sketch(spark):
    path = scratch_path(spark, "sk")
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 10.0)], "day string, x double")
    SK.write_sketches(SK.daily_sketches(df, F.col("day"), ["x"]), path)
    SK.write_sketches(SK.daily_sketches(spark.createDataFrame([("b", 7.0), ("b", float("nan"))], "day string, x double"), F.col("day"), ["x"]), path)
    got = SK.quantiles(spark.read.parquet(path), [0.0, 1.0]).first()
    assert (got.n, got.quantiles) == (3, [1.0, 7.0])
    assert SK.quantiles(spark.read.parquet(path).where("day = 'zz'"), [0.5]).count() == 0


# --- evaluation and training ---------------------------------------------------------------------

def test_auc_by_groups(spark):
    rng = np.random.default_rng(3)
    rows = [(int(g), float(rng.integers(0, 8)), float(rng.integers(0, 2))) for g in rng.integers(0, 4, 500)] + [(9, 1.0, 1.0), (8, None, 0.0)]
    df = spark.createDataFrame(rows, "g int, score double, label double")
    got = {r.g: r for r in E.auc_by(df, ["g"]).collect()}
    for g in range(4):
        pos = [s for h, s, y in rows if h == g and y == 1.0]
        neg = [s for h, s, y in rows if h == g and y == 0.0]
        u = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
        assert got[g].auc == pytest.approx(u / (len(pos) * len(neg)), abs=1e-12)
    assert got[9].auc is None and 8 not in got
    assert E.auc_exact(df.limit(0)).first().asDict() == {"auc": None, "positives": 0, "negatives": 0}


def test_cross_validation_gives_the_exact_auc_of_each_point(spark):
    df = SPEC.prepare(labelled(spark)).withColumn("_fold", (F.col("k") % 3).cast("int"))
    lr = TR.classifier("logreg")
    grid = [{lr.regParam: 0.0}, {lr.regParam: 1.0}]
    got = TR.cross_validate(df, SPEC.stages(), lr, grid, 3)
    evaluator = BinaryClassificationEvaluator(labelCol="label", numBins=0)
    from pyspark.ml import Pipeline
    for i, point in enumerate(grid):
        folds = []
        for k in range(3):
            feats = Pipeline(stages=SPEC.stages()).fit(df.where(F.col("_fold") != k)).transform(df)
            model = lr.fit(feats.where(F.col("_fold") != k), point)
            folds.append(evaluator.evaluate(model.transform(feats.where(F.col("_fold") == k))))
        assert got[i] == pytest.approx(sum(folds) / 3, abs=1e-9)


def test_forest_does_not_depend_on_the_layout(spark):
    df = labelled(spark, 400, 4)
    found = [TR.final_stage(TR.fit(d, SPEC, "random_forest", split_key="k", num_trees=8).model)
             for d in (df.coalesce(1).cache(), df.repartition(7).cache(), df.orderBy("x2"))]
    assert all((found[0].featureImportances.toArray() == m.featureImportances.toArray()).all() for m in found)
    assert len({m.toDebugString.split("\n", 1)[1] for m in found}) == 1


def test_confusion_counts_every_prediction(spark):
    df = spark.createDataFrame([(0.0, 2.0), (0.0, None), (0.0, 0.0), (1.0, 1.0), (None, 1.0)], "label double, prediction double")
    got = {r.label: tuple(r)[1:] for r in E.confusion(df).collect()}
    assert got == {0.0: (1, 0, 2), 1.0: (0, 1, 0), None: (0, 1, 0)}


# --- categories ---------------------------------------------------------------------------------

def test_hot_and_rare_categories(spark):
    rows = [(i, "hot" if i % 3 else f"r{i % 50}", "ab"[i % 2] if i % 10 else None, f"u{i}") for i in range(600)]
    df = spark.createDataFrame(rows, "k int, a string, b string, c string").withColumn("n", F.lit(None).cast("string"))
    got, sizes = FE.index_categories(df, ["a", "b", "c", "n"])
    assert got.columns == ["k", "a", "b", "c", "n", "a_idx", "b_idx", "c_idx", "n_idx"]
    out = {r.k: r for r in got.collect()}
    assert len(out) == 600 and sizes["n"] == 0
    for at, name in ((1, "a"), (2, "b"), (3, "c")):
        counts = {}
        for r in rows:
            if r[at] is not None:
                counts[r[at]] = counts.get(r[at], 0) + 1
        order = {v: float(i) for i, v in enumerate(sorted(counts, key=lambda v: (-counts[v], v)))}
        assert sizes[name] == len(order)
        assert all(out[r[0]][f"{name}_idx"] == (order[r[at]] if r[at] is not None else len(order)) for r in rows)
    assert {r.n_idx for r in out.values()} == {0.0}


def test_category_counts_scan_once(spark):
    od = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    plan = FE.category_counts(od, ["o_orderpriority", "o_orderstatus", "o_custkey"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1
    assert "o_totalprice" not in plan.split("ReadSchema")[1]


# --- windows with values that are no number -----------------------------------------------------

def _odd_events(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    day = F.dayofmonth("ts")
    bad = (day == 9) & (F.col("event_id") % 2 == 0) | (day == 11)
    return ev, ev.withColumn("value", F.when(bad, "n/a").when(day != 13, F.col("value").cast("string")))


def test_mismatched_windows(spark):
    ev, odd = _odd_events(spark)
    base = ev.where(F.col("ts") < F.lit("2024-01-08").cast("timestamp_ntz"))
    plain = {r.window_start.day: r for r in SD.drift_by_window_batch(ev, "ts", ["value"], base).collect()}
    got = {r.window_start.day: r for r in SD.drift_by_window_batch(odd, "ts", ["value"], base).collect()}
    assert set(got) == set(plain)
    for day, r in got.items():
        if day in (9, 11):
            assert r.status == "type_mismatch" and r.psi is None and r.n_new + r.n_misfit == plain[day].n_new and r.n_misfit
        elif day == 13:
            assert (r.status, r.n_new, r.n_misfit) == ("insufficient_data", 0, 0)
        else:
            assert (r.psi, r.status, r.n_misfit) == (plain[day].psi, plain[day].status, 0)
    dates = SD.drift_by_window_batch(ev.withColumn("value", F.col("ts").cast("date")), "ts", ["value"], base).collect()
    assert {r.status for r in dates} == {"type_mismatch"}


def test_mismatched_windows_in_the_report_stream(spark):
    ev, odd = _odd_events(spark)
    base = ev.where(F.col("ts") < F.lit("2024-01-08").cast("timestamp_ntz")).select("ts", "value", "event_type")
    src, sink = scratch_path(spark, "odd"), scratch_path(spark, "report")
    odd.select("ts", "value", "event_type").write.parquet(src)
    SD.report_by_window_stream(spark.readStream.schema("ts timestamp_ntz, value string, event_type string").parquet(src), "ts", base, sink,
                               scratch_path(spark, "ck")).awaitTermination()
    batch = {(r.window_start, r.column): (r.psi, r.status) for r in SD.report_by_window_batch(odd.select("ts", "value", "event_type"), "ts", base).collect()}
    got = {(r.window_start, r.column): (r.psi, r.status) for r in spark.read.parquet(sink).collect()}
    assert len(got) >= len(batch) - 2 and all(batch[k] == v for k, v in got.items())
    assert sum(s == "type_mismatch" for _, s in got.values()) == 2


# --- records that cannot be scored ------------------------------------------------------------

def test_quarantine_of_derived_features(spark):
    raw = spark.createDataFrame([(i, 20.0 + i, 1.0 * i, i % 3, 1, "m", "S", 1 + i % 3, float(i % 2)) for i in range(60)],
                                "id int, Age double, Fare double, SibSp int, Parch int, Sex string, Embarked string, Pclass int, Survived double")
    model = TR.fit(raw, FE.serving_spec(raw.columns), "logreg", split_key="id").model
    assert SC.needed_features(model) == ["Age", "Fare", "FamilySize", "IsAlone"]
    odd = raw.withColumns({"Age": F.when(F.col("id") == 1, F.lit(float("nan"))).otherwise(F.col("Age")),
                           "SibSp": F.when(F.col("id") != 2, F.col("SibSp")), "Sex": F.when(F.col("id") != 3, F.col("Sex"))})
    good, bad = SC.split_usable(model, odd)
    assert good.columns == raw.columns and good.count() == 58
    assert {r.id: r.bad_columns for r in bad.collect()} == {1: ["Age"], 2: ["FamilySize"]}
    scored = {r.id: r for r in SC.score_batch(model, odd, ["id"]).collect()}
    assert [scored[i].prediction for i in (1, 2)] == [None, None] and scored[1].probability is None
    assert all(scored[i].prediction in (0, 1) for i in range(60) if i not in (1, 2))


def test_quarantine_stream_is_idempotent(spark):
    df = labelled(spark, 90)
    path = scratch_path(spark, "m")
    io.save_model(TR.fit(df, SPEC, "logreg", split_key="k").model, path)
    src, sink, aside = (scratch_path(spark, n) for n in ("src", "sink", "aside"))
    df.withColumn("x1", F.when(F.col("k") % 9 != 0, F.col("x1"))).drop("y").write.parquet(src)
    for ckpt in ("c1", "c2"):   # a fresh checkpoint runs epoch 0 again
        stream = spark.readStream.schema("k long, x1 double, x2 double, c string").parquet(src)
        SC.score_stream_quarantine(spark, stream, path, sink, aside, scratch_path(spark, ckpt), ["k"]).awaitTermination()
    assert sorted(r.k for r in spark.read.parquet(aside).collect()) == [k for k in range(90) if k % 9 == 0]
    assert sorted(r.k for r in spark.read.parquet(sink).collect()) == [k for k in range(90) if k % 9]


# --- checked CSV ------------------------------------------------------------------------------

def test_csv_with_misfits(spark):
    path = scratch_path(spark, "csv")
    lines = ["id,x,flag", "1,2.5,true", "2,NA,false", "3,abc,true", "x4,1,maybe", "5,1", "6,1,true,extra", '7,"1,5",', "8,33D,false"]
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(path)
    good, misfits = io.read_csv_checked(spark, path, "id int, x double, flag boolean")
    assert sorted(tuple(r) for r in good.collect()) == [(1, 2.5, True), (2, None, False)]
    got = sorted(((r.column or "", r.text or "", r.record) for r in misfits.collect()))
    assert [g[:2] for g in got] == [("", ""), ("", ""), ("flag", "maybe"), ("id", "x4"), ("x", "1,5"), ("x", "33D"), ("x", "abc")]
    assert {g[2] for g in got[:2]} == {"5,1", "6,1,true,extra"} and got[3][2] == "x4,1,maybe"
    assert all(r.file.endswith(".txt") for r in misfits.collect())
    with pytest.raises(io.UnparsableValues):
        io.read_csv(spark, path, "id int, x double, flag boolean")
    with pytest.raises(io.MissingInput):
        io.read_csv_checked(spark, path + "-none", "id int")


def test_counted_forest_learns_like_a_rowwise_one(spark):
    df = labelled(spark, 1500, 6).withColumn("c", F.when(F.col("k") % 9 != 0, F.col("c"))).cache()
    rows = TR.fit(df, SPEC, "random_forest", split_key="k", num_trees=30)
    counted = [TR.fit(d, SPEC, "random_forest", split_key="k", num_trees=30, most_bag_bytes=0)
               for d in (df, df.coalesce(1), df.repartition(7).orderBy("x2"))]
    weights = [TR.final_stage(r.model).featureImportances.toArray() for r in (rows, *counted)]
    assert all((weights[1] == w).all() for w in weights[2:])           # whatever the layout
    assert len({TR.final_stage(r.model).toDebugString.split("\n", 1)[1] for r in counted}) == 1
    assert abs(weights[0] - weights[1]).max() < 0.08
    assert abs(rows.metrics["accuracy"] - counted[0].metrics["accuracy"]) < 0.05
    model = TR.final_stage(counted[0].model)
    assert model.getNumTrees == 30 and type(model) is type(TR.final_stage(rows.model)) and model.numClasses == 2
    assert counted[0].metrics["feature_count"] == rows.metrics["feature_count"]
    assert TR.feature_names(counted[0].model, SPEC) == TR.feature_names(rows.model, SPEC)
    # Saved and loaded it scores alike; a row without a needed feature has no score.
    path = scratch_path(spark, "counted-forest")
    io.save_model(counted[0].model, path)
    odd = df.select("k", "c", F.when(F.col("k") != 3, F.col("x1")).alias("x1"),
                    F.when(F.col("k") == 4, float("nan")).otherwise(F.col("x2")).alias("x2"))
    before, after = ({r.k: (r.prediction, r.probability) for r in SC.score_batch(m, odd, ["k"]).collect()}
                     for m in (counted[0].model, io.load_model(path)))
    assert before == after and len(before) == 1500
    assert {k for k, v in before.items() if v == (None, None)} == {3, 4}


def test_counted_forest_draws_every_row_about_once(spark):
    df = labelled(spark, 600, 8).withColumn("label", F.col("y")).drop("y")
    features = FO.Pipeline(stages=FO.binned_stages(SPEC, df, 600, 1)).fit(df)
    got = FO.counted_rows(df, features, SPEC, 50, 1, 3)
    total = np.array([r.draws for r in got.collect()]).sum(axis=0)
    assert total.shape == (50,) and abs(total.mean() - 600) < 20 and 8 < total.std() < 45


def test_split_values_of_few_and_of_many_values():
    assert FO.split_values(np.array([3.0, 1.0, 2.0, 1.0])) == [1.5, 2.5]
    assert FO.split_values(np.array([5.0, 5.0])) == [5.0] and FO.split_values(np.array([])) == [0.0]
    found = FO.split_values(np.arange(1000.0))
    assert len(found) == 31 and np.allclose(np.diff(found), 31.25, atol=1)


def test_counted_forest_of_sampled_thresholds_does_not_depend_on_the_layout(spark, monkeypatch):
    monkeypatch.setattr(FO, "SPLIT_ROWS", 200)      # thresholds from a part of the rows
    df = labelled(spark, 800, 9)
    models = [TR.final_stage(TR.fit(d, SPEC, "random_forest", split_key="k", num_trees=4, most_bag_bytes=0).model)
              for d in (df.repartition(1), df.repartition(7), df.orderBy("x2"))]
    assert len({m.toDebugString.split("\n", 1)[1] for m in models}) == 1

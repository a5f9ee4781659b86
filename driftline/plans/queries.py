"""Registered queries: each reads the driver's tables under ``sf_dir`` and
runs one operator or job of the library over the whole tables.

Fixtures derived from the TPC-H-like tables (the passenger table of the
reference is not available):
- lineitem split by ship year (<= 1998 is the baseline) for PSI;
- orders split by order date (before 1998 is the baseline) for the report;
- events split by day for chi-square and windowed drift;
- a deterministic noisy label on lineitem for the classifiers:
  label = l_quantity + (l_orderkey * 7 + l_linenumber * 13) % 41 - 20 > 25.
Nulls are injected as ``case when key % k = 0 then null`` (the tables have
none), written the same way in the oracle SQL.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import hash_bucket, tolerant_double
from ..operators import drift as D
from ..operators import evaluate as E
from ..operators import features as FE
from ..operators import sketches as SK
from ..operators import train as TR
from ..operators.ranking import running_totals
from ..operators.runs import read_runs, run_series
from ..session import scratch_path
from ..sources import io
from ..streaming import drift as SD
from ..streaming import open_windows as OW
from ..streaming import score as SC
from . import jobs

def inject_nulls(df: DataFrame, key: str, every: Mapping[str, int]) -> DataFrame:
    """Null out ``col`` on rows whose ``key % k == 0``."""
    out = df
    for c, k in every.items():
        out = out.withColumn(c, F.when(F.col(key) % k == 0, F.lit(None)).otherwise(F.col(c)))
    return out


LINEITEM_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return io.read_table(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------------------
# Fixtures derived from the tables
# ---------------------------------------------------------------------------

def lineitem_numbers(spark, sf_dir) -> tuple[DataFrame, list]:
    """Lineitem numerics with the ship date, a constant and a two-valued column."""
    li = table(spark, sf_dir, "lineitem")
    extra = {
        "const_one": F.col("l_quantity") * F.lit(0.0) + F.lit(1.0),
        "flag_r": F.when(F.col("l_returnflag") == "R", F.lit(1.0)).otherwise(F.lit(0.0)),
    }
    cols = LINEITEM_NUMERIC + list(extra)
    return li.select("l_shipdate", *LINEITEM_NUMERIC, *[e.alias(n) for n, e in extra.items()]), cols


def lineitem_psi_frame(spark, sf_dir) -> tuple[DataFrame, list]:
    """The same, sided."""
    li, cols = lineitem_numbers(spark, sf_dir)
    return D.split_sides(li, lineitem_base(), cols), cols


def lineitem_edges(spark, sf_dir, method: str = "exact") -> D.BinEdges:
    """Edges of the baseline; its date filter reaches the scan."""
    li, cols = lineitem_numbers(spark, sf_dir)
    return D.BinEdges.fit(D.to_long(li.where(lineitem_base()), cols), cols, method=method)


def lineitem_with_nulls(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return inject_nulls(li, "l_orderkey", {"l_quantity": 7, "l_discount": 5,
                                           "l_returnflag": 3, "l_linenumber": 11})


def noisy_label() -> Column:
    noise = (F.col("l_orderkey") * 7 + F.col("l_linenumber") * 13) % 41 - 20
    return ((F.col("l_quantity") + noise) > 25).cast("double")


def lineitem_labeled(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax",
                     "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate",
                     noisy_label().alias("label"),
                     (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("row_key"))


def lineitem_spec() -> FE.FeatureSpec:
    return FE.FeatureSpec(numeric=["l_quantity", "l_discount", "l_tax"],
                          categorical=["l_returnflag", "l_linestatus"], label="label")


def ntz(text: str) -> Column:
    """A TIMESTAMP_NTZ literal (the tables' time columns are NTZ)."""
    return F.lit(text).cast("timestamp_ntz")


def lineitem_base() -> Column:
    """Ship year <= 1998, as a comparison that reaches the scan."""
    return F.col("l_shipdate") < ntz("1999-01-01 00:00:00")


def orders_base() -> Column:
    return F.col("o_orderdate") < ntz("1998-01-01 00:00:00")


EVENTS_SPLIT = "2024-01-16 00:00:00"
EVENTS_BASE_END = "2024-01-08 00:00:00"


# ---------------------------------------------------------------------------
# Drift
# ---------------------------------------------------------------------------

def q_psi_numeric(spark, sf_dir):
    """PSI of lineitem numerics (baseline: ship year <= 1998), with a constant and a
    two-valued column."""
    sides, cols = lineitem_psi_frame(spark, sf_dir)
    out = D.psi(sides, cols, edges=lineitem_edges(spark, sf_dir))
    return out.select("column", "n_base", "n_new", F.round("psi", 6).alias("psi"), "status")


def q_psi_numeric_approx(spark, sf_dir):
    """The same PSI with one-pass sketch edges (percentile_approx, rank error
    at most n / 10000): the mode for very wide continuous columns. Edges are
    data values, so no SQL oracle reproduces them."""
    sides, cols = lineitem_psi_frame(spark, sf_dir)
    out = D.psi(sides, cols, edges=lineitem_edges(spark, sf_dir, "approx"))
    return out.select("column", "n_base", "n_new", F.round("psi", 6).alias("psi"), "status")


def q_bin_edges(spark, sf_dir):
    """The fitted decile edges of the lineitem baseline, one row per edge."""
    edges = lineitem_edges(spark, sf_dir)
    return edges.to_df(spark).select("column", "edge_index", F.round("edge", 6).alias("edge"))


def q_histogram(spark, sf_dir):
    """Bin counts per side, plus out-of-range counts (bin -1)."""
    sides, cols = lineitem_psi_frame(spark, sf_dir)
    edges = lineitem_edges(spark, sf_dir)
    h = D.histogram(sides, cols, edges)
    return h.where(F.col("code") >= -1).select(
        "column", "side", F.col("code").alias("bin"), F.col("cnt").cast("long").alias("cnt"))


def _chi(sides, cols, source):
    out = D.chi_square(sides, cols)
    return out.select(F.lit(source).alias("source"), "column", "k", "dof",
                      F.round("statistic", 6).alias("statistic"),
                      F.round("p_value", 6).alias("p_value"), "status")


def q_chi_square_categorical(spark, sf_dir):
    """Chi-square for events.event_type (K=5), orders status/priority (K=3, 5) and
    lineitem flags (K=2 with Yates, K=3)."""
    ev = table(spark, sf_dir, "events")
    ev_sides = D.split_sides(ev, F.col("ts") < ntz(EVENTS_SPLIT), ["event_type"])
    od = table(spark, sf_dir, "orders")
    od_sides = D.split_sides(od, orders_base(), ["o_orderstatus", "o_orderpriority"])
    li = table(spark, sf_dir, "lineitem")
    li_sides = D.split_sides(li, lineitem_base(), ["l_linestatus", "l_returnflag"])
    return (_chi(ev_sides, ["event_type"], "events")
            .unionByName(_chi(od_sides, ["o_orderstatus", "o_orderpriority"], "orders"))
            .unionByName(_chi(li_sides, ["l_linestatus", "l_returnflag"], "lineitem")))


ORDERS_IDS = ["o_orderkey", "o_custkey", "o_orderdate"]


def orders_report(spark, sf_dir):
    od = table(spark, sf_dir, "orders")
    return jobs.drift_report(od.where(orders_base()), od.where(~orders_base()), ORDERS_IDS)


def q_drift_report(spark, sf_dir):
    """The report over orders: baseline before 1998, ids and the date left out."""
    return orders_report(spark, sf_dir)


def q_drift_any(spark, sf_dir):
    """Whether any column of the orders report drifted."""
    return jobs.any_drift(orders_report(spark, sf_dir))


def q_drift_report_json(spark, sf_dir):
    """The orders report as one nested JSON text."""
    return jobs.report_json(orders_report(spark, sf_dir))


def q_drift_report_file(spark, sf_dir):
    """The orders report written as a JSON file and read back as rows."""
    path = scratch_path(spark, "report-json")
    io.write_json_report(jobs.report_json(orders_report(spark, sf_dir)), path)
    back = spark.read.schema("numeric map<string,struct<psi:double,status:string>>, "
                             "categorical map<string,struct<p_value:double,status:string>>").json(path)
    parts = [back.select(F.lit(s).alias("section"), F.explode(s).alias("column", "v"))
             .select("section", "column", F.col(f"v.{f}").alias("value"), "v.status")
             for s, f in (("numeric", "psi"), ("categorical", "p_value"))]
    return parts[0].unionByName(parts[1])


def q_drift_report_mismatch(spark, sf_dir):
    """The orders report when the new batch carries o_totalprice as text:
    that column is reported as type_mismatch, the others are tested."""
    od = table(spark, sf_dir, "orders")
    new = od.where(~orders_base()).withColumn("o_totalprice", F.col("o_totalprice").cast("string"))
    return jobs.drift_report(od.where(orders_base()), new, ORDERS_IDS)


def q_drift_by_window(spark, sf_dir):
    """PSI of events.value per day window against the first seven days."""
    ev = table(spark, sf_dir, "events")
    base = ev.where(F.col("ts") < ntz(EVENTS_BASE_END))
    out = SD.drift_by_window_batch(ev, "ts", ["value"], base, "1 day")
    return out.select(F.date_format("window_start", "yyyy-MM-dd").alias("window_day"),
                      "column", "n_new", F.round("psi", 6).alias("psi"), "status")


NULL_DAYS = ("2024-01-10", "2024-01-20")


def q_drift_by_window_nulls(spark, sf_dir):
    """The same when two days have no value at all: their rows say insufficient_data."""
    ev = table(spark, sf_dir, "events")
    ev = ev.withColumn("value", F.when(~F.date_format("ts", "yyyy-MM-dd").isin(*NULL_DAYS), F.col("value")))
    base = ev.where(F.col("ts") < ntz(EVENTS_BASE_END))
    out = SD.drift_by_window_batch(ev, "ts", ["value"], base, "1 day")
    return out.select(F.date_format("window_start", "yyyy-MM-dd").alias("window_day"),
                      "column", "n_new", F.round("psi", 6).alias("psi"), "status")


MISFIT_DAYS = ("2024-01-12", "2024-01-22")


def events_with_misfits(spark, sf_dir) -> DataFrame:
    """Events whose value is text: on one day every tenth is no number, on another all."""
    ev = table(spark, sf_dir, "events")
    day = F.date_format("ts", "yyyy-MM-dd")
    bad = ((day == MISFIT_DAYS[0]) & (F.col("event_id") % 10 == 0)) | (day == MISFIT_DAYS[1])
    return ev.withColumn("value", F.when(bad, F.lit("33D")).otherwise(F.col("value").cast("string")))


def q_drift_by_window_mismatch(spark, sf_dir):
    """PSI per day window when value arrives as text, some of it no number: those
    windows say type_mismatch and how many values do not fit, the others are tested."""
    base = table(spark, sf_dir, "events").where(F.col("ts") < ntz(EVENTS_BASE_END))
    out = SD.drift_by_window_batch(events_with_misfits(spark, sf_dir), "ts", ["value"], base, "1 day")
    return out.select(F.date_format("window_start", "yyyy-MM-dd").alias("window_day"),
                      "column", "n_new", "n_misfit", F.round("psi", 6).alias("psi"), "status")


def q_open_windows(spark, sf_dir):
    """Events as a stream of three arrivals, some rows days late: each day window as it
    stands after the last one, open or closed, and the rows that came too late for it."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "value")
    base = ev.where(F.col("ts") < ntz(EVENTS_BASE_END)).select("ts", "value")
    day, k = F.dayofmonth("ts"), F.col("event_id")
    arrival = F.when((day <= 9) & (k % 25 == 0), 1).when((day <= 15) & (k % 25 == 1), 2) \
        .when(day <= 10, 0).when(day <= 20, 1).otherwise(2)
    src, sink, ckpt = (scratch_path(spark, n) for n in ("arrivals", "open-windows", "ckpt"))
    for n in range(3):
        ev.where(arrival == n).write.mode("append").parquet(src)
        stream = spark.readStream.schema(ev.schema).parquet(src).select("ts", "value")
        OW.open_windows_stream(stream, "ts", base, sink, ckpt).awaitTermination()
    return OW.current_windows(spark, sink).select(
        F.date_format("window_start", "yyyy-MM-dd").alias("window_day"), "column", "phase", "rows", "psi", "status", "late_rows")


def q_chi_square_by_window(spark, sf_dir):
    """event_type per day window against the first seven days."""
    ev = table(spark, sf_dir, "events")
    base = ev.where(F.col("ts") < ntz(EVENTS_BASE_END))
    out = SD.chi_square_by_window_batch(ev, "ts", ["event_type"], base, "1 day")
    return out.select(F.date_format("window_start", "yyyy-MM-dd").alias("window_day"),
                      "column", "k", "dof", F.round("statistic", 6).alias("statistic"),
                      F.round("p_value", 6).alias("p_value"), "status")


def q_report_by_window(spark, sf_dir):
    """The events report per day window against the first seven days:
    value by PSI, event_type by chi-square (ids left out)."""
    ev = table(spark, sf_dir, "events")
    base = ev.where(F.col("ts") < ntz(EVENTS_BASE_END))
    out = SD.report_by_window_batch(ev, "ts", base, id_cols=["event_id", "user_id", "props"])
    return out.select(F.date_format("window_start", "yyyy-MM-dd").alias("window_day"),
                      "column", "kind", "psi", "statistic", "dof", "p_value", "status")


# ---------------------------------------------------------------------------
# Preparation, baseline, IO
# ---------------------------------------------------------------------------

PREP_KEEP = ["l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_returnflag",
             "l_comment"]
PREP_FILLS = {"l_quantity": 0.0, "l_discount": 0.0, "l_returnflag": "S"}
BASE_COLS = ["l_orderkey", "l_quantity", "l_discount", "l_tax", "l_linenumber",
             "l_returnflag", "l_linestatus", "l_comment"]
BASE_NUMERIC = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]
BASE_CATEGORICAL = ["l_returnflag", "l_linestatus"]


def q_prep_fill_constant(spark, sf_dir):
    """Allow-list projection and constant fills on lineitem with injected nulls."""
    return jobs.prepare(lineitem_with_nulls(spark, sf_dir), PREP_KEEP, PREP_FILLS)


def _baseline(spark, sf_dir):
    return jobs.baseline(lineitem_with_nulls(spark, sf_dir), BASE_COLS, BASE_NUMERIC,
                         BASE_CATEGORICAL, exact=True)


def q_baseline_median_unknown(spark, sf_dir):
    """Baseline export: list-order projection, exact median and 'Unknown' fills."""
    return _baseline(spark, sf_dir)


def q_baseline_median_approx(spark, sf_dir):
    """The same with approxQuantile medians (relative error 0.01)."""
    return jobs.baseline(lineitem_with_nulls(spark, sf_dir), BASE_COLS, BASE_NUMERIC,
                         BASE_CATEGORICAL, relative_error=0.01, exact=False)


def q_baseline_csv(spark, sf_dir):
    """Baseline export as a CSV folder (parallel parts), read back."""
    out = _baseline(spark, sf_dir)
    path = scratch_path(spark, "baseline-csv")
    io.write_csv(out, path)
    return io.read_csv(spark, path, schema=out.schema, na_tokens=None)


def q_parquet_roundtrip(spark, sf_dir):
    """customer written as Parquet and read back."""
    cust = table(spark, sf_dir, "customer")
    path = scratch_path(spark, "customer-parquet")
    io.write_parquet(cust, path)
    return io.read_table(spark, path)


def q_csv_roundtrip(spark, sf_dir):
    """customer written as a CSV folder and read back with its schema."""
    cust = table(spark, sf_dir, "customer")
    path = scratch_path(spark, "customer-csv")
    io.write_csv(cust, path)
    return io.read_csv(spark, path, schema=cust.schema)


def q_na_tokens_cast(spark, sf_dir):
    """Text with NA tokens through a CSV round trip, types inferred like
    pandas, then a tolerant parse (unparsable → 0.0)."""
    ev = table(spark, sf_dir, "events")
    k = F.col("event_id")
    txt = (F.when(k % 11 == 0, F.lit("NA")).when(k % 13 == 0, F.lit("n/a"))
            .when(k % 17 == 0, F.lit("oops"))
            .otherwise(F.regexp_extract("props", r"([0-9]+)", 1)))
    path = scratch_path(spark, "events-csv")
    io.write_csv(ev.select("event_id", txt.alias("txt")), path)
    back = io.read_csv(spark, path)  # pandas NA tokens, inferred types
    return back.select(F.col("event_id").cast("long").alias("event_id"),
                       F.col("txt").isNull().alias("txt_is_null"),
                       tolerant_double("txt", 0.0).alias("parsed"))


def q_csv_misfits(spark, sf_dir):
    """Events through a CSV with planted misfits: the rows that fit the schema (null
    column), and one row per value that does not, both by event."""
    ev = table(spark, sf_dir, "events")
    k = F.col("event_id")
    amount = F.when(k % 11 == 0, "NA").when(k % 13 == 0, "oops").otherwise((k / 4).cast("string"))
    qty = F.when(k % 7 == 0, "3.5").when(k % 17 == 0, "").otherwise((k % 5).cast("string"))
    path = scratch_path(spark, "misfits-csv")
    io.write_csv(ev.select("event_id", amount.alias("amount"), qty.alias("qty")), path)
    good, misfits = io.read_csv_checked(spark, path, "event_id bigint, amount double, qty int")
    bad = misfits.select(F.split("record", ",")[0].cast("bigint").alias("event_id"), "column", "text",
                         F.lit(None).cast("double").alias("amount"), F.lit(None).cast("int").alias("qty"))
    none = F.lit(None).cast("string")
    return good.select("event_id", none.alias("column"), none.alias("text"), "amount", "qty").unionByName(bad)


SKETCH_PROBS = D.decile_probs()


def lineitem_sketches(spark, sf_dir) -> tuple[DataFrame, list]:
    """Daily sketches of the lineitem numerics, kept in a table by ship month; the
    first half of the months is written again, as a corrected month would be."""
    li, cols = lineitem_numbers(spark, sf_dir)
    path = scratch_path(spark, "sketches")
    month = F.date_format("l_shipdate", "yyyy-MM")
    SK.write_sketches(SK.daily_sketches(li, month, cols), path)
    SK.write_sketches(SK.daily_sketches(li.where(F.col("l_shipdate") < ntz("1998-01-01 00:00:00")), month, cols), path)
    return spark.read.schema("column string, n bigint, min double, max double, sketch binary, day string").parquet(path), cols


def q_sketch_edge_ranks(spark, sf_dir):
    """Decile edges of the baseline (ship year <= 1998) from the merged daily sketches:
    is the true rank of each within three times the sketch's error of its decile?"""
    sketches, cols = lineitem_sketches(spark, sf_dir)
    found = {r["column"]: r for r in SK.quantiles(sketches.where("day < '1999-01'"), SKETCH_PROBS).collect()}
    li, _ = lineitem_numbers(spark, sf_dir)
    # Two counts per column and edge in one aggregation: bounded by the schema.
    counts = [F.count_if(F.col(c) < e).alias(f"{c}:{i}:l") for c in cols for i, e in enumerate(found[c]["quantiles"])] \
        + [F.count_if(F.col(c) <= e).alias(f"{c}:{i}:u") for c in cols for i, e in enumerate(found[c]["quantiles"])]
    row = li.where(lineitem_base()).agg(F.count("*").alias("n"), *counts).first()
    slack = 3 * SK.rank_error()
    rows = [(c, i, int(found[c]["n"]), row[f"{c}:{i}:l"] / row["n"] - slack <= p <= row[f"{c}:{i}:u"] / row["n"] + slack)
            for c in cols for i, p in enumerate(SKETCH_PROBS)]
    return spark.createDataFrame(rows, "column string, edge_index int, n bigint, within boolean")


def q_sketch_psi(spark, sf_dir):
    """PSI of lineitem with edges from the merged daily sketches: row counts, status,
    and whether it is within 0.01 of the PSI with exact edges."""
    sketches, cols = lineitem_sketches(spark, sf_dir)
    sides, _ = lineitem_psi_frame(spark, sf_dir)
    edges = SK.sketch_edges(sketches.where("day < '1999-01'"), cols)
    exact = D.psi(sides, cols, edges=lineitem_edges(spark, sf_dir)).select("column", F.col("psi").alias("exact"))
    out = D.psi(sides, cols, edges=edges).join(exact, "column")
    return out.select("column", "n_base", "n_new", "status", (F.abs(F.col("psi") - F.col("exact")) <= 0.01).alias("near"))


# ---------------------------------------------------------------------------
# Features
# ---------------------------------------------------------------------------

def _orders_indexed(spark, sf_dir):
    return FE.index_categories(table(spark, sf_dir, "orders"), ["o_orderpriority", "o_orderstatus"])


def q_category_index(spark, sf_dir):
    """Category indexes of orders priority and status."""
    enc, _ = _orders_indexed(spark, sf_dir)
    return enc.select("o_orderkey", "o_orderpriority_idx", "o_orderstatus_idx")


def q_one_hot(spark, sf_dir):
    """One-hot slot and size of orders priority and status."""
    enc, k = _orders_indexed(spark, sf_dir)
    return enc.select("o_orderkey",
                      FE.hot_slot("o_orderpriority_idx", k["o_orderpriority"]).alias("priority_slot"),
                      F.lit(k["o_orderpriority"]).alias("priority_size"),
                      FE.hot_slot("o_orderstatus_idx", k["o_orderstatus"]).alias("status_slot"),
                      F.lit(k["o_orderstatus"]).alias("status_size"))


def q_assembled(spark, sf_dir):
    """Non-zero slots of the assembled lineitem feature vector."""
    li = lineitem_labeled(spark, sf_dir)
    spec = lineitem_spec()
    model = spec.fit(li)
    return FE.feature_slots(FE.encode(li, spec, model), spec, model, ["l_orderkey", "l_linenumber"])


def q_training_layout(spark, sf_dir):
    """The training layout over a passenger-like frame made of lineitem: the renamed
    target and the non-zero slots of every row."""
    li = table(spark, sf_dir, "lineitem")
    frame = li.select("l_orderkey", "l_linenumber", noisy_label().alias("Survived"), (F.col("l_linenumber") % 3 + 1).alias("Pclass"),
                      F.col("l_returnflag").alias("Sex"), F.col("l_quantity").alias("Age"), (F.col("l_linenumber") - 1).alias("SibSp"),
                      (F.col("l_orderkey") % 2).alias("Parch"), F.col("l_extendedprice").alias("Fare"),
                      F.col("l_linestatus").alias("Embarked"))
    spec = FE.training_spec(frame.columns)
    model = spec.fit(frame)
    return FE.feature_slots(FE.encode(frame, spec, model), spec, model, ["l_orderkey", "l_linenumber", "label"])


def q_contingency_sorted(spark, sf_dir):
    """The contingency table of the orders' categories in display order, with the place
    of each row."""
    od = table(spark, sf_dir, "orders")
    sides = D.split_sides(od, orders_base(), ["o_orderstatus", "o_orderpriority"])
    rows = D.contingency(sides, ["o_orderstatus", "o_orderpriority"], ordered=True)
    placed = running_totals(rows.withColumns({"at": F.monotonically_increasing_id(), "place": F.lit(1).cast("long")}), "at", ["place"])
    return placed.select("column", "category", "n_base", "n_new", F.col("place_cum").alias("place"))


def q_family_features(spark, sf_dir):
    """Family size and alone flag over counts derived from lineitem
    (siblings = line number - 1, parents = tax in cents mod 3)."""
    li = table(spark, sf_dir, "lineitem")
    counts = li.select("l_orderkey", "l_linenumber",
                       (F.col("l_linenumber") - 1).alias("SibSp"),
                       (F.round(F.col("l_tax") * 100).cast("int") % 3).alias("Parch"))
    spec = FE.serving_spec(counts.columns)
    return spec.derive(counts).select("l_orderkey", "l_linenumber", "FamilySize", "IsAlone")


def q_hash_split(spark, sf_dir):
    """md5 hash buckets and train flags of orders keys."""
    od = table(spark, sf_dir, "orders")
    bucket = hash_bucket("o_orderkey", 42).alias("bucket")
    train, test = FE.split_by_hash(od, "o_orderkey", 42, 0.2)  # the jobs' own split
    return train.select("o_orderkey", bucket, F.lit(True).alias("is_train")) \
        .unionByName(test.select("o_orderkey", bucket, F.lit(False).alias("is_train")))


# ---------------------------------------------------------------------------
# Evaluation and training
# ---------------------------------------------------------------------------

def _scored_rule(spark, sf_dir):
    li = lineitem_labeled(spark, sf_dir)
    return li.select("label", F.col("l_quantity").alias("score"),
                     (F.col("l_quantity") > 25).cast("double").alias("prediction"))


def q_accuracy(spark, sf_dir):
    """Accuracy of the rule l_quantity > 25 against the noisy label."""
    acc = E.accuracy(_scored_rule(spark, sf_dir))
    return acc.select(F.round("accuracy", 6).alias("accuracy"), F.col("n").cast("long"))


def q_auc_exact(spark, sf_dir):
    """Exact ROC AUC of l_quantity as a score for the noisy label."""
    auc = E.auc_exact(_scored_rule(spark, sf_dir), "label", "score")
    return auc.select(F.round("auc", 6).alias("auc"), "positives", "negatives")


def q_auc_by(spark, sf_dir):
    """Exact ROC AUC of two scores (quantity, discount) by return flag, all in one job."""
    li = lineitem_labeled(spark, sf_dir)
    scores = F.inline(F.array(*[F.struct(F.lit(n).alias("score_name"), F.col(n).alias("score"))
                                for n in ("l_quantity", "l_discount")]))
    found = E.auc_by(li.select("l_returnflag", "label", scores), ["l_returnflag", "score_name"], bounded_groups=True)
    return found.select("l_returnflag", "score_name", F.round("auc", 6).alias("auc"), "positives", "negatives")


def q_confusion_other(spark, sf_dir):
    """Confusion matrix of a rule with a third class and missing predictions."""
    q = F.col("l_quantity")
    li = lineitem_labeled(spark, sf_dir)
    rule = F.when(q > 40, 2.0).when(q > 25, 1.0).when(q > 5, 0.0)
    return E.confusion(li.select("label", rule.alias("prediction")))


def q_confusion(spark, sf_dir):
    """Confusion matrix of the same rule."""
    return E.confusion(_scored_rule(spark, sf_dir)).drop("pred_other")


def _train(spark, sf_dir, model_type, cv=False):
    li = lineitem_labeled(spark, sf_dir)
    return TR.fit(li, lineitem_spec(), model_type, split_key="row_key", cv=cv)


def q_train_logreg(spark, sf_dir):
    """Logistic regression on lineitem features; coefficients and intercept."""
    res = _train(spark, sf_dir, "logreg")
    return TR.coefficients(spark, res.model, lineitem_spec())


def q_train_logreg_moments(spark, sf_dir):
    """Mean of feature x label over the training rows, and whether the mean of feature x
    fitted probability equals it to 0.1 % (the condition of an unpenalised fit)."""
    res = _train(spark, sf_dir, "logreg")
    train, _ = FE.split_by_hash(lineitem_labeled(spark, sf_dir), "row_key", TR.SEED, TR.TEST_FRACTION)
    p = SC.score_batch(res.model, train, ["l_quantity", "l_discount", "l_tax", "l_returnflag", "label"])
    p = p.select("*", F.get("probability", F.lit(1)).alias("p"))
    parts = {"(intercept)": F.lit(1.0), **{c: F.col(c) for c in ("l_quantity", "l_discount", "l_tax")},
             **{f"l_returnflag={v}": (F.col("l_returnflag") == v).cast("double") for v in "ANR"}}
    row = p.agg(*[F.struct(F.avg(x * F.col("p")).alias("fit"), F.avg(x * F.col("label")).alias("true"))
                  .alias(n) for n, x in parts.items()])
    long = row.select(F.inline(F.array(*[F.struct(F.lit(n).alias("feature"), F.col(f"`{n}`.fit"),
                                                  F.col(f"`{n}`.true")) for n in parts])))
    near = F.abs(F.col("fit") - F.col("true")) <= 1e-3 * F.abs("true")
    return long.select("feature", F.round("true", 6).alias("moment"), near.alias("fit_within_0_1_percent"))


def q_train_forest(spark, sf_dir):
    """Random forest (100 trees, seeded) on lineitem features; importances."""
    res = _train(spark, sf_dir, "random_forest")
    return TR.coefficients(spark, res.model, lineitem_spec())


def q_model_choice(spark, sf_dir):
    """The final stage of each kind of model and the width of its features."""
    li = lineitem_labeled(spark, sf_dir)
    rows = []
    for kind in ("logreg", "random_forest"):
        result = TR.fit(li, lineitem_spec(), kind, split_key="row_key", max_iter=2, num_trees=2)
        rows.append((kind, type(TR.final_stage(result.model)).__name__, int(result.metrics["feature_count"])))
    return spark.createDataFrame(rows, "model_type string, stage string, features int")


def q_score_separable(spark, sf_dir):
    """A model of a label that one feature separates scores every row as the label says."""
    li = table(spark, sf_dir, "lineitem").withColumn("label", (F.col("l_quantity") > 25).cast("double")) \
        .withColumn("row_key", F.col("l_orderkey") * 8 + F.col("l_linenumber"))
    spec = FE.FeatureSpec(numeric=["l_quantity"], label="label")
    model = TR.fit(li, spec, "logreg", split_key="row_key").model
    scored = SC.score_batch(model, li, ["label"], with_probability=False)
    return scored.groupBy("prediction").agg(F.count("*").alias("rows"), F.count_if(F.col("prediction") == F.col("label")).alias("right"))


def q_forest_layouts(spark, sf_dir):
    """The same forest fitted on the same rows in three layouts: the greatest difference
    between importances."""
    li = lineitem_labeled(spark, sf_dir)
    found = []
    for n in (1, 7, 4):
        model = TR.fit(li.repartition(n), lineitem_spec(), "random_forest", split_key="row_key", num_trees=10).model
        found.append(TR.final_stage(model).featureImportances.toArray())
    most = max(float(abs(a - b).max()) for a in found for b in found)
    return spark.createDataFrame([(len(found), most)], "layouts int, max_difference double")


def documents_labeled(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels")
    # labels has one row per labelled document: a key-to-key join.
    return docs.select("doc_id", "lang", "source", F.col("n_chars").cast("double")
                       .alias("n_chars")).join(labels.select("doc_id", "quality"), "doc_id") \
        .select("doc_id", "lang", "source", "n_chars",
                F.col("quality").cast("double").alias("label"))


def q_cross_validate(spark, sf_dir):
    """3-fold CV over the 6-point grid on documents joined with labels;
    returns the mean AUC per grid point."""
    data = documents_labeled(spark, sf_dir)
    spec = FE.FeatureSpec(numeric=["n_chars"], categorical=["lang", "source"], label="label")
    res = TR.fit(data, spec, "logreg", split_key="doc_id", cv=True)
    rows = [(i, float(m)) for i, m in enumerate(res.metrics["cv_avg_auc"])]
    return spark.createDataFrame(rows, "grid_point int, avg_auc double")


def _fitted_model_path(spark, sf_dir):
    res = _train(spark, sf_dir, "logreg")
    path = scratch_path(spark, "model")
    io.save_model(res.model, path)
    return path


def q_score_batch(spark, sf_dir):
    """Fit, save, load, and score every lineitem row."""
    path = _fitted_model_path(spark, sf_dir)
    model = io.load_model(path)
    li = lineitem_labeled(spark, sf_dir)
    return SC.score_batch(model, li, ["l_orderkey", "l_linenumber"])


def lineitem_stream(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    # A pattern that only the table's own path meets: a source with a pattern reads a
    # single file as well as a folder of part files.
    return (spark.readStream.schema(li.schema).option("maxFilesPerTrigger", 8)
            .parquet(f"{sf_dir.rstrip('/')}/lineitem.parque[t]"))


def q_score_stream(spark, sf_dir):
    """The same model over lineitem read as a file stream."""
    path = _fitted_model_path(spark, sf_dir)
    stream = lineitem_stream(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus")
    sink = scratch_path(spark, "scored")
    q = SC.score_stream(spark, stream, path, sink, scratch_path(spark, "scored-ckpt"),
                        keys=["l_orderkey", "l_linenumber"])
    q.awaitTermination()
    return spark.read.parquet(sink)


def q_score_stream_vs_batch(spark, sf_dir):
    """How many lineitem rows the stream scored, and how many of them unlike the batch."""
    path, sink = _fitted_model_path(spark, sf_dir), scratch_path(spark, "scored")
    keys = ["l_orderkey", "l_linenumber"]
    SC.score_stream(spark, lineitem_stream(spark, sf_dir), path, sink, scratch_path(spark, "scored-ckpt"),
                    keys=keys).awaitTermination()
    batch = SC.score_batch(io.load_model(path), table(spark, sf_dir, "lineitem"), keys)
    # Keys repeat in lineitem: compare how often each scored row comes on either side.
    both = spark.read.parquet(sink).withColumn("n", F.lit(1)).unionByName(batch.withColumn("n", F.lit(-1)))
    rows = both.groupBy(*keys, "prediction", "probability").agg(
        F.count_if(F.col("n") > 0).alias("scored"), F.abs(F.sum("n")).alias("different"))
    return rows.agg(F.sum("scored").alias("scored"), F.sum("different").alias("different"))


def q_score_quarantine(spark, sf_dir):
    """Lineitem as a stream with missing quantities and NaN taxes: rows scored, rows set
    aside, and rows set aside by column."""
    path, sink, aside = (scratch_path(spark, n) if n else _fitted_model_path(spark, sf_dir) for n in ("", "scored", "aside"))
    k = F.col("l_orderkey")
    stream = lineitem_stream(spark, sf_dir).withColumns({
        "l_quantity": F.when(k % 7 != 0, F.col("l_quantity")),
        "l_tax": F.when(k % 11 == 0, F.lit(float("nan"))).otherwise(F.col("l_tax"))})
    SC.score_stream_quarantine(spark, stream, path, sink, aside, scratch_path(spark, "aside-ckpt"),
                               keys=["l_orderkey", "l_linenumber"]).awaitTermination()
    bad = spark.read.parquet(aside)
    parts = [spark.read.parquet(sink).where("prediction IS NOT NULL").agg(F.count("*").alias("rows")).select(F.lit("scored").alias("what"), "rows"),
             bad.agg(F.count("*").alias("rows")).select(F.lit("set aside").alias("what"), "rows"),
             bad.select(F.explode("bad_columns").alias("what")).groupBy("what").agg(F.count("*").alias("rows"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def q_model_by_epoch(spark, sf_dir):
    """Three model versions published between the micro-batches of one stream: the
    version that scored each epoch, and its rows."""
    path, log, src, sink, ckpt = _fitted_model_path(spark, sf_dir), *(scratch_path(spark, n) for n in ("models", "arrivals", "scored", "ckpt"))
    li = table(spark, sf_dir, "lineitem")
    for k in range(3):
        SC.publish_pointer(spark, log, path)
        li.where(F.col("l_orderkey") % 3 == k).write.mode("append").parquet(src)
        SC.follow_model(spark, spark.readStream.schema(li.schema).parquet(src), log, sink, ckpt,
                        keys=["l_orderkey", "l_linenumber"]).awaitTermination()
    return spark.read.parquet(sink).groupBy(F.col("epoch").cast("bigint").alias("epoch"), "model_version") \
        .agg(F.count("prediction").alias("rows"))


def side_by_side(rows: Sequence[DataFrame]) -> DataFrame:
    """One row with the columns of all frames, each of which has one row and columns of
    its own. No join: one of single rows has no condition, which a session may refuse
    (``spark.sql.crossJoin.enabled``)."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def q_retrain_committed(spark, sf_dir):
    """A forced retrain run twice under its own id: one committed run, one version, one
    consistent pointer, and the model it names."""
    li = lineitem_labeled(spark, sf_dir)
    base, new = (li.where(c).select(*LINEITEM_NUMERIC) for c in (lineitem_base(), ~lineitem_base()))
    root = scratch_path(spark, "retrain")
    first, second = (jobs.retrain_committed(base, new, li, lineitem_spec(), root, split_key="row_key", force=True).first()
                     for _ in range(2))
    version, model = SC.current_model(spark, f"{root}/commits")
    scored = SC.score_batch(io.load_model(model), li).agg(F.count("prediction").alias("scored"))
    runs = jobs.committed_runs(spark, root).agg(F.count("*").alias("runs"), F.max("dataset_rows").alias("dataset_rows"))
    same = F.lit(first == second and first["model_path"] == model)
    return side_by_side([scored, runs]).select(
        "scored", "runs", "dataset_rows", F.lit(version).cast("bigint").alias("version"), same.alias("same"),
        F.lit(first["drift"]).alias("drift"), F.lit(first["retrained"]).alias("retrained"))


def q_retrain_job(spark, sf_dir):
    """A forced retrain with all its outputs: the run row, the published pointer, the
    saved model and the report, each read back."""
    li = lineitem_labeled(spark, sf_dir)
    paths = {f"{k}_path": scratch_path(spark, f"retrain-{k}") for k in ("report", "runs", "model", "pointer")}
    decision, _ = jobs.retrain_on_drift(
        li.where(lineitem_base()).select(*LINEITEM_NUMERIC), li.where(~lineitem_base()).select(*LINEITEM_NUMERIC),
        li, lineitem_spec(), split_key="row_key", force=True, **paths)
    model = SC.read_pointer(spark, paths["pointer_path"])
    scored = SC.score_batch(io.load_model(model), li).agg(F.count("prediction").alias("scored"))
    runs = spark.read.parquet(paths["runs_path"]).agg(F.count("*").alias("runs"), F.max("dataset_rows").alias("dataset_rows"))
    report = spark.read.schema("numeric map<string,struct<psi:double,status:string>>").json(paths["report_path"]) \
        .select(F.size("numeric").alias("reported"))
    return side_by_side([decision.select("drift", "retrained"), scored, runs, report])


def q_retrain_decision(spark, sf_dir):
    """Drift gate over lineitem numerics (baseline: ship year <= 1998);
    retrains on the whole labelled table only when drift is found."""
    li = lineitem_labeled(spark, sf_dir)
    base_cond = lineitem_base()
    base = li.where(base_cond).select(*LINEITEM_NUMERIC)
    new = li.where(~base_cond).select(*LINEITEM_NUMERIC)
    decision, _ = jobs.retrain_on_drift(base, new, li, lineitem_spec(), split_key="row_key")
    return decision.select("drift", "check_failed", "forced", "retrained")


def q_run_series(spark, sf_dir):
    """Run rows derived from orders, written as CSV, read back as text."""
    od = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    ts = F.col("o_orderdate") + F.make_dt_interval(secs=k.cast("int"))
    runs = od.select(
        F.col("o_orderpriority").alias("experiment"),
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"),
        F.when(k % 13 == 0, F.lit("n/a"))
         .otherwise((F.col("o_totalprice") / 600000.0).cast("string")).alias("accuracy"),
        (F.col("o_totalprice") / 1000.0).cast("string").alias("fit_time_sec"),
        F.when(k % 17 == 0, F.lit("x")).otherwise((k % 8).cast("string"))
         .alias("shuffle_partitions"),
        k.cast("string").alias("run_id"))
    path = scratch_path(spark, "runs-csv")
    io.write_csv(runs, path)
    back = read_runs(spark, path)  # every column as text, like the reference's reader
    back = back.withColumn("run_key", F.col("run_id").cast("long"))
    return run_series(back, order_cols=("timestamp", "run_key"))


QUERIES = {
    "psi_numeric": q_psi_numeric,
    "psi_numeric_approx": q_psi_numeric_approx,
    "bin_edges": q_bin_edges,
    "histogram": q_histogram,
    "chi_square_categorical": q_chi_square_categorical,
    "drift_report": q_drift_report,
    "drift_any": q_drift_any,
    "drift_report_json": q_drift_report_json,
    "drift_report_file": q_drift_report_file,
    "drift_report_mismatch": q_drift_report_mismatch,
    "drift_by_window": q_drift_by_window,
    "drift_by_window_nulls": q_drift_by_window_nulls,
    "drift_by_window_mismatch": q_drift_by_window_mismatch,
    "windows_open": q_open_windows,
    "chi_square_by_window": q_chi_square_by_window,
    "report_by_window": q_report_by_window,
    "prep_fill_constant": q_prep_fill_constant,
    "baseline_median_unknown": q_baseline_median_unknown,
    "baseline_median_approx": q_baseline_median_approx,
    "baseline_csv": q_baseline_csv,
    "parquet_roundtrip": q_parquet_roundtrip,
    "csv_roundtrip": q_csv_roundtrip,
    "na_tokens_cast": q_na_tokens_cast,
    "csv_misfits": q_csv_misfits,
    "sketch_edge_ranks": q_sketch_edge_ranks,
    "sketch_psi": q_sketch_psi,
    "category_index": q_category_index,
    "one_hot": q_one_hot,
    "assembled": q_assembled,
    "training_layout": q_training_layout,
    "contingency_sorted": q_contingency_sorted,
    "family_features": q_family_features,
    "hash_split": q_hash_split,
    "accuracy": q_accuracy,
    "auc_exact": q_auc_exact,
    "auc_by": q_auc_by,
    "confusion": q_confusion,
    "confusion_other": q_confusion_other,
    "train_logreg": q_train_logreg,
    "train_logreg_moments": q_train_logreg_moments,
    "train_forest": q_train_forest,
    "model_choice": q_model_choice,
    "score_separable": q_score_separable,
    "forest_layouts": q_forest_layouts,
    "cross_validate": q_cross_validate,
    "score_batch": q_score_batch,
    "score_stream": q_score_stream,
    "score_stream_vs_batch": q_score_stream_vs_batch,
    "score_quarantine": q_score_quarantine,
    "model_by_epoch": q_model_by_epoch,
    "retrain_committed": q_retrain_committed,
    "retrain_job": q_retrain_job,
    "retrain_decision": q_retrain_decision,
    "run_series": q_run_series,
}

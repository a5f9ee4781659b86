"""Open windows and late rows against the batch report of the rows in time."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from driftline.session import scratch_path
from driftline.streaming import drift as SD
from driftline.streaming import open_windows as OW


def test_open_closed_and_late(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").select("event_id", "ts", "value", "event_type") \
        .withColumn("value", F.when(F.col("event_id") % 40 != 7, F.col("value").cast("string")).otherwise("n/a"))
    base = spark.read.parquet(f"{SF_SMALL}/events.parquet").select("ts", "value", "event_type") \
        .where(F.col("ts") < F.lit("2024-01-08").cast("timestamp_ntz"))
    day, late = F.dayofmonth("ts"), F.col("event_id") % 25 == 0
    first = ev.where((day <= 20) & ~((day <= 9) & late))
    second = ev.where((day == 20) & (F.col("event_id") % 2 == 0)).withColumn("ts", F.col("ts") + F.expr("interval 1 day")) \
        .where(F.dayofmonth("ts") == 21).unionByName(ev.where((day <= 9) & late))
    src, sink, ckpt = (scratch_path(spark, n) for n in ("src", "sink", "ckpt"))
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    seen = []
    for part in (first, second):
        part.write.mode("append").parquet(src)
        OW.open_windows_stream(spark.readStream.schema(ev.schema).parquet(src), "ts", base, sink, ckpt,
                               id_cols=["event_id"]).awaitTermination()
        seen.append({(r.window_start.day, r.column): r for r in OW.current_windows(spark, sink).collect()})
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before
    assert {d for (d, _), r in seen[0].items() if r.phase == "open"} == {20}
    assert {d for (d, _), r in seen[1].items() if r.phase == "open"} == {21}
    in_time = first.unionByName(second.where(F.dayofmonth("ts") == 21))
    wanted = {(r.window_start.day, r.column): r for r in SD.report_by_window_batch(in_time, "ts", base, id_cols=["event_id"]).collect()}
    assert set(wanted) == set(seen[1])
    for key, r in wanted.items():
        got = seen[1][key]
        assert (got.psi, got.statistic, got.dof, got.p_value, got.status) == (r.psi, r.statistic, r.dof, r.p_value, r.status)
    assert "type_mismatch" in {r.status for r in seen[1].values()}
    counts = {r.d: r.n for r in ev.where((day <= 9) & late).groupBy(day.alias("d")).agg(F.count("*").alias("n")).collect()}
    assert counts and all(r.late_rows == counts.get(d, 0) for (d, _), r in seen[1].items())

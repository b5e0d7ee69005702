"""State read as a table, restarts, state that ends, reports of progress."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from ratelake.contract import CRITICAL_COLUMNS
from ratelake.functions.wire import encode_json
from ratelake.operators.quality import audit_metrics, batch_audit
from ratelake.plans.venue import venue_pipeline, venue_rows
from ratelake.sources.topic import TopicSpec, publish
from ratelake.streaming.consumer import drain, latest_snapshot, parsed_stream, rocksdb_state, start_count, start_raw_audit
from ratelake.streaming.state import STATE, ProgressReport, idle_totals, observed, state_operators, state_table, stop_after


def test_state_after_every_micro_batch(spark, tmp_shared):
    rows = venue_pipeline(venue_rows(spark, SF001))
    spec = TopicSpec(kind="files", path=f"{tmp_shared}/topic")
    for k in range(4):
        publish(encode_json(rows.where(F.pmod(F.hash("restaurant_name"), F.lit(4)) == k)), spec, files=1)
    start = dict(checkpoint=f"{tmp_shared}/ck", mode="complete", snapshot_path=f"{tmp_shared}/snap")
    seen = stop_after(start_count(parsed_stream(spark, spec, max_per_trigger=1), trigger=None, **start), 2)
    assert seen >= 2
    before = {r["country"]: r["count"] for r in state_table(spark, f"{tmp_shared}/ck").collect()}
    drain(start_count(parsed_stream(spark, spec, max_per_trigger=1), **start))
    ops = state_operators(spark, f"{tmp_shared}/ck").first()
    assert (ops["operatorName"], ops["minBatchId"], ops["maxBatchId"]) == ("stateStoreSave", 0, 3)
    want = {r["country"]: r["count"] for r in rows.groupBy("country").count().collect()}
    history = [{r["country"]: r["count"] for r in state_table(spark, f"{tmp_shared}/ck", batch_id=b).collect()} for b in range(4)]
    assert history[3] == want == {r["country"]: r["count"] for r in latest_snapshot(spark, f"{tmp_shared}/snap").collect()}
    assert before in history[1:]  # what was committed when the query was stopped
    totals = [sum(h.values()) for h in history]
    assert totals == sorted(totals) and totals[0] < totals[1] < totals[3] == rows.count()


def test_stop_after_raises_instead_of_waiting_for_ever(spark, tmp_shared):
    spec = TopicSpec(kind="files", path=f"{tmp_shared}/topic")
    publish(spark.createDataFrame([('{"country": "x"}',)], "value string"), spec)
    start = dict(checkpoint=f"{tmp_shared}/ck", snapshot_path=f"{tmp_shared}/snap")
    with pytest.raises(TimeoutError):
        stop_after(start_count(parsed_stream(spark, spec), trigger=None, **start), 5, timeout_s=8)
    with pytest.raises(RuntimeError, match="ended after"):
        stop_after(start_count(parsed_stream(spark, spec), **start), 5)


_T = "k string, ts timestamp"


def _go(spark, root, rows):
    df = spark.createDataFrame(rows, "k string, s long").select("k", F.timestamp_seconds("s").alias("ts"))
    df.coalesce(1).write.mode("append").parquet(f"{root}/in")
    with rocksdb_state(spark):
        ended = idle_totals(spark.readStream.schema(_T).parquet(f"{root}/in"), "k", "ts", 100_000, delay="10 seconds")
        drain(ended.writeStream.format("parquet").option("path", f"{root}/ended").option("checkpointLocation", f"{root}/ck").trigger(availableNow=True).start())
    out = spark.read.schema("k string, count long, last_ms long").parquet(f"{root}/ended")
    live = state_table(spark, f"{root}/ck", variable=STATE)
    key = lambda r: (str(r[0]), r[1], r[2])
    return sorted((tuple(r) for r in out.collect()), key=key), sorted((tuple(r) for r in live.collect()), key=key)


def test_a_silent_key_leaves_the_state(spark, tmp_shared):
    ended, live = _go(spark, tmp_shared, [("a", 1000), ("a", 1010), ("b", 1005), (None, 1000), ("n", None)])
    assert ended == [] and live == [(None, 1, 1_000_000), ("a", 2, 1_010_000), ("b", 1, 1_005_000)]
    # the watermark reaches 1105: past the null key (1100) only
    ended, live = _go(spark, tmp_shared, [("b", 1115), ("b", 1015)])
    assert ended == [(None, 1, 1_000_000)] and live == [("a", 2, 1_010_000), ("b", 3, 1_115_000)]
    # an event inside the delay keeps its key alive; one behind it is dropped
    ended, live = _go(spark, tmp_shared, [("a", 1106), ("a", 1000), ("b", 1120)])
    assert ended == [(None, 1, 1_000_000)] and live == [("a", 3, 1_106_000), ("b", 4, 1_120_000)]
    # a comes back after its end: two totals, one live
    ended, live = _go(spark, tmp_shared, [("b", 1300)])
    assert ended == [(None, 1, 1_000_000), ("a", 3, 1_106_000)] and live == [("b", 5, 1_300_000)]
    ended, live = _go(spark, tmp_shared, [("a", 1301)])
    assert ended == [(None, 1, 1_000_000), ("a", 3, 1_106_000)] and live == [("a", 1, 1_301_000), ("b", 5, 1_300_000)]


def test_idle_totals_ask_for_rocksdb(spark, tmp_shared):
    spark.createDataFrame([], _T).write.parquet(f"{tmp_shared}/in")
    with pytest.raises(ValueError, match="RocksDB"):
        idle_totals(spark.readStream.schema(_T).parquet(f"{tmp_shared}/in"), "k", "ts", 1000)


def test_report_of_each_micro_batch(spark, tmp_shared):
    raw = venue_rows(spark, SF001)
    parts = [raw.where(F.col("venue_id") % 3 == k) for k in range(3)]
    report = ProgressReport(spark, f"{tmp_shared}/report", "venues")
    with pytest.raises(FileNotFoundError):
        report.table()
    spark.streams.addListener(report)
    try:
        for part in parts:
            part.write.mode("append").parquet(f"{tmp_shared}/in")
            stream = observed(spark.readStream.schema(raw.schema).parquet(f"{tmp_shared}/in"), "venues", audit_metrics(CRITICAL_COLUMNS))
            q = start_raw_audit(stream, f"{tmp_shared}/out", f"{tmp_shared}/ck")
            drain(q)
            report.wait(q)
    finally:
        spark.streams.removeListener(report)
    got = [r.asDict() for r in report.table().orderBy("batch_id").collect()]
    assert [g.pop("batch_id") for g in got] == [0, 1, 2]
    assert got == [batch_audit(p, CRITICAL_COLUMNS).first().asDict() for p in parts]

"""Streaming: consumer queries, ETL recovery, schema contract."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from ratelake.contract import CONTRACT_COLUMNS, CONTRACT_SCHEMA
from ratelake.functions.wire import encode_json, parse_json
from ratelake.plans.venue import venue_pipeline, venue_rows
from ratelake.sources.lake import lake_schema, read_dlq, read_lake
from ratelake.sources.topic import TopicSpec, publish, read_topic
from ratelake.streaming.consumer import ConsumerPaths, latest_snapshot, niche_filter, run_consumer
from ratelake.streaming.etl import run_etl_stream


def test_consumer_three_queries_match_batch(spark, tmp_shared):
    rows = venue_pipeline(venue_rows(spark, SF001))
    spec = TopicSpec(kind="files", path=f"{tmp_shared}/topic")
    publish(encode_json(rows), spec, files=3)
    qs = run_consumer(spark, spec, f"{tmp_shared}/out", max_per_trigger=1, timeout_s=300)
    # three files, one per trigger: the running count crossed micro-batches
    assert sum(1 for p in qs[2].recentProgress if p["numInputRows"] > 0) == 3
    p = ConsumerPaths(f"{tmp_shared}/out")
    audit = spark.read.schema(CONTRACT_SCHEMA).parquet(p.audit)
    assert audit.count() == rows.count()
    niche = spark.read.schema(CONTRACT_SCHEMA).csv(p.niche)
    assert niche.count() == rows.filter(niche_filter()).count() == 3
    counts = {r.country: r["count"] for r in latest_snapshot(spark, p.counts).collect()}
    want = {r.country: r["count"] for r in rows.groupBy("country").count().collect()}
    assert counts == want

    # restart with more data: each query resumes from its checkpoint
    publish(encode_json(rows), spec)
    run_consumer(spark, spec, f"{tmp_shared}/out", max_per_trigger=1, timeout_s=300)
    assert spark.read.schema(CONTRACT_SCHEMA).parquet(p.audit).count() == 2 * rows.count()
    counts2 = {r.country: r["count"] for r in latest_snapshot(spark, p.counts).collect()}
    assert counts2 == {k: 2 * v for k, v in want.items()}


def _landing(spark, tmp_shared, parts: int):
    raw = venue_rows(spark, SF001)
    raw.repartition(parts, "venue_id").write.mode("overwrite").parquet(f"{tmp_shared}/landing")
    return raw


def test_etl_recovers_without_duplicates(spark, tmp_shared):
    raw = _landing(spark, tmp_shared, 3)
    topic = TopicSpec(kind="files", path=f"{tmp_shared}/topic")
    args = (f"{tmp_shared}/landing", raw.schema, f"{tmp_shared}/lake", f"{tmp_shared}/dlq", topic, f"{tmp_shared}/ckpt")

    def boom(batch_id):
        if batch_id == 1:
            raise RuntimeError("injected failure after the lake write")

    with pytest.raises(Exception):
        run_etl_stream(spark, *args, max_files_per_trigger=1, timeout_s=300, after_lake_write=boom)
    # restart: batch 1 is replayed (same files), lake and DLQ replaced
    run_etl_stream(spark, *args, max_files_per_trigger=1, timeout_s=300)

    lake = read_lake(spark, f"{tmp_shared}/lake")
    good = raw.filter(" AND ".join(f"{c} IS NOT NULL" for c in ["restaurant_name", "country", "latitude", "longitude"]))
    assert lake.count() == good.count() == 147
    assert lake.select("restaurant_name").distinct().count() == 147
    assert sorted(r.batch_id for r in lake.select("batch_id").distinct().collect()) == [0, 1, 2]
    dlq = read_dlq(spark, f"{tmp_shared}/dlq")
    assert dlq.count() == 3 and dlq.select("restaurant_name").distinct().count() == 3
    # the topic is at-least-once: every good row is there, duplicates allowed
    pub = parse_json(read_topic(spark, topic))
    assert pub.select("restaurant_name").distinct().count() == 147

    # no new files: the next run processes no batch and changes nothing
    n_pub = pub.count()
    q = run_etl_stream(spark, *args, max_files_per_trigger=1, timeout_s=300)
    assert q.lastProgress is None or q.lastProgress["numInputRows"] == 0
    assert read_lake(spark, f"{tmp_shared}/lake").count() == 147
    assert parse_json(read_topic(spark, topic)).count() == n_pub


def test_etl_batch_scope_city_mean(spark, tmp_shared):
    raw = _landing(spark, tmp_shared, 2)
    topic = TopicSpec(kind="files", path=f"{tmp_shared}/topic")
    run_etl_stream(spark, f"{tmp_shared}/landing", raw.schema, f"{tmp_shared}/lake", f"{tmp_shared}/dlq",
                   topic, f"{tmp_shared}/ckpt", max_files_per_trigger=1, timeout_s=300)
    lake = read_lake(spark, f"{tmp_shared}/lake")
    # within a batch every row of a city carries that batch's mean
    per = lake.groupBy("batch_id", "city").agg(
        F.countDistinct("city_avg_rating").alias("k"),
        F.abs(F.avg("avg_rating") - F.first("city_avg_rating")).alias("e"),
    )
    assert per.agg(F.max("k")).first()[0] == 1
    assert per.agg(F.max("e")).first()[0] < 1e-9


def test_schema_contract_everywhere(spark, tmp_shared):
    rows = venue_pipeline(venue_rows(spark, SF001))
    assert rows.schema == CONTRACT_SCHEMA or [(f.name, f.dataType) for f in rows.schema] == [
        (f.name, f.dataType) for f in CONTRACT_SCHEMA
    ]
    from ratelake.sources.lake import write_batch

    write_batch(rows, f"{tmp_shared}/lake", 0)
    lk = read_lake(spark, f"{tmp_shared}/lake").select(*CONTRACT_COLUMNS)
    assert [(f.name, f.dataType) for f in lk.schema] == [(f.name, f.dataType) for f in CONTRACT_SCHEMA]
    wire = parse_json(encode_json(rows))
    assert [(f.name, f.dataType) for f in wire.schema] == [(f.name, f.dataType) for f in CONTRACT_SCHEMA]
    assert [f.name for f in lake_schema()][-2:] == ["batch_id", "country"]


def test_etl_lake_scope_city_mean_is_cumulative(spark, tmp_shared):
    raw = _landing(spark, tmp_shared, 3)
    topic = TopicSpec(kind="files", path=f"{tmp_shared}/topic")
    run_etl_stream(spark, f"{tmp_shared}/landing", raw.schema, f"{tmp_shared}/lake", f"{tmp_shared}/dlq",
                   topic, f"{tmp_shared}/ckpt", max_files_per_trigger=1, timeout_s=300,
                   context_scope="lake")
    lake = read_lake(spark, f"{tmp_shared}/lake")
    last = lake.agg(F.max("batch_id")).first()[0]
    assert last == 2
    # rows of the last batch carry the mean over all batches so far
    overall = {r.city: r.m for r in lake.groupBy("city").agg(F.avg("avg_rating").alias("m")).collect()}
    for r in lake.filter(F.col("batch_id") == last).select("city", "city_avg_rating").distinct().collect():
        assert abs(r.city_avg_rating - overall[r.city]) < 1e-9


def _csv_landing(spark, path):
    lines = [
        "venue_id,restaurant_name,country,city,latitude,longitude,avg_rating,total_reviews_count,price_level,claimed,vegetarian_friendly,gluten_free",
        "1,a,ES,Madrid,40.4,-3.7,4.5,12, $ ,Claimed,Y,Y",
        "2,b,ES,Madrid,40.4,-3.7,3.5,abc,$$$$,Unclaimed,N,N",
        "3,c,,Madrid,40.4,-3.7,4.0,7,$,Claimed,Y,N",
    ]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("overwrite").text(path)


RAW_SCHEMA = (
    "venue_id long, restaurant_name string, country string, city string, latitude double, "
    "longitude double, avg_rating double, total_reviews_count int, price_level string, "
    "claimed string, vegetarian_friendly string, gluten_free string"
)


@pytest.mark.parametrize("malformed_to_dlq", [False, True])
def test_etl_csv_malformed_cells(spark, tmp_shared, malformed_to_dlq):
    from pyspark.sql.types import _parse_datatype_string

    _csv_landing(spark, f"{tmp_shared}/landing")
    topic = TopicSpec(kind="files", path=f"{tmp_shared}/topic")
    run_etl_stream(spark, f"{tmp_shared}/landing", _parse_datatype_string(RAW_SCHEMA), f"{tmp_shared}/lake",
                   f"{tmp_shared}/dlq", topic, f"{tmp_shared}/ckpt", source_format="csv",
                   timeout_s=300, malformed_to_dlq=malformed_to_dlq)
    lake = {r.restaurant_name: r for r in read_lake(spark, f"{tmp_shared}/lake").collect()}
    dlq = {r.restaurant_name: r.dlq_reason for r in read_dlq(spark, f"{tmp_shared}/dlq").collect()}
    assert lake["a"].price_level_num == 1  # padded text, stripped
    # an empty CSV cell reads as null: a missing country is critical
    assert dlq["c"] == ["country"]
    if malformed_to_dlq:
        assert "b" not in lake and dlq["b"] == ["malformed"]
    else:
        # the bad cell reads as null, is imputed to 0, and the row stays good
        assert lake["b"].total_reviews_count == 0


def test_etl_csv_columns_by_header(spark, tmp_shared):
    from pyspark.sql.types import _parse_datatype_string

    lines = [
        "note,country,restaurant_name,city,longitude,latitude,avg_rating,total_reviews_count,price_level,claimed,vegetarian_friendly,gluten_free,venue_id",
        'x,ES,"a\nb",Madrid,-3.7,40.4,4.5,12,$,Claimed,Y,Y,1',
        "y,FR,c,Paris,2.3,48.9,3.5,7,$,Claimed,N,N,2",
    ]
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(f"{tmp_shared}/landing")
    schema, topic = _parse_datatype_string(RAW_SCHEMA), TopicSpec(kind="files", path=f"{tmp_shared}/topic")
    run = lambda fields, to: run_etl_stream(spark, f"{tmp_shared}/landing", fields, f"{tmp_shared}/lake{to}", f"{tmp_shared}/dlq{to}", topic,
                                            f"{tmp_shared}/ckpt{to}", source_format="csv", timeout_s=300, multi_line=True, malformed_to_dlq=True)
    run(schema, "")
    lake = {r.restaurant_name: (r.country, r.city, r.latitude, r.longitude, r.total_reviews_count) for r in read_lake(spark, f"{tmp_shared}/lake").collect()}
    assert lake == {"a\nb": ("ES", "Madrid", 40.4, -3.7, 12), "c": ("FR", "Paris", 48.9, 2.3, 7)}
    import os

    os.makedirs(f"{tmp_shared}/none".removeprefix("file:"))  # no files yet
    run_etl_stream(spark, f"{tmp_shared}/none", schema, f"{tmp_shared}/lake1", f"{tmp_shared}/dlq1", topic, f"{tmp_shared}/ckpt1", source_format="csv", timeout_s=300)
    with pytest.raises(ValueError, match="not in the header"):
        run(_parse_datatype_string(RAW_SCHEMA + ", phone string"), "2")


def test_count_update_mode_and_console_sink(spark, tmp_shared):
    from ratelake.streaming.consumer import parsed_stream, start_count, start_raw_audit

    rows = venue_pipeline(venue_rows(spark, SF001))
    spec = TopicSpec(kind="files", path=f"{tmp_shared}/topic")
    publish(encode_json(rows), spec, files=2)
    parsed = parsed_stream(spark, spec, max_per_trigger=1)
    q = start_count(parsed, f"{tmp_shared}/ck_upd", mode="update", fmt="memory", name="upd_counts")
    q.awaitTermination(300)
    assert q.exception() is None
    # update mode emits changed keys per batch; the last value per key is the running total
    got = spark.table("upd_counts").toPandas().groupby("country")["count"].max().to_dict()
    want = {r.country: r["count"] for r in rows.groupBy("country").count().collect()}
    assert got == want
    q2 = start_raw_audit(parsed, None, f"{tmp_shared}/ck_console", fmt="console")
    q2.awaitTermination(300)
    assert q2.exception() is None


def test_kafka_options_and_missing_connector(spark):
    spec = TopicSpec(kind="kafka", bootstrap_servers="broker:9092", topic="venues",
                     extra={"kafka.security.protocol": "SSL"})
    opts = spec.kafka_options()
    assert opts["kafka.acks"] == "all" and opts["kafka.enable.idempotence"] == "true"
    assert opts["kafka.bootstrap.servers"] == "broker:9092" and opts["kafka.security.protocol"] == "SSL"
    src = spec.kafka_source_options()
    assert "kafka.acks" not in src and src["kafka.security.protocol"] == "SSL"
    df = spark.createDataFrame([("{}",)], "value string")
    with pytest.raises(Exception) as ei:
        publish(df, spec)
    assert "kafka" in str(ei.value).lower()


def test_fused_consumer_equals_three_queries(spark, tmp_shared):
    from ratelake.streaming.consumer import latest_counts, run_consumer_fused

    rows = venue_pipeline(venue_rows(spark, SF001))
    spec = TopicSpec(kind="files", path=f"{tmp_shared}/topic")
    publish(encode_json(rows), spec, files=3)
    run_consumer_fused(spark, spec, f"{tmp_shared}/out", max_per_trigger=1, timeout_s=300)
    p = ConsumerPaths(f"{tmp_shared}/out")
    assert spark.read.parquet(p.audit).count() == rows.count()
    assert spark.read.schema(CONTRACT_SCHEMA).csv(p.niche).count() == rows.filter(niche_filter()).count()
    want = {r.country: r["count"] for r in rows.groupBy("country").count().collect()}
    assert {r.country: r["count"] for r in latest_counts(spark, f"{tmp_shared}/out").collect()} == want
    # more data later: the counts continue from the last version
    publish(encode_json(rows), spec)
    run_consumer_fused(spark, spec, f"{tmp_shared}/out", max_per_trigger=1, timeout_s=300)
    got = {r.country: r["count"] for r in latest_counts(spark, f"{tmp_shared}/out").collect()}
    assert got == {k: 2 * v for k, v in want.items()}


def test_etl_all_bad_batch_still_commits(spark, tmp_shared):
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL(RAW_SCHEMA)
    rows = [(1, "a", None, "X", 1.0, 1.0, 4.0, 3, "$", "Claimed", "Y", "Y"),
            (2, None, "ES", "Y", 1.0, 1.0, 4.0, 3, "$", "Claimed", "Y", "Y")]
    spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{tmp_shared}/landing")
    topic = TopicSpec(kind="files", path=f"{tmp_shared}/topic")
    args = (f"{tmp_shared}/landing", schema, f"{tmp_shared}/lake", f"{tmp_shared}/dlq", topic, f"{tmp_shared}/ckpt")
    q = run_etl_stream(spark, *args, timeout_s=300)
    assert q.lastProgress["numInputRows"] == 2
    assert read_dlq(spark, f"{tmp_shared}/dlq").count() == 2
    assert read_lake(spark, f"{tmp_shared}/lake").count() == 0
    # committed: a restart has nothing left to do
    q2 = run_etl_stream(spark, *args, timeout_s=300)
    assert q2.lastProgress is None or q2.lastProgress["numInputRows"] == 0


def test_etl_archives_committed_landing_files(spark, tmp_shared):
    import glob

    raw = _landing(spark, tmp_shared, 2)
    topic = TopicSpec(kind="files", path=f"{tmp_shared}/topic")
    run_etl_stream(spark, f"{tmp_shared}/landing", raw.schema, f"{tmp_shared}/lake", f"{tmp_shared}/dlq",
                   topic, f"{tmp_shared}/ckpt", max_files_per_trigger=1, timeout_s=300,
                   clean_source="archive", archive_dir=f"{tmp_shared}/archive")
    assert read_lake(spark, f"{tmp_shared}/lake").count() == 147
    local = tmp_shared.replace("file:", "")
    # files of committed batches are moved out (the last may await the next batch)
    left = glob.glob(f"{local}/landing/*.parquet")
    assert len(left) <= 1 and glob.glob(f"{local}/archive/**/*.parquet", recursive=True)


def test_dedup_with_rocksdb_state(spark, tmp_shared):
    from ratelake.operators.model import VENUE_KEY
    from ratelake.streaming.consumer import dedup, parsed_stream, start_raw_audit

    key = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(key)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        rows = venue_pipeline(venue_rows(spark, SF001))
        spec = TopicSpec(kind="files", path=f"{tmp_shared}/topic")
        publish(encode_json(rows), spec)
        publish(encode_json(rows), spec)  # redelivery
        q = start_raw_audit(dedup(parsed_stream(spark, spec, max_per_trigger=1), VENUE_KEY),
                            f"{tmp_shared}/out", f"{tmp_shared}/ck")
        q.awaitTermination(300)
        assert q.exception() is None
        assert spark.read.parquet(f"{tmp_shared}/out").count() == rows.count()
    finally:
        spark.conf.set(key, old)


def test_etl_increment_walks_capped_slices_and_recovers(spark, tmp_shared):
    from ratelake.streaming.etl import run_etl_increment

    raw = venue_rows(spark, SF001)
    topic = TopicSpec(kind="files", path=f"{tmp_shared}/topic")
    args = (spark, raw, "venue_id", f"{tmp_shared}/lake", f"{tmp_shared}/dlq", topic, f"{tmp_shared}/state")

    def boom(batch_id):
        if batch_id == 1:
            raise RuntimeError("injected failure after the lake write")

    assert run_etl_increment(*args, cap=60, audit=f"{tmp_shared}/audit") == 0
    a0 = spark.read.parquet(f"{tmp_shared}/audit/batch_id=0").first()
    assert (a0.n_rows, a0.n_good + a0.n_bad) == (60, 60)
    with pytest.raises(RuntimeError):
        run_etl_increment(*args, cap=60, after_lake_write=boom)
    ids = []
    while (b := run_etl_increment(*args, cap=60)) is not None:
        ids.append(b)
    assert ids == [1, 2]  # the failed batch 1 was repeated, then batch 2
    lake = read_lake(spark, f"{tmp_shared}/lake")
    assert lake.count() == 147 and lake.select("restaurant_name").distinct().count() == 147
    per_batch = {r.batch_id: r["count"] for r in lake.groupBy("batch_id").count().collect()}
    dlq = read_dlq(spark, f"{tmp_shared}/dlq")
    bad = {r.batch_id: r["count"] for r in dlq.groupBy("batch_id").count().collect()}
    # 60 + 60 + 30 source rows per batch, split between lake and DLQ
    assert {b: per_batch.get(b, 0) + bad.get(b, 0) for b in (0, 1, 2)} == {0: 60, 1: 60, 2: 30}


def test_etl_byte_capped_micro_batches(spark, tmp_shared):
    raw = _landing(spark, tmp_shared, 3)
    topic = TopicSpec(kind="files", path=f"{tmp_shared}/topic")
    q = run_etl_stream(spark, f"{tmp_shared}/landing", raw.schema, f"{tmp_shared}/lake", f"{tmp_shared}/dlq",
                       topic, f"{tmp_shared}/ckpt", max_bytes_per_trigger=1024, timeout_s=300)
    assert sum(1 for p in q.recentProgress if p["numInputRows"] > 0) == 3  # one file per batch
    assert read_lake(spark, f"{tmp_shared}/lake").count() == 147


def test_versioned_state_keeps_two_versions(spark, tmp_shared):
    from ratelake.session import list_batch_ids
    from ratelake.streaming.consumer import latest_counts, run_consumer_fused

    rows = venue_pipeline(venue_rows(spark, SF001))
    spec = TopicSpec(kind="files", path=f"{tmp_shared}/topic")
    publish(encode_json(rows), spec, files=4)
    run_consumer_fused(spark, spec, f"{tmp_shared}/out", max_per_trigger=1, timeout_s=300)
    assert list_batch_ids(spark, ConsumerPaths(f"{tmp_shared}/out").counts) == [2, 3]
    assert sum(r["count"] for r in latest_counts(spark, f"{tmp_shared}/out").collect()) == rows.count()


def test_fused_consumer_replay_is_idempotent(spark, tmp_shared):
    from ratelake.streaming.consumer import latest_counts, run_consumer_fused

    rows = venue_pipeline(venue_rows(spark, SF001))
    spec = TopicSpec(kind="files", path=f"{tmp_shared}/topic")
    publish(encode_json(rows), spec, files=3)

    def boom(batch_id):
        if batch_id == 1:
            raise RuntimeError("injected failure after the audit write")

    with pytest.raises(Exception):
        run_consumer_fused(spark, spec, f"{tmp_shared}/out", max_per_trigger=1, timeout_s=300, after_audit=boom)
    run_consumer_fused(spark, spec, f"{tmp_shared}/out", max_per_trigger=1, timeout_s=300)
    p = ConsumerPaths(f"{tmp_shared}/out")
    audit = spark.read.parquet(p.audit)
    assert audit.count() == rows.count() and audit.select("restaurant_name").distinct().count() == rows.count()
    want = {r.country: r["count"] for r in rows.groupBy("country").count().collect()}
    assert {r.country: r["count"] for r in latest_counts(spark, f"{tmp_shared}/out").collect()} == want


def test_update_mode_snapshot_merges_changed_keys(spark, tmp_shared):
    from ratelake.streaming.consumer import parsed_stream, start_count

    rows = venue_pipeline(venue_rows(spark, SF001))
    spec = TopicSpec(kind="files", path=f"{tmp_shared}/topic")
    # two batches whose countries differ: the second must not drop the first's keys
    publish(encode_json(rows.filter("country <= 'ASIA'")), spec, files=1)
    publish(encode_json(rows.filter("country > 'ASIA'")), spec, files=1)
    q = start_count(parsed_stream(spark, spec, max_per_trigger=1), f"{tmp_shared}/ck",
                    mode="update", snapshot_path=f"{tmp_shared}/snap")
    q.awaitTermination(300)
    assert q.exception() is None
    want = {r.country: r["count"] for r in rows.groupBy("country").count().collect()}
    got = {r.country: r["count"] for r in latest_snapshot(spark, f"{tmp_shared}/snap").collect()}
    assert got == want


def test_dedup_within_watermark_on_event_time(spark, tmp_shared):
    from ratelake.functions.wire import to_json_value
    from ratelake.plans.q_stream import EVENTS_SCHEMA
    from ratelake.sources.tables import table
    from ratelake.streaming.consumer import dedup, parsed_stream, start_raw_audit

    ev = table(spark, SF001, "events")
    spec = TopicSpec(kind="files", path=f"{tmp_shared}/topic")
    msgs = ev.select(to_json_value(ev.columns).alias("value"))
    publish(msgs, spec, files=2)
    publish(msgs, spec, files=2)  # every event delivered twice
    parsed = parsed_stream(spark, spec, EVENTS_SCHEMA, max_per_trigger=1)
    # state bounded by the event-time watermark instead of growing forever
    q = start_raw_audit(dedup(parsed, ["event_id"], event_time="ts", delay="365 days"),
                        f"{tmp_shared}/out", f"{tmp_shared}/ck")
    q.awaitTermination(300)
    assert q.exception() is None
    out = spark.read.parquet(f"{tmp_shared}/out")
    assert out.count() == ev.count() and out.select("event_id").distinct().count() == ev.count()

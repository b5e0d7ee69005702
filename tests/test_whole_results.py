"""No partial, lossy or zone-dependent results from the streaming and
incremental runs, and exact types through the distributed running sums."""

from __future__ import annotations

import os
import time

import pytest
from conftest import SF001
from pyspark.sql import Window
from pyspark.sql import functions as F

from ratelake.functions.wire import encode_json
from ratelake.operators.ordering import global_position, prefix_sums
from ratelake.plans.venue import venue_pipeline, venue_rows
from ratelake.session import materialize, write_marker
from ratelake.sources.ingest import infer_csv_schema, read_csv_tolerant
from ratelake.sources.lake import batch_path, read_dlq, read_lake
from ratelake.sources.topic import TopicSpec, publish
from ratelake.streaming.consumer import drain, latest_snapshot, parsed_stream, run_consumer_fused, start_raw_audit
from ratelake.streaming.etl import NULL_KEY_BATCH, run_etl_increment


def _timed_source(spark, path, n=24):
    raw = venue_rows(spark, SF001).limit(n)
    raw = materialize(raw, "timed")
    step = F.row_number().over(Window.orderBy("venue_id")).cast("long")
    raw.withColumn("at", F.timestamp_micros(F.lit(1_700_000_000_000_123) + step * 1_800_000_000)).write.parquet(path)
    return spark.read.parquet(path)


def _walk(spark, source, key, root, cap):
    topic = TopicSpec(kind="files", path=f"{root}/topic")
    runs = 0
    while run_etl_increment(spark, source, key, f"{root}/lake", f"{root}/dlq", topic, f"{root}/state", cap=cap) is not None:
        runs += 1
        assert runs < 12
    return runs


@pytest.mark.parametrize("zone", ["Asia/Tokyo", "America/New_York"])
def test_timestamp_key_in_any_driver_zone(spark, tmp_shared, zone):
    before = os.environ.get("TZ")
    os.environ["TZ"] = zone
    time.tzset()
    try:
        source = _timed_source(spark, f"{tmp_shared}/source")
        assert _walk(spark, source, "at", tmp_shared, cap=8) == 3
    finally:
        os.environ.pop("TZ") if before is None else os.environ.update(TZ=before)
        time.tzset()
    bad = source.filter(" OR ".join(f"{c} IS NULL" for c in ("restaurant_name", "country", "latitude", "longitude"))).count()
    assert read_lake(spark, f"{tmp_shared}/lake").count() == source.count() - bad


def test_null_keys_go_to_the_dlq_and_late_rows_raise(spark, tmp_shared):
    rows = materialize(venue_rows(spark, SF001).limit(10), "late")
    ids = sorted(r.venue_id for r in rows.select("venue_id").collect())
    nulled = rows.withColumn("venue_id", F.when(F.col("venue_id") != ids[3], F.col("venue_id")))
    _walk(spark, nulled, "venue_id", tmp_shared, cap=4)
    dlq = read_dlq(spark, f"{tmp_shared}/dlq").filter(F.col("batch_id") == NULL_KEY_BATCH)
    assert [list(r.dlq_reason) for r in dlq.collect()] == [["null_key"]]
    topic = TopicSpec(kind="files", path=f"{tmp_shared}/topic")
    with pytest.raises(ValueError, match="late"):
        run_etl_increment(spark, rows, "venue_id", f"{tmp_shared}/lake", f"{tmp_shared}/dlq", topic, f"{tmp_shared}/state", cap=4)


def test_values_beyond_int_are_dead_lettered(spark, tmp_shared):
    rows = venue_rows(spark, SF001).limit(3).withColumn("total_reviews_count", F.lit(2**40).cast("double"))
    _walk(spark, materialize(rows, "wide"), "venue_id", tmp_shared, cap=0)
    reasons = [r.dlq_reason for r in read_dlq(spark, f"{tmp_shared}/dlq").collect()]
    assert len(reasons) == 3 and all("total_reviews_count:out_of_range" in r for r in reasons)


def test_reached_time_limit_raises(spark, tmp_shared):
    rows = encode_json(venue_pipeline(venue_rows(spark, SF001)))
    spec = TopicSpec(kind="files", path=f"{tmp_shared}/topic")
    for _ in range(3):
        publish(rows, spec)
    with pytest.raises(TimeoutError):
        run_consumer_fused(spark, spec, f"{tmp_shared}/out", max_per_trigger=1, timeout_s=0.2)
    run_consumer_fused(spark, spec, f"{tmp_shared}/out", max_per_trigger=1)  # goes on to the end
    q = start_raw_audit(parsed_stream(spark, spec), f"{tmp_shared}/audit", f"{tmp_shared}/ck")
    drain(q)
    assert spark.read.parquet(f"{tmp_shared}/audit").count() == 3 * rows.count()


def test_versions_commits_and_missing_state(spark, tmp_shared):
    spark.range(2).write.parquet(batch_path(tmp_shared, 0))
    spark.range(5).write.parquet(f"{batch_path(tmp_shared, 1)}/_temporary/0")
    assert latest_snapshot(spark, tmp_shared).count() == 2
    write_marker(spark, f"{tmp_shared}/c/1.json", "a")
    with pytest.raises(FileExistsError):
        write_marker(spark, f"{tmp_shared}/c/1.json", "b")


def test_exact_types_through_positions(spark):
    big = 2**53 + 1
    df = spark.sql(
        f"SELECT * FROM VALUES (1L, CAST({big} AS BIGINT), TIMESTAMP'9999-12-31 00:00:00', CAST('1.10' AS DECIMAL(20,2)), array(1L)),"
        f" (2L, NULL, NULL, NULL, NULL), (3L, CAST({big + 2} AS BIGINT), NULL, NULL, NULL) AS t(k, v, at, d, a)"
    )
    got = global_position(df, ["k"]).selectExpr("k", "v", "cast(at as string) at", "cast(d as string) d", "a", "_pos").collect()
    assert sorted((r.k, r.v, r.at, r.d, r.a, r._pos) for r in got) == [
        (1, big, "9999-12-31 00:00:00", "1.10", [1], 0), (2, None, None, None, None, 1), (3, big + 2, None, None, None, 2)
    ]
    sums = prefix_sums(df.union(df), ["k"], "k", ["v"], num_partitions=2).groupBy("v").agg(F.max("_cum")).collect()
    assert {r.v: r[1] for r in sums} == {big: 2, None: 4, big + 2: 6}


def test_csv_by_header_name_with_quotes(spark, tmp_shared):
    text = 'link,rating,"hours",city\nx1,4.5,"{""Mon"": [""11:00"", ""12:00""]}","A\nB"\nx2,bad,"",C\n'
    path = f"{tmp_shared}/wide.csv"
    write_marker(spark, path, text)
    schema = "city string, rating double, hours string"
    from pyspark.sql.types import _parse_datatype_string

    got = read_csv_tolerant(spark, path, _parse_datatype_string(schema), multi_line=True, corrupt_column=None).collect()
    assert [(r.city, r.rating, r.hours) for r in got][0] == ("A\nB", 4.5, '{"Mon": ["11:00", "12:00"]}')
    assert got[1].rating is None and got[1].city == "C"
    with pytest.raises(ValueError, match="header"):
        read_csv_tolerant(spark, path, _parse_datatype_string("nowhere string"))


def test_inference_sees_every_row(spark, tmp_shared):
    lines = "n\n" + "\n".join(["1"] * 400 + ["2.5"] + ["3"] * 400) + "\n"
    write_marker(spark, f"{tmp_shared}/n.csv", lines)
    assert infer_csv_schema(spark, f"{tmp_shared}/n.csv")["n"].dataType.simpleString() == "double"

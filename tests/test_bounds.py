"""Measured broadcasts, whole-batch replacement, bounded dedup state,
clean-up of written tables, and profiles out of value counts."""

from __future__ import annotations

import os
import statistics

import pytest
from conftest import SF001
from pyspark.sql import functions as F

from ratelake import session
from ratelake.functions.wire import encode_json
from ratelake.operators.joins import bounded_broadcast
from ratelake.operators.profile import boxplot_stats, describe_column
from ratelake.plans.venue import venue_pipeline, venue_rows
from ratelake.sources.lake import read_dlq, read_lake, write_batches, write_dlq_batches
from ratelake.sources.topic import TopicSpec, publish
from ratelake.streaming.consumer import dedup, parsed_stream


@pytest.mark.parametrize("width, broadcast", [(2000, False), (4, True)])
def test_broadcast_goes_by_measured_bytes(spark, width, broadcast):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small = spark.range(200).select("id", F.repeat(F.lit("x"), width).alias("t"))
        joined = spark.range(1000).join(bounded_broadcast(small, max_bytes=100_000), "id")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert ("BroadcastHashJoin" in plan) is broadcast
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_an_empty_side_is_within_the_bound(spark):
    assert bounded_broadcast(spark.range(0).select("id", F.lit("a").alias("t"))).count() == 0


def test_bulk_writers_leave_no_orphans(spark, tmp_shared):
    rows = venue_pipeline(venue_rows(spark, SF001)).withColumn("batch_id", F.pmod(F.xxhash64("restaurant_name"), F.lit(3)))
    rows = session.materialize(rows, "bulk")
    write_batches(rows.withColumn("country", F.concat("country", F.lit("_first"))), f"{tmp_shared}/lake")
    again = rows.where("batch_id = 1")
    write_batches(again, f"{tmp_shared}/lake")
    lake = read_lake(spark, f"{tmp_shared}/lake")
    assert lake.count() == rows.count()
    assert lake.where("batch_id = 1 and country like '%_first'").count() == 0
    assert lake.where("batch_id <> 1 and country not like '%_first'").count() == 0

    bad = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "batch_id long, why string")
    write_dlq_batches(bad, f"{tmp_shared}/dlq")
    write_dlq_batches(bad.where("batch_id = 0").withColumn("why", F.lit("z")), f"{tmp_shared}/dlq", retried=[0, 1])
    assert sorted((r.batch_id, r.why) for r in read_dlq(spark, f"{tmp_shared}/dlq").collect()) == [(0, "z"), (2, "c")]


def test_unbounded_dedup_has_to_be_asked_for(spark, tmp_shared):
    spec = TopicSpec(kind="files", path=f"{tmp_shared}/topic")
    publish(encode_json(venue_pipeline(venue_rows(spark, SF001))), spec)
    with pytest.raises(ValueError, match="event_time"):
        dedup(parsed_stream(spark, spec), ["restaurant_name"])


def test_clean_up_leaves_no_written_table(spark):
    session.clean_up(spark)
    path = session.materialize(spark.range(5), "to-go").inputFiles()[0].removeprefix("file:")
    describe_column(venue_rows(spark, SF001), "avg_rating", ["city"]).count()
    assert os.path.exists(path)
    assert session.clean_up(spark) >= 2
    assert not os.path.exists(os.path.dirname(path)) and session.clean_up(spark) == 0


def test_profiles_from_value_counts(spark):
    data = [("a", 1.0), ("a", 2.0), ("a", 2.0), ("a", 40.0), ("a", None), ("b", 7.0), ("c", None), (None, 3.0), (None, 5.0)]
    df = spark.createDataFrame(data, "g string, v double")
    got = {r["g"]: r for r in describe_column(df, "v", ["g"]).collect()}
    for g in ("a", "b", "c", None):
        of = [v for k, v in data if k == g]
        have = [v for v in of if v is not None]
        r = got[g]
        assert (r["count"], r["null_count"]) == (len(have), len(of) - len(have))
        assert (r["min"], r["max"]) == ((min(have), max(have)) if have else (None, None))
        assert r["mean"] == (pytest.approx(statistics.mean(have)) if have else None)
        assert r["std"] == (pytest.approx(statistics.stdev(have)) if len(have) > 1 else None)
        assert r["median"] == (pytest.approx(statistics.median(have)) if have else None)
    whole = describe_column(df, "v").first()
    have = [v for _, v in data if v is not None]
    assert (whole["count"], whole["null_count"], whole["median"]) == (7, 2, 3.0)
    assert whole["std"] == pytest.approx(statistics.stdev(have))
    none = describe_column(df.where("v is null"), "v").first()
    assert (none["count"], none["null_count"], none["mean"], none["p25"], none["max"]) == (0, 2, None, None, None)
    assert describe_column(df.limit(0), "v").first()["count"] == 0
    box = {r["g"]: r for r in boxplot_stats(df, "v", "g").collect()}
    assert set(box) == {"a", "b"}
    a = box["a"]
    assert (a["n"], a["median"], a["n_outliers"], a["min"], a["max"]) == (4, 2.0, 1, 1.0, 40.0)
    assert (a["whisker_lo"], a["whisker_hi"]) == (1.0, 2.0)

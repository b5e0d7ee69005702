"""Small library functions: schema listing, CSV schema discovery, random split,
slice after a watermark."""

from __future__ import annotations

from conftest import SF001
from ratelake.operators.model import random_split
from ratelake.operators.profile import schema_listing
from ratelake.sources.ingest import infer_csv_schema, slice_walk
from ratelake.sources.tables import table


def test_schema_listing(spark):
    ev = table(spark, SF001, "events")
    assert schema_listing(ev) == [
        ("event_id", "bigint"), ("ts", "timestamp_ntz"), ("user_id", "bigint"),
        ("event_type", "string"), ("value", "double"), ("props", "string"),
    ]


def test_infer_csv_schema(spark, tmp_shared):
    part = table(spark, SF001, "part")
    part.write.mode("overwrite").option("header", "true").csv(tmp_shared)
    got = dict((f.name, f.dataType.simpleString()) for f in infer_csv_schema(spark, tmp_shared, 1.0))
    assert got["p_partkey"] == "int" and got["p_size"] == "int" and got["p_retailprice"] == "double"
    assert got["p_name"] == "string"


def test_random_split_partitions_all_rows(spark):
    o = table(spark, SF001, "orders").select("o_orderkey")
    tr, te = random_split(o, 0.8, 42)
    assert tr.count() + te.count() == o.count()
    assert tr.intersect(te).count() == 0


def test_slice_walk_after_watermark(spark):
    ev = table(spark, SF001, "events").select("event_id")
    w = slice_walk(ev, "event_id", 100, after=499).toPandas()
    assert w.event_id.min() == 500 and len(w) == ev.filter("event_id > 499").count()
    assert (w.sort_values("event_id").slice_no.to_numpy() == (w.sort_values("event_id").event_id.to_numpy() - 500) // 100).all()


def test_next_slice_is_a_range_filter(spark):
    from pyspark.sql import functions as F

    from ratelake.sources.ingest import next_slice

    ev = table(spark, SF001, "events")
    s = next_slice(ev, "event_id", 99, 250)
    plan = s._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" not in plan and "GlobalLimit" not in plan
    got = sorted(r.event_id for r in s.select("event_id").collect())
    assert got == list(range(100, 350))
    assert next_slice(ev, "event_id", 10**9, 5).count() == 0
    assert next_slice(ev.filter(F.col("event_id") < 120), "event_id", 99, 250).count() == 20


def test_describe_approx_quartiles_within_rank_error(spark):
    from ratelake.operators.profile import describe_column

    li = table(spark, SF001, "lineitem")
    exact = describe_column(li, "l_extendedprice").first()
    approx = describe_column(li, "l_extendedprice", approx_accuracy=10_000).first()
    vals = sorted(r.l_extendedprice for r in li.select("l_extendedprice").collect())
    n = len(vals)
    for name, p in (("p25", 0.25), ("median", 0.5), ("p75", 0.75)):
        # the approximate value's rank is within n / accuracy (+1) of p * n
        rank = sum(1 for v in vals if v <= approx[name])
        assert abs(rank - p * n) <= n / 10_000 + 1
        assert abs(approx[name] - exact[name]) <= (vals[-1] - vals[0])
    assert approx["count"] == exact["count"] and approx["mean"] == exact["mean"]


def test_boxplot_approx_matches_exact_on_few_values(spark):
    from ratelake.operators.profile import boxplot_stats

    ev = table(spark, SF001, "events")
    exact = {r.event_type: r for r in boxplot_stats(ev, "value", "event_type").collect()}
    approx = {r.event_type: r for r in boxplot_stats(ev, "value", "event_type", approx_accuracy=100_000).collect()}
    assert exact.keys() == approx.keys()
    for k in exact:
        assert exact[k].n == approx[k].n and exact[k]["min"] == approx[k]["min"]
        # with small groups the sketch is exact up to interpolation between neighbours
        assert approx[k].q1 <= exact[k].q3 and approx[k].q3 >= exact[k].q1


def test_xxhash_split_is_layout_independent(spark):
    from ratelake.operators.model import with_split

    o = table(spark, SF001, "orders").select("o_orderkey")
    a = with_split(o.repartition(1), ["o_orderkey"], method="xxhash64")
    b = with_split(o.repartition(7), ["o_orderkey"], method="xxhash64")
    assert a.exceptAll(b).count() == 0
    frac = a.filter("split = 'train'").count() / o.count()
    assert 0.7 < frac < 0.9

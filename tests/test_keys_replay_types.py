"""Out-of-fold means, duplicates behind the watermark, replay of the DLQ and
type discovery."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from ratelake.operators.context import out_of_fold_context
from ratelake.plans.venue import venue_rows
from ratelake.sources.lake import read_dlq, read_lake, write_batch, write_dlq_batches
from ratelake.sources.types import count_kinds, discover_csv, drift, merge_kinds, typed
from ratelake.streaming.known_keys import key_words, maybe_known, new_rows, run_dedup_lake
from ratelake.streaming.replay import REPLAY_BASE, read_ledger, replay


# --- out of fold


@pytest.mark.parametrize("m", [0.0, 3.0])
def test_no_row_sees_its_fold(spark, m):
    rnd = random.Random(8)
    rows = [(i, rnd.choice(["a", "b", None, "hot", "hot", "hot"]), None if rnd.random() < 0.1 else rnd.gauss(5, 2), i % 4) for i in range(300)]
    rows += [(900, "alone", 7.0, 2), (901, "null", None, 1), (902, "a", 1.0, None), (903, "one fold", 3.0, 0), (904, "one fold", 9.0, 0)]
    df = spark.createDataFrame(rows, "id long, g string, v double, f int")
    out = {r["id"]: r for r in out_of_fold_context(df, "v", ["g"], F.col("f"), "mean", m, fold_col="k").collect()}
    assert len(out) == len(rows)
    for i, g, _, f in rows:
        rest = [v for _, _, v, x in rows if x != f and v is not None]
        own = [v for _, h, v, x in rows if h == g and x != f and v is not None]
        mean = sum(rest) / len(rest)
        want = (sum(own) + m * mean) / (len(own) + m) if own or m else None
        assert out[i]["mean"] == (pytest.approx(want) if want is not None else None), (i, g, f)
    empty = df.where("false")
    assert out_of_fold_context(empty, "v", ["g"], F.col("f"), "mean", m, fold_col="k").collect() == []


# --- keys that the lake knows

_M = "a long, b string, v long"


def _land(spark, root, rows, go):
    spark.createDataFrame(rows, _M).write.mode("append").parquet(f"{root}/in/go={go}")


def _run(spark, root, **kw):
    stream = spark.readStream.schema(_M).parquet(f"{root}/in/*")
    return run_dedup_lake(stream, f"{root}/lake", ["a", "b"], f"{root}/ck", timeout_s=300, **kw)


@pytest.mark.parametrize("words", [1, 4, 1 << 12])
def test_the_filter_never_denies_a_known_key(spark, words):
    known = spark.range(2000).select(F.col("id").alias("a"), F.when(F.col("id") % 7 > 0, F.col("id").cast("string")).alias("b"))
    other = spark.range(5000, 9000).select(F.col("id").alias("a"), F.lit("x").alias("b"))
    filled = key_words(known, ["a", "b"], words)
    assert filled.count() <= words
    assert maybe_known(known, filled, ["a", "b"], words).where("NOT _maybe").count() == 0
    wrong = maybe_known(other, filled, ["a", "b"], words).where("_maybe").count()
    assert wrong < 40 if words > 1000 else wrong > 3000  # a full filter leaves all to the exact join


@pytest.mark.parametrize("words", [2, 1 << 12])
def test_late_duplicates_are_dropped_and_none_is_lost(spark, tmp_shared, words):
    first = [(i, None if i % 5 == 0 else str(i), i) for i in range(200)] + [(None, None, -1), (None, "n", -2)]
    _land(spark, tmp_shared, first + first[:50], 0)
    _run(spark, tmp_shared, words=words)
    again = first[:120] + [(i, "new", i) for i in range(30)] + [(None, None, -9)]
    _land(spark, tmp_shared, again, 1)

    def boom(batch_id):
        raise RuntimeError("injected between the lake and its filter")

    with pytest.raises(Exception):
        _run(spark, tmp_shared, words=words, after_write=boom)
    _run(spark, tmp_shared, words=words)  # the micro-batch is taken again
    _land(spark, tmp_shared, first, 2)
    _run(spark, tmp_shared, words=words)
    got = sorted(map(str, (tuple(r) for r in spark.read.schema(_M).parquet(f"{tmp_shared}/lake").select("a", "b", "v").collect())))
    assert got == sorted(map(str, first + [(i, "new", i) for i in range(30)]))


def test_of_equal_new_keys_one_row_stays(spark, tmp_shared):
    rows = spark.createDataFrame([(1, "x", 1), (1, "x", 2), (1, "x", 2), (2, None, 3), (2, None, 3)], _M)
    one, two = (sorted(map(tuple, new_rows(r, f"{tmp_shared}/lake", ["a", "b"], 0).collect())) for r in (rows, rows.repartition(3)))
    assert one == two and [r[0] for r in one] == [1, 2]


# --- replay


def _dead(spark, root):
    raw = venue_rows(spark, SF001).where("latitude IS NULL OR venue_id < 20")
    bad = raw.withColumn("latitude", F.lit(None).cast("double")).withColumn("dlq_reason", F.array(F.lit("latitude")))
    twice = bad.where("venue_id = 3").withColumn("batch_id", F.lit(0))
    write_dlq_batches(bad.withColumn("batch_id", (F.col("venue_id") % 2).cast("int")).unionByName(twice), f"{root}/dlq")
    write_batch(spark.createDataFrame([], read_lake_schema()), f"{root}/lake", 0)
    return bad.count() + 1


def read_lake_schema():
    from ratelake.contract import CONTRACT_SCHEMA

    return CONTRACT_SCHEMA


def test_replaying_twice_equals_replaying_once(spark, tmp_shared):
    n = _dead(spark, tmp_shared)
    args = (spark, f"{tmp_shared}/dlq", f"{tmp_shared}/lake", f"{tmp_shared}/ledger")
    none = lambda rows: rows
    some = lambda rows: rows.withColumn("latitude", F.when(F.col("venue_id") % 3 == 0, F.lit(1.0)))
    every = lambda rows: rows.withColumn("latitude", F.lit(2.0))
    assert replay(*args, none) is None  # nothing is repaired, nothing is entered

    def boom(number):
        raise RuntimeError("injected before the ledger")

    with pytest.raises(RuntimeError):
        replay(*args, some, after_lake_write=boom)
    assert replay(*args, some) == REPLAY_BASE  # the same number again
    third = read_lake(spark, args[2]).count()
    assert 0 < third < n and read_ledger(spark, args[3]).agg(F.sum("copies")).first()[0] == third
    assert replay(*args, some) is None and read_lake(spark, args[2]).count() == third
    assert replay(*args, every) == REPLAY_BASE + 1
    lake = read_lake(spark, args[2])
    assert lake.count() == n == read_dlq(spark, args[1]).count()
    # of the row that was dead-lettered twice by batch 0 or 1 every copy is there
    assert {r["latitude"]: r["count"] for r in lake.groupBy("latitude").count().collect()} == {1.0: third, 2.0: n - third}
    assert replay(*args, every) is None
    assert replay(spark, f"{tmp_shared}/no-dlq", *args[2:], every) is None


# --- types


def test_type_of_each_column_and_where_it_widened(spark, tmp_shared):
    files = {
        "a.csv": ["i,w,d,t,s,e,b,q", "1,1,2024-01-01,2024-01-01,x,,true,\"1,5\"", "-2,2,2024-02-29,2024-01-01 10:00:00,1,,False,2"],
        "b.csv": ["i,w,d,t,s,e,b,q", " 7 ,2.5e3,2024-12-31,2024-01-02,y, ,TRUE,3", "99999999999999999999,4,,,,,,"],
        "c.csv": ["i,w,d,t,s,e,b,q", "3,,2023-02-30,2024-01-03T01:02,z,,0,4"],
    }
    for name, lines in files.items():
        spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(f"{tmp_shared}/{name}")
    by_file = discover_csv(spark, tmp_shared, unit="folder")
    own = {(r["unit"], r["column"]): r["type"] for r in by_file.collect()}
    assert own[("a.csv", "i")] == "bigint" and own[("b.csv", "i")] == "double"  # beyond 64 bits
    assert own[("a.csv", "w")] == "bigint" and own[("b.csv", "w")] == "double" and own[("c.csv", "w")] == "void"
    got = {r["column"]: (r["type"], r["n_narrower"], r["n_units"]) for r in drift(by_file).collect()}
    assert got == {
        "i": ("double", 2, 3), "w": ("double", 2, 3), "d": ("string", 2, 3), "t": ("timestamp", 1, 3), "s": ("string", 0, 3),
        "e": ("void", 0, 3), "b": ("string", 3, 3), "q": ("string", 2, 3),
    }
    again = typed(merge_kinds(by_file))
    assert {r["column"]: r["type"] for r in again.collect()} == {c: t for c, (t, *_) in got.items()}
    assert discover_csv(spark, tmp_shared).select("unit").distinct().count() == 3
    with pytest.raises(ValueError):
        discover_csv(spark, tmp_shared, unit="day")


def test_types_of_no_rows(spark):
    empty = spark.createDataFrame([], "a string, b string")
    assert {r["column"]: r["type"] for r in typed(count_kinds(empty, ["a", "b"])).collect()} == {"a": "void", "b": "void"}

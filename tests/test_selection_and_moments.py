"""Exact quantiles by selection, and profiles kept up batch by batch."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratelake.operators import profile
from ratelake.operators.moments import batch_state, merged, update_states, whole_corr, whole_describe
from ratelake.operators.profile import boxplot_stats, corr_matrix, describe_column, exact_quantiles
from ratelake.session import delete_path
from ratelake.sources.lake import batch_path, read_lake, write_batch


def _rows():
    rnd = random.Random(4)
    rows = [("even", rnd.random()) for _ in range(4000)]
    rows += [("ties", float(rnd.choice([1, 2, 2, 2, 5]))) for _ in range(3000)]
    rows += [("heavy", math.exp(rnd.gauss(0, 6)) * rnd.choice([-1, 1])) for _ in range(2500)]
    rows += [("one", 7.5), ("two", 1.0), ("two", 2.0), ("none", None), ("same", 3.0)] + [("same", 3.0)] * 50
    rows += [(None, float(i)) for i in range(101)]
    return rows


_PROBS = (0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0)


@pytest.mark.parametrize("accuracy", [10_000, 50])
def test_quantiles_by_selection(spark, accuracy):
    rows = _rows()
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    groups = {}
    for g, v in rows:
        if v is not None:
            groups.setdefault(g, []).append(v)
    got = {r[0]: list(r)[1:] for r in exact_quantiles(df, "v", _PROBS, ["g"], accuracy=accuracy).collect()}
    assert got.keys() == groups.keys()
    for g, values in groups.items():
        assert got[g] == pytest.approx(np.quantile(values, _PROBS).tolist(), rel=1e-12), g
    whole = list(exact_quantiles(df, "v", _PROBS, accuracy=accuracy).first())
    assert whole == pytest.approx(np.quantile([v for _, v in rows if v is not None], _PROBS).tolist(), rel=1e-12)


def test_a_band_that_misses_is_found_out(spark, monkeypatch):
    """A sketch beyond its error: the counts show it, and the whole range is
    counted instead."""
    rows = _rows()
    df = spark.createDataFrame(rows, "g string, v double")
    monkeypatch.setattr(profile, "_edges", lambda p, accuracy: (0.9, 0.91))
    values = [v for _, v in rows if v is not None]
    assert list(exact_quantiles(df, "v", (0.25, 0.5)).first()) == pytest.approx(np.quantile(values, (0.25, 0.5)).tolist())
    got = {r["g"]: r["q0_5"] for r in exact_quantiles(df, "v", (0.5,), ["g"]).collect()}
    assert got["even"] == pytest.approx(np.median([v for g, v in rows if g == "even"]))
    assert got["same"] == 3.0 and got[None] == 50.0


def test_the_bands_hold_few_values(spark):
    df = spark.range(200_000).select((F.col("id") * 37 % 200_003).cast("double").alias("v"))
    bands = df.agg(profile.band_edges("v", (0.25, 0.5, 0.75)).alias("e")).first()["e"]
    counts = profile._narrowed(df, "v", [], F.array(*map(F.lit, bands)), 3)
    assert counts.count() < 200_000 * 3 * 10 / profile.SKETCH_ACCURACY
    assert counts.agg(F.sum("_w")).first()[0] == 200_000


def test_profiles_of_empty_null_nan_and_integer_columns(spark):
    empty = spark.createDataFrame([], "v double, g string")
    assert describe_column(empty, "v").first()["count"] == 0
    assert exact_quantiles(empty, "v", (0.5,)).collect() == [] == boxplot_stats(empty, "v", "g").collect()
    nulls = spark.createDataFrame([(None, "a"), (None, None)], "v double, g string")
    r = describe_column(nulls, "v").first()
    assert (r["count"], r["null_count"], r["median"]) == (0, 2, None)
    assert describe_column(nulls, "v", ["g"]).count() == 2
    nan = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (float("nan"),), (float("nan"),)], "v double")
    r = exact_quantiles(nan, "v", (0.25, 0.5, 0.75)).first()
    assert (r[0], r[1]) == (2.0, 3.0) and math.isnan(r[2])
    ints = spark.range(11).select(F.col("id").cast("int").alias("v"), F.col("id").cast("decimal(6,2)").alias("d"))
    assert describe_column(ints, "v").first()["p25"] == 2.5 == describe_column(ints, "d").first()["p25"]


# --- moments


def _numbers(n, shift):
    rnd = random.Random(n)
    out = [(rnd.gauss(shift, 2), None if rnd.random() < 0.2 else rnd.randint(0, 9), 4.0) for _ in range(n)]
    return [(x, y, z) if rnd.random() < 0.9 else (None, y, z) for x, y, z in out]


_COLUMNS = ["x", "y", "z"]
_SCHEMA = "x double, y int, z double"


def _batch(spark, n, shift):
    return spark.createDataFrame(_numbers(n, shift), _SCHEMA)


def test_states_merge_to_the_state_of_all_rows(spark):
    parts = [_batch(spark, 50, 1e6), _batch(spark, 200, -3.0), _batch(spark, 0, 0.0), _batch(spark, 1, 5.0)]
    states = [batch_state(p, _COLUMNS) for p in parts]
    union = parts[0].union(parts[1]).union(parts[2]).union(parts[3])
    key = lambda r: (r["a"], r["b"], r["listwise"])
    want = {key(r): r.asDict() for r in batch_state(union, _COLUMNS).collect()}
    got = {key(r): r.asDict() for r in merged(states[0].union(states[1]).union(states[2]).union(states[3])).collect()}
    assert got.keys() == want.keys()
    for k, w in want.items():
        for c, v in w.items():
            assert got[k][c] == (pytest.approx(v, rel=1e-9) if isinstance(v, float) else v), (k, c)


def test_only_new_and_replaced_batches_are_read(spark, tmp_shared):
    lake, root = f"{tmp_shared}/lake", f"{tmp_shared}/states"
    schema = _batch(spark, 1, 0).schema
    reads = []

    def read(n):
        reads.append(n)
        return read_lake(spark, lake, schema, by=None, batch_id=n)

    def check():
        df = read_lake(spark, lake, schema, by=None).drop("batch_id")
        got = {r["column"]: r for r in whole_describe(spark, root).collect()}
        for c in _COLUMNS:
            w = describe_column(df, c).first()
            for field in ("count", "null_count", "mean", "std", "min", "max"):
                assert got[c][field] == (pytest.approx(float(w[field])) if w[field] is not None else None), (c, field)
        want = {(r[0], r[1]): r[2] for r in corr_matrix(df, _COLUMNS).collect()}
        corr = {(r[0], r[1]): r[2] for r in whole_corr(spark, root).collect()}
        assert corr.keys() == want.keys()
        for k, w in want.items():
            assert corr[k] == (pytest.approx(w) if w is not None else None), k

    for n, (rows, shift) in enumerate([(80, 1.0), (40, 9.0), (30, -2.0)]):
        write_batch(_batch(spark, rows, shift), lake, n, by=None)
        assert update_states(spark, lake, root, _COLUMNS, read) == [n]
        check()
    assert reads == [0, 1, 2] and update_states(spark, lake, root, _COLUMNS, read) == []
    write_batch(_batch(spark, 17, 3.0), lake, 1, by=None)  # replaced
    delete_path(spark, batch_path(lake, 0))  # gone
    assert update_states(spark, lake, root, _COLUMNS, read) == [1] and reads == [0, 1, 2, 1]
    check()
    assert update_states(spark, lake, root, _COLUMNS[:2], read) == [1, 2]  # other columns

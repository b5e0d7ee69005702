"""Literal edge rows the test tables cannot show (FIXTURES section 6)."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from ratelake.contract import CONTRACT_SCHEMA, CRITICAL_COLUMNS
from ratelake.functions.encode import binary_flag, impute_zero, ordinal_encode, strip_ws
from ratelake.functions.wire import encode_json, parse_json
from ratelake.operators.context import group_context
from ratelake.operators.model import fit_linear, regression_metrics
from ratelake.operators.profile import corr_matrix, histogram
from ratelake.operators.quality import split
from ratelake.sources.lake import read_lake, write_batch
from ratelake.streaming.consumer import niche_filter


def test_impute_fills_null_not_nan(spark):
    df = spark.createDataFrame([(1, None), (2, float("nan"))], "id int, x double")
    got = {r.id: r.x for r in impute_zero(df, ["x"]).collect()}
    assert got[1] == 0.0
    assert math.isnan(got[2])


def test_impute_keeps_int_type(spark):
    df = spark.createDataFrame([(None,), (5,)], "n int")
    out = impute_zero(df, ["n"])
    assert dict(out.dtypes)["n"] == "int"
    assert sorted(r.n for r in out.collect()) == [0, 5]


def test_strip_handles_tabs_and_newlines(spark):
    df = spark.createDataFrame([("\t $ \n",), ("$$ - $$$",), (" $$$$ ",), ("$$$",), (None,)], "p string")
    out = df.select(ordinal_encode("p").alias("code"), strip_ws("p").alias("s")).collect()
    assert [r.code for r in out] == [1, 2, 3, 0, 0]
    assert out[0].s == "$"


def test_unstripped_variant_misses_padded_text(spark):
    df = spark.createDataFrame([(" $ ",), ("$",)], "p string")
    assert [r.c for r in df.select(ordinal_encode("p", strip=False).alias("c")).collect()] == [0, 1]


def test_flags_are_exact_and_case_sensitive(spark):
    df = spark.createDataFrame([("claimed",), (" Claimed",), (None,), ("Claimed",)], "c string")
    assert [r.f for r in df.select(binary_flag("c", "Claimed").alias("f")).collect()] == [0, 0, 0, 1]


def test_dlq_only_null_is_bad(spark):
    rows = [("", "ES", 1.0, 2.0), ("b", "ES", float("nan"), 2.0), ("c", None, 1.0, 2.0)]
    df = spark.createDataFrame(rows, "restaurant_name string, country string, latitude double, longitude double")
    good, bad = split(df, CRITICAL_COLUMNS, with_reason=True)
    assert sorted(r.restaurant_name for r in good.collect()) == ["", "b"]
    b = bad.collect()
    assert [r.restaurant_name for r in b] == ["c"]
    assert b[0].dlq_reason == ["country"]


@pytest.mark.parametrize("strategy", ["aggregate", "window"])
def test_null_city_is_one_group(spark, strategy):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("x", 5.0)], "city string, avg_rating double")
    out = group_context(df, strategy=strategy).collect()
    means = sorted((r.city or "", r.city_avg_rating, r.rating_diff_city) for r in out)
    assert means == [("", 2.0, -1.0), ("", 2.0, 1.0), ("x", 5.0, 0.0)]


def test_json_float_for_int_field_nulls_only_that_field(spark):
    df = spark.createDataFrame([('{"country": "ES", "total_reviews_count": 26.0, "avg_rating": 4.5}',)], "value string")
    r = parse_json(df).collect()[0]
    assert r.total_reviews_count is None
    assert r.country == "ES" and r.avg_rating == 4.5


def test_malformed_json_row_of_nulls(spark):
    df = spark.createDataFrame([("{bad",), ('{"country": "ES", "is_gluten_free": 1, "avg_rating": 4.6}',)], "value string")
    parsed = parse_json(df)
    rows = parsed.collect()
    assert all(v is None for v in rows[0].asDict().values())
    assert parsed.filter(niche_filter()).count() == 1
    counts = {r.country: r["count"] for r in parsed.groupBy("country").count().collect()}
    assert counts == {None: 1, "ES": 1}


def test_null_fields_are_explicit_on_the_wire(spark):
    df = spark.createDataFrame([(None, 1.0)], "country string, avg_rating double")
    full = df.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in CONTRACT_SCHEMA.fields if f.name not in ("country", "avg_rating")], "country", "avg_rating")
    v = encode_json(full).collect()[0].value
    assert '"country":null' in v
    back = parse_json(encode_json(full)).collect()[0]
    assert back.country is None and back.avg_rating == 1.0


def test_int_cast_before_json(spark):
    # a float-typed count is cast to the contract int before encoding
    df = spark.createDataFrame([(26.0,)], "total_reviews_count double")
    v = encode_json(df.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in CONTRACT_SCHEMA.fields if f.name != "total_reviews_count"], "total_reviews_count"))
    assert parse_json(v).collect()[0].total_reviews_count == 26


def _contract_rows(spark, rows):
    base = {f.name: None for f in CONTRACT_SCHEMA.fields}
    data = [tuple({**base, **r}[f.name] for f in CONTRACT_SCHEMA.fields) for r in rows]
    return spark.createDataFrame(data, CONTRACT_SCHEMA)


def test_empty_country_survives_the_lake(spark, tmp_shared):
    df = _contract_rows(spark, [{"restaurant_name": "a", "country": ""}, {"restaurant_name": "b", "country": "ES"}])
    write_batch(df, tmp_shared, 0)
    got = {r.restaurant_name: r.country for r in read_lake(spark, tmp_shared).collect()}
    assert got == {"a": "", "b": "ES"}


def test_retry_with_fewer_countries_leaves_no_orphan(spark, tmp_shared):
    first = _contract_rows(spark, [{"restaurant_name": "a", "country": "ES"}, {"restaurant_name": "b", "country": "IT"}])
    write_batch(first, tmp_shared, 1)
    write_batch(_contract_rows(spark, [{"restaurant_name": "z", "country": "FR"}]), tmp_shared, 2)
    retry = _contract_rows(spark, [{"restaurant_name": "a", "country": "ES"}])
    write_batch(retry, tmp_shared, 1)
    got = sorted((r.batch_id, r.country, r.restaurant_name) for r in read_lake(spark, tmp_shared).collect())
    assert got == [(1, "ES", "a"), (2, "FR", "z")]


def test_corr_constant_column_is_null(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "a double, b double")
    got = {(r.col_a, r.col_b): r.corr for r in corr_matrix(df, ["a", "b"]).collect()}
    assert got[("a", "b")] is None and got[("b", "b")] is None
    assert abs(got[("a", "a")] - 1.0) < 1e-12


def test_histogram_all_equal_goes_to_bin_1(spark):
    df = spark.createDataFrame([(2.5,), (2.5,), (2.5,)], "v double")
    got = {r.bin: r["count"] for r in histogram(df, "v").collect()}
    assert got[1] == 3 and sum(got.values()) == 3 and len(got) == 10


def test_histogram_max_in_last_bin(spark):
    df = spark.createDataFrame([(0.0,), (10.0,), (5.0,)], "v double")
    got = {r.bin: r["count"] for r in histogram(df, "v").collect()}
    assert got[1] == 1 and got[6] == 1 and got[10] == 1


def test_assembler_rejects_null_feature(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 3.0), (2.0, 4.0)], "x double, label double")
    with pytest.raises(Exception):
        fit_linear(df, ["x"])


def test_r2_constant_label_is_null(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0)], "label double, prediction double")
    r = regression_metrics(df).collect()[0]
    assert r.r2 is None
    assert abs(r.rmse - math.sqrt(0.5)) < 1e-12


def test_leave_one_out_mean(spark):
    from ratelake.operators.context import leave_one_out_context

    df = spark.createDataFrame(
        [("a", 1.0), ("a", 3.0), ("a", None), ("b", 5.0)], "g string, x double"
    )
    got = {(r.g, r.x): r.m for r in leave_one_out_context(df, "x", ["g"], "m", "d").collect()}
    assert got[("a", 1.0)] == 3.0 and got[("a", 3.0)] == 1.0
    assert got[("a", None)] == 2.0  # a null row is compared with the whole group
    assert got[("b", 5.0)] is None  # no other row


def test_contract_projection_does_not_fail_on_out_of_range(spark):
    from ratelake.contract import to_contract

    df = spark.createDataFrame([(1e10,), (26.0,)], "total_reviews_count double")
    full = df.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in CONTRACT_SCHEMA.fields if f.name != "total_reviews_count"], "total_reviews_count")
    got = [r.total_reviews_count for r in to_contract(full).collect()]
    assert got == [None, 26]

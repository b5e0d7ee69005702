"""Brute-force cross-checks for the ML keys that have no SQL oracle."""

from __future__ import annotations

import numpy as np
from pyspark.ml.evaluation import RegressionEvaluator

from conftest import SF01
from ratelake.contract import FEATURE_COLUMNS
from ratelake.operators.model import (
    fit_forest,
    fit_linear,
    forest_importances,
    linear_coefficients,
    prepared_split,
    regression_metrics,
    score,
    train_and_compare,
)
from ratelake.plans.venue import venue_pipeline, venue_rows


def _split(spark):
    return prepared_split(venue_pipeline(venue_rows(spark, SF01)))


def test_metrics_equal_mllib_evaluator(spark):
    train, test = _split(spark)
    pred = score(fit_forest(train, num_trees=10), test)
    ours = regression_metrics(pred).first()
    for metric in ("rmse", "mse", "mae", "r2"):
        ev = RegressionEvaluator(labelCol="label", predictionCol="prediction", metricName=metric)
        assert abs(ev.evaluate(pred) - ours[metric]) < 1e-9, metric


def test_linear_coefficients_equal_least_squares(spark):
    train, _ = _split(spark)
    got = {r.feature: r.coefficient for r in linear_coefficients(spark, fit_linear(train), FEATURE_COLUMNS).collect()}
    pdf = train.select(*FEATURE_COLUMNS, "label").toPandas()
    x = np.column_stack([pdf[FEATURE_COLUMNS].to_numpy(dtype=float), np.ones(len(pdf))])
    beta, *_ = np.linalg.lstsq(x, pdf["label"].to_numpy(dtype=float), rcond=None)
    for i, f in enumerate(FEATURE_COLUMNS):
        assert abs(got[f] - beta[i]) < 1e-6 * max(1.0, abs(beta[i])), f
    assert abs(got["(intercept)"] - beta[-1]) < 1e-6 * max(1.0, abs(beta[-1]))


def test_importances_sum_to_one_and_compare_picks_lowest_rmse(spark):
    res = train_and_compare(spark, venue_pipeline(venue_rows(spark, SF01)))
    imp = forest_importances(spark, res["models"]["random_forest"], FEATURE_COLUMNS).collect()
    assert abs(sum(r.importance for r in imp) - 1.0) < 1e-9
    rows = {r.model: r for r in res["comparison"].collect()}
    best = min(rows.values(), key=lambda r: r.rmse)
    assert best.is_best and sum(r.is_best for r in rows.values()) == 1
    assert rows["linear_regression"].rmse == res["metrics"]["linear_regression"]["rmse"]

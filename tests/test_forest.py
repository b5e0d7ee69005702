"""The forest as a table: nodes, routing and importances against the rows."""

from __future__ import annotations

import numpy as np
import pytest

from ratelake.operators.forest import (
    checked_nodes,
    forest_nodes,
    importances,
    node_statistics,
    nodes_agree,
    route,
    routed_prediction,
    with_gains,
)
from ratelake.operators.model import fit_forest, forest_importances, score

FEATURES = ["a", "odd name", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    rnd = np.random.default_rng(4)
    x = rnd.integers(0, 20, (400, 3)).astype(float)
    y = 3 * (x[:, 0] > 7) + x[:, 1] * (x[:, 2] > 4) + rnd.normal(size=400)
    data = [(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y, strict=True))]
    return spark.createDataFrame(data, ["id", *FEATURES, "label"]).repartition(3)


def test_nodes_equal_brute_force(spark, rows):
    model = fit_forest(rows, FEATURES, num_trees=4, max_depth=4, bootstrap=False)
    nodes = {(r["tree"], r["node"]): r for r in checked_nodes(spark, model, rows, FEATURES).collect()}
    pdf = rows.toPandas()
    for (tree, node), r in nodes.items():
        held = np.ones(len(pdf), bool)
        for k in range(node.bit_length() - 1, 0, -1):  # from the root down
            up = nodes[tree, node >> k]
            left = pdf[up["feature"]].to_numpy() <= up["threshold"]
            held &= ~left if (node >> (k - 1)) & 1 else left
        y = pdf["label"].to_numpy()[held]
        assert (r["n"], r["model_n"]) == (len(y), len(y))
        assert abs(r["mean"] - y.mean()) < 1e-9 and abs(r["impurity"] - y.var()) < 1e-9
        if r["feature"] is not None:
            a, b = nodes[tree, 2 * node], nodes[tree, 2 * node + 1]
            gain = y.var() - (a["n"] * a["impurity"] + b["n"] * b["impurity"]) / len(y)
            assert abs(r["gain"] - gain) < 1e-9
    assert {t for t, _ in nodes} == set(range(4)) and len(nodes) == model.stages[-1].totalNumNodes
    got = {r["feature"]: r["importance"] for r in importances(checked_nodes(spark, model, rows, FEATURES)).collect()}
    for r in forest_importances(spark, model, FEATURES).collect():
        assert abs(r["importance"] - got.get(r["feature"], 0.0)) < 1e-9


def test_a_wrong_node_is_seen(spark, rows):
    model = fit_forest(rows, FEATURES, num_trees=2, max_depth=3, bootstrap=False)
    assert checked_nodes(spark, model, rows, FEATURES).where(~nodes_agree()).count() == 0
    # one row more, or the bags of another forest, and the figures differ
    assert checked_nodes(spark, model, rows.union(rows.limit(1)), FEATURES).where(~nodes_agree()).count() > 0
    bagged = fit_forest(rows, FEATURES, num_trees=2, max_depth=3)
    assert checked_nodes(spark, bagged, rows, FEATURES).where(~nodes_agree()).count() > 0


def test_routed_prediction_equals_the_model(spark, rows):
    model = fit_forest(rows, FEATURES, num_trees=7, max_depth=5)
    nodes = forest_nodes(spark, model, FEATURES)
    out = score(model, rows.withColumn("routed", routed_prediction(nodes)), keep=["id", "routed"]).collect()
    assert len(out) == 400 and all(abs(r["routed"] - r["prediction"]) < 1e-9 for r in out)


def test_trees_without_split_and_no_rows(spark, rows):
    flat = rows.drop("label").selectExpr("*", "1.5D AS label")
    model = fit_forest(flat, FEATURES, num_trees=2, max_depth=3, bootstrap=False)
    nodes = checked_nodes(spark, model, flat, FEATURES)
    assert [(r["node"], r["n"], r["mean"], r["impurity"], r["gain"]) for r in nodes.collect()] == [(1, 400, 1.5, 0.0, None)] * 2
    assert nodes.where(~nodes_agree()).count() == 0 and importances(nodes).count() == 0
    assert with_gains(node_statistics(route(flat.limit(0), forest_nodes(spark, model, FEATURES)))).count() == 0

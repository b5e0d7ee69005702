"""Registered ML queries: split, training rows, metrics, models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelake.contract import FEATURE_COLUMNS, FOREST_TREES, SPLIT_SEED, TRAIN_FRACTION
from ratelake.operators.context import train_only_context
from ratelake.operators.forest import checked_nodes, forest_nodes, importances, nodes_agree, routed_prediction
from ratelake.operators.model import (
    VENUE_KEY,
    fit_forest,
    fit_linear,
    forest_importances,
    linear_coefficients,
    prepared_split,
    regression_metrics,
    score,
    train_and_compare,
    training_rows,
    with_split,
)
from ratelake.plans.registry import PIPELINE_CTE, register, rnd, sql_rnd
from ratelake.session import materialize
from ratelake.plans.venue import venue_pipeline, venue_rows
from ratelake.sources.tables import table


def _sql_split(key_sql: str, seed: int = SPLIT_SEED, cut: int = round(TRAIN_FRACTION * 100)) -> str:
    return (
        f"CASE WHEN ('0x' || substr(md5('{seed}:' || {key_sql}), 1, 8))::BIGINT % 100 < {cut} "
        "THEN 'train' ELSE 'test' END"
    )


@register(
    "ml_split",
    f"SELECT o_orderkey, o_custkey, {_sql_split('CAST(o_orderkey AS VARCHAR)')} AS split FROM orders",
)
def q_ml_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return with_split(o, ["o_orderkey"])


_VENUE_KEY_SQL = (
    "concat_ws(':', restaurant_name, country, city, CAST(latitude AS VARCHAR), CAST(longitude AS VARCHAR))"
)


def _lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    return venue_pipeline(venue_rows(spark, sf_dir))


@register(
    "ml_training_rows",
    f"""WITH {PIPELINE_CTE}
    SELECT restaurant_name, country, city, latitude, longitude, total_reviews_count,
      price_level_num, is_claimed, is_veg_friendly, is_gluten_free,
      {sql_rnd("city_avg_rating")} AS city_avg_rating, avg_rating AS label,
      {_sql_split(_VENUE_KEY_SQL)} AS split
    FROM pipeline WHERE avg_rating > 0""",
)
def q_ml_training_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_split(training_rows(_lake(spark, sf_dir)), VENUE_KEY)
    return rows.withColumn("city_avg_rating", rnd("city_avg_rating"))


@register(
    "regression_metrics",
    f"""WITH p AS (SELECT l_extendedprice AS y, l_quantity * 1500.0 AS yhat FROM lineitem)
    SELECT CAST(COUNT(*) AS BIGINT) AS n,
      {sql_rnd("SQRT(SUM((y - yhat) * (y - yhat)) / COUNT(*))", 4)} AS rmse,
      {sql_rnd("SUM((y - yhat) * (y - yhat)) / COUNT(*)", 0)} AS mse,
      {sql_rnd("SUM(ABS(y - yhat)) / COUNT(*)", 4)} AS mae,
      {sql_rnd("1 - SUM((y - yhat) * (y - yhat)) / (VAR_POP(y) * COUNT(*))")} AS r2
    FROM p""",
)
def q_regression_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    pred = li.select(
        F.col("l_extendedprice").alias("label"), (F.col("l_quantity") * 1500.0).alias("prediction")
    )
    m = regression_metrics(pred)
    # decimals kept per magnitude: summation noise stays far below the last digit
    return m.withColumns({"rmse": rnd("rmse", 4), "mse": rnd("mse", 0), "mae": rnd("mae", 4), "r2": rnd("r2")})


@register(
    "ml_linear_one_feature",
    f"""SELECT 'l_quantity' AS feature, {sql_rnd("regr_slope(l_extendedprice, l_quantity)", 4)} AS coefficient
    FROM lineitem
    UNION ALL
    SELECT '(intercept)' AS feature,
      {sql_rnd("regr_intercept(l_extendedprice, l_quantity)", 4)} AS coefficient FROM lineitem""",
)
def q_ml_linear_one_feature(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_quantity", F.col("l_extendedprice").alias("label")
    )
    model = fit_linear(li, ["l_quantity"])
    coef = linear_coefficients(spark, model, ["l_quantity"])
    return coef.withColumn("coefficient", rnd("coefficient", 4))


def _venue_train_test(spark: SparkSession, sf_dir: str):
    return prepared_split(_lake(spark, sf_dir))


def _least_squares_cte(features: list[str]) -> str:
    """``rated`` (features x0.., label y, split), ``mean`` and ``fit``: the
    least-squares coefficients b0.. and the intercept a of the training rows.
    The centred columns are made orthogonal one after another, then the
    triangular system is solved from the last feature back."""
    n = len(features)
    x = [f"CAST({c} AS DOUBLE) AS x{i}" for i, c in enumerate(features)]
    parts = [
        f"rated AS MATERIALIZED (SELECT {', '.join(VENUE_KEY)}, {', '.join(x)}, avg_rating AS y, "
        f"{_sql_split(_VENUE_KEY_SQL)} AS split FROM pipeline WHERE avg_rating > 0)",
        f"mean AS MATERIALIZED (SELECT {', '.join(f'AVG(x{i}) AS m{i}' for i in range(n))}, AVG(y) AS my "
        "FROM rated WHERE split = 'train')",
        f"g0 AS MATERIALIZED (SELECT {', '.join(f'x{i} - m{i} AS x{i}' for i in range(n))}, y - my AS y "
        "FROM rated, mean WHERE split = 'train')",
    ]
    for k in range(n):
        later = range(k + 1, n)
        r = [f"SUM(x{k} * x{j}) / SUM(x{k} * x{k}) AS r{k}_{j}" for j in later]
        parts.append(f"p{k} AS MATERIALIZED (SELECT {', '.join([*r, f'SUM(x{k} * y) / SUM(x{k} * x{k}) AS c{k}'])} FROM g{k})")
        rest = [f"x{j} - r{k}_{j} * x{k} AS x{j}" for j in later]
        parts.append(f"g{k + 1} AS MATERIALIZED (SELECT {', '.join([*rest, f'y - c{k} * x{k} AS y'])} FROM g{k}, p{k})")
    parts.append(f"s{n - 1} AS (SELECT c{n - 1} AS b{n - 1} FROM p{n - 1})")
    for k in range(n - 2, -1, -1):
        known = "".join(f" - r{k}_{j} * b{j}" for j in range(k + 1, n))
        parts.append(f"s{k} AS (SELECT s{k + 1}.*, c{k}{known} AS b{k} FROM p{k}, s{k + 1})")
    a = "".join(f" - b{i} * m{i}" for i in range(n))
    parts.append(f"fit AS MATERIALIZED (SELECT s0.*, my{a} AS a FROM s0, mean)")
    return ",\n    ".join(parts)


_FIT_CTE = f"WITH {PIPELINE_CTE},\n    {_least_squares_cte(FEATURE_COLUMNS)}"


@register(
    "ml_linear_coefficients",
    f"{_FIT_CTE}\n    "
    + "\n    UNION ALL ".join(
        f"SELECT '{name}' AS feature, {sql_rnd(c)} AS coefficient FROM fit"
        for name, c in [*((f, f"b{i}") for i, f in enumerate(FEATURE_COLUMNS)), ("(intercept)", "a")]
    ),
)
def q_ml_linear_coefficients(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _ = _venue_train_test(spark, sf_dir)
    coef = linear_coefficients(spark, fit_linear(train), FEATURE_COLUMNS)
    return coef.withColumn("coefficient", rnd("coefficient"))


@register(
    "ml_score_linear",
    f"""{_FIT_CTE}
    SELECT {", ".join(VENUE_KEY)}, y AS label,
      {sql_rnd("a" + "".join(f" + b{i} * x{i}" for i in range(len(FEATURE_COLUMNS))))} AS prediction
    FROM rated, fit WHERE split = 'test'""",
)
def q_ml_score_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions of the six-feature linear model for the held-out rows."""
    train, test = _venue_train_test(spark, sf_dir)
    return score(fit_linear(train), test, keep=VENUE_KEY).withColumn("prediction", rnd("prediction"))


def _n_rated(split: str) -> str:
    return f"SELECT CAST(COUNT(*) AS BIGINT) AS n FROM pipeline WHERE avg_rating > 0 AND {_sql_split(_VENUE_KEY_SQL)} = '{split}'"


@register(
    "ml_forest_checks",
    f"""WITH {PIPELINE_CTE}, t AS ({_n_rated("train")})
    SELECT n AS n_train, CAST({len(FEATURE_COLUMNS)} AS BIGINT) AS n_features,
      CAST(1.0 AS DOUBLE) AS total, CAST(100.0 AS DOUBLE) AS total_pct, TRUE AS none_negative FROM t""",
)
def q_ml_forest_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What holds of the importances whatever the trees are."""
    train, _ = _venue_train_test(spark, sf_dir)
    imp = forest_importances(spark, fit_forest(train), FEATURE_COLUMNS)
    return imp.agg(
        F.lit(train.count()).alias("n_train"),
        F.countDistinct("feature").alias("n_features"),
        rnd(F.sum("importance")).alias("total"),
        rnd(F.sum("importance_pct"), 4).alias("total_pct"),
        F.min(F.col("importance") >= 0).alias("none_negative"),
    )


# splits of the small features: midpoints between neighbouring values
_SPLITS = {"price_level_num": (0.5, 1.5, 2.5), "is_claimed": (0.5,), "is_veg_friendly": (0.5,), "is_gluten_free": (0.5,)}
_TREE_DEPTH = 3


def _grown_tree_sql(depth: int) -> str:
    """A regression tree grown level by level: of all splits of a node the one
    that lowers the variance most."""
    value = "CASE f " + " ".join(f"WHEN '{f}' THEN {f}" for f in _SPLITS) + " END"
    ranked = list(_SPLITS)
    splits = ", ".join(f"({ranked.index(f)}, '{f}', CAST({t!r} AS DOUBLE))" for f, cuts in _SPLITS.items() for t in cuts)
    parts = [
        f"split(i, f, t) AS (VALUES {splits})",
        f"l0 AS MATERIALIZED (SELECT CAST(1 AS BIGINT) AS node, {', '.join(_SPLITS)}, avg_rating AS y FROM pipeline "
        f"WHERE avg_rating > 0 AND {_sql_split(_VENUE_KEY_SQL)} = 'train')",
    ]
    for d in range(depth + 1):
        parts.append(f"n{d} AS MATERIALIZED (SELECT node, COUNT(*) AS n, AVG(y) AS mean, VAR_POP(y) AS impurity FROM l{d} GROUP BY node)")
        if d == depth:
            break
        parts.append(
            f"c{d} AS (SELECT node, i, f, t, COUNT(*) FILTER (WHERE {value} <= t) AS a, COUNT(*) FILTER (WHERE {value} > t) AS b, "
            f"VAR_POP(y) FILTER (WHERE {value} <= t) AS va, VAR_POP(y) FILTER (WHERE {value} > t) AS vb FROM l{d}, split GROUP BY node, i, f, t)"
        )
        parts.append(
            f"b{d} AS MATERIALIZED (SELECT node, f, t, impurity - (a * va + b * vb) / (a + b) AS gain FROM c{d} JOIN n{d} USING (node) "
            "WHERE a > 0 AND b > 0 AND impurity - (a * va + b * vb) / (a + b) > 1e-12 "
            "QUALIFY ROW_NUMBER() OVER (PARTITION BY node ORDER BY ROUND(impurity - (a * va + b * vb) / (a + b), 12) DESC, i, t) = 1)"
        )
        parts.append(
            f"l{d + 1} AS MATERIALIZED (SELECT 2 * node + CASE WHEN {value} <= t THEN 0 ELSE 1 END AS node, {', '.join(_SPLITS)}, y "
            f"FROM l{d} JOIN b{d} USING (node))"
        )
    shown = [f"SELECT node, f, t, n, mean, impurity, gain FROM n{d} LEFT JOIN b{d} USING (node)" for d in range(depth)]
    shown.append(f"SELECT node, NULL, NULL, n, mean, impurity, NULL FROM n{depth}")
    parts.append("grown(node, f, t, n, mean, impurity, gain) AS (" + " UNION ALL ".join(shown) + ")")
    return ",\n    ".join(parts)


@register(
    "ml_tree_nodes",
    f"""WITH {PIPELINE_CTE},
    {_grown_tree_sql(_TREE_DEPTH)}
    SELECT node, f AS feature, t AS threshold, CAST(n AS BIGINT) AS n, {sql_rnd("mean")} AS mean,
      {sql_rnd("impurity")} AS impurity, {sql_rnd("gain")} AS gain, TRUE AS agrees FROM grown""",
)
def q_ml_tree_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tree over the small features: splits by the model, figures from the rows."""
    train, _ = _venue_train_test(spark, sf_dir)
    model = fit_forest(train, list(_SPLITS), num_trees=1, max_depth=_TREE_DEPTH, bootstrap=False, featureSubsetStrategy="all")
    return checked_nodes(spark, model, train, list(_SPLITS)).select(
        "node", "feature", "threshold", F.col("n").cast("long").alias("n"),
        rnd("mean").alias("mean"), rnd("impurity").alias("impurity"), rnd("gain").alias("gain"), nodes_agree().alias("agrees"),
    )


@register(
    "ml_forest_nodes",
    f"""WITH {PIPELINE_CTE}, t AS ({_n_rated("train")})
    SELECT CAST(tree AS INT) AS tree, n AS n_rows, TRUE AS nodes_agree, TRUE AS importances_agree FROM t, range({FOREST_TREES}) AS r(tree)""",
)
def q_ml_forest_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All trees of the forest without bootstrap: counts, means, impurities and
    gains of every node counted anew from the training rows, and the
    importances that follow from them."""
    train, _ = _venue_train_test(spark, sf_dir)
    model = fit_forest(train, bootstrap=False)
    nodes = materialize(checked_nodes(spark, model, train, FEATURE_COLUMNS), "ml_forest_nodes")
    told = forest_importances(spark, model, FEATURE_COLUMNS).select("feature", F.col("importance").alias("_told"))
    both = told.join(importances(nodes), "feature", "left")
    agree = both.agg(F.max(F.abs(F.col("_told") - F.coalesce("importance", F.lit(0.0)))) < 1e-9).first()[0]
    return nodes.groupBy("tree").agg(
        F.max(F.when(F.col("node") == 1, F.col("n"))).cast("long").alias("n_rows"), F.min(nodes_agree()).alias("nodes_agree")
    ).withColumn("importances_agree", F.lit(agree))


@register(
    "ml_forest_routed",
    f"""WITH {PIPELINE_CTE}, t AS ({_n_rated("test")})
    SELECT n AS n_test, CAST(0 AS BIGINT) AS n_differ, TRUE AS importances_agree FROM t""",
)
def q_ml_forest_routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's forest: held-out rows routed through its nodes against
    the model's predictions, and importances from the nodes."""
    train, test = _venue_train_test(spark, sf_dir)
    model = fit_forest(train)
    nodes = forest_nodes(spark, model, FEATURE_COLUMNS)
    told = forest_importances(spark, model, FEATURE_COLUMNS).select("feature", F.col("importance").alias("_told"))
    both = told.join(importances(nodes), "feature", "left")
    agree = both.agg(F.max(F.abs(F.col("_told") - F.coalesce("importance", F.lit(0.0)))) < 1e-9).first()[0]
    routed = score(model, test.withColumn("_routed", routed_prediction(nodes)), keep=["_routed"])
    differ = ~F.coalesce(F.abs(F.col("_routed") - F.col("prediction")) < 1e-9, F.lit(False))
    return routed.agg(F.count(F.lit(1)).alias("n_test"), F.count_if(differ).alias("n_differ")).withColumn("importances_agree", F.lit(agree))


@register(
    "ml_compare_checks",
    f"""WITH {PIPELINE_CTE}, t AS ({_n_rated("test")})
    SELECT model, n AS n_test, TRUE AS rmse_agrees, TRUE AS r2_agrees, TRUE AS best_is_lowest
    FROM t, (VALUES ('linear_regression'), ('random_forest')) AS m(model)""",
)
def q_ml_compare_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The comparison against metrics computed anew from stored predictions."""
    res = train_and_compare(spark, _lake(spark, sf_dir))
    each = [score(m, res["test"]).withColumn("model", F.lit(name)) for name, m in res["models"].items()]
    stored = materialize(each[0].unionByName(each[1]), "ml_compare_checks")
    square = (F.col("label") - F.col("prediction")) ** 2
    again = stored.groupBy("model").agg(
        F.count(F.lit(1)).alias("n_test"),
        F.sqrt(F.avg(square)).alias("_rmse"),
        (1 - F.avg(square) / F.var_pop("label")).alias("_r2"),
    )
    told = res["comparison"].collect()  # one row per model
    best = [r["rmse"] for r in told if r["is_best"]]
    return again.join(F.broadcast(res["comparison"]), "model").select(
        "model", "n_test",
        (F.abs(F.col("rmse") - F.col("_rmse")) < 1e-9).alias("rmse_agrees"),
        (F.abs(F.col("r2") - F.col("_r2")) < 1e-9).alias("r2_agrees"),
        F.lit(best == [min(r["rmse"] for r in told)]).alias("best_is_lowest"),
    )


@register("ml_forest_importances")
def q_ml_forest_importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _ = _venue_train_test(spark, sf_dir)
    return forest_importances(spark, fit_forest(train), FEATURE_COLUMNS)


@register("ml_score")
def q_ml_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = _venue_train_test(spark, sf_dir)
    lr = score(fit_linear(train), test, keep=VENUE_KEY).withColumn("model", F.lit("linear_regression"))
    rf = score(fit_forest(train), test, keep=VENUE_KEY).withColumn("model", F.lit("random_forest"))
    return lr.unionByName(rf)


@register("ml_compare")
def q_ml_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return train_and_compare(spark, _lake(spark, sf_dir))["comparison"]


@register(
    "ml_train_only_context",
    f"""WITH {PIPELINE_CTE},
    r AS (SELECT restaurant_name, country, city, latitude, longitude, avg_rating AS label,
                 {_sql_split(_VENUE_KEY_SQL)} AS split
          FROM pipeline WHERE avg_rating > 0),
    m AS (SELECT city, AVG(label) AS city_train_mean FROM r WHERE split = 'train' GROUP BY city)
    SELECT r.restaurant_name, r.country, r.city, r.split, r.label,
      {sql_rnd("m.city_train_mean")} AS city_train_mean,
      {sql_rnd("r.label - m.city_train_mean")} AS label_diff_train
    FROM r LEFT JOIN m ON r.city IS NOT DISTINCT FROM m.city""",
)
def q_ml_train_only_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leak-free city feature: the mean label of the city's *training* rows,
    joined to training and test rows alike."""
    rows = with_split(training_rows(_lake(spark, sf_dir)), VENUE_KEY)
    train = rows.filter(F.col("split") == "train")
    out = train_only_context(rows, train, "label", ["city"], "city_train_mean", "label_diff_train")
    return out.select(
        "restaurant_name", "country", "city", "split", "label",
        rnd("city_train_mean").alias("city_train_mean"), rnd("label_diff_train").alias("label_diff_train"),
    )

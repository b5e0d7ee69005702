"""A fitted forest as a table, checked against the rows it came from.

* ``forest_nodes`` reads the trees back as one row per node. Nodes are
  numbered by place: 1 is the root, ``2 n`` and ``2 n + 1`` are the children
  of ``n``.
* ``route`` sends rows through the trees by an expression made from the nodes:
  the trees are one literal, and each step of a row looks up the next node.
  Plain Catalyst of a size that does not grow with the trees, no model object
  in the tasks.
* ``node_statistics`` counts the routed rows of every node. Rows are summed by
  leaf first (at most one row per leaf and task before the shuffle); a node's
  sums are those of its leaves.
* ``importances`` follows from counts and gains alone.

A node table has at most ``trees * 2 ^ (depth + 1)`` rows, whatever the data;
it passes the driver like the model itself.
A bagged forest's own counts are of its bags; statistics of routed rows equal
them only for a forest without bootstrap.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratelake.session import delete_path, shared_path

NODES = (
    "tree int, node long, feature string, threshold double, n double, mean double, impurity double, gain double"
)


def forest_nodes(spark: SparkSession, model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """``tree, node, feature, threshold, n, mean, impurity, gain`` as the model
    has them; feature, threshold and gain are null at leaves, and the impurity
    of leaves for which the model keeps none (it stores -1)."""
    path = shared_path(spark, "forest")
    model.stages[-1].write().save(path)
    stored = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    known = {(r.treeID, r.id): r for r in stored.collect()}  # bounded, see above
    delete_path(spark, path)
    rows = []
    for tree in sorted({t for t, _ in known}):
        todo = [(0, 1)]
        while todo:
            at, node = todo.pop()
            r = known[tree, at]
            feature = threshold = gain = None
            if r.leftChild >= 0:
                if r.split.numCategories != -1:
                    raise ValueError("splits of categories are not supported")
                feature, threshold, gain = features[r.split.featureIndex], r.split.leftCategoriesOrThreshold[0], r.gain
                todo += [(r.leftChild, 2 * node), (r.rightChild, 2 * node + 1)]
            rows.append((tree, node, feature, threshold, r.impurityStats[0], r.prediction, None if r.impurity < 0 else r.impurity, gain))
    return spark.createDataFrame(rows, NODES)


def reached(nodes: DataFrame, value: str = "node") -> Column:
    """An array with ``value`` (node or mean) of the leaf that a row reaches in
    each tree. Rows whose feature is null or NaN go right at that split."""
    trees: dict[int, dict] = {}
    for r in nodes.collect():  # bounded, see above
        trees.setdefault(r["tree"], {})[r["node"]] = r
    features = sorted({r["feature"] for tree in trees.values() for r in tree.values() if r["feature"] is not None})
    written, depth = [], 0
    for _, tree in sorted(trees.items()):
        place = {node: k for k, node in enumerate(sorted(tree))}
        one = {"by": [], "at_most": [], "low": [], "high": [], "value": []}
        for node, r in sorted(tree.items()):
            split = r["feature"] is not None
            one["by"].append(features.index(r["feature"]) if split else -1)
            one["at_most"].append(r["threshold"] if split else 0.0)
            one["low"].append(place[2 * node] if split else -1)
            one["high"].append(place[2 * node + 1] if split else -1)
            one["value"].append(r[value])
            depth = max(depth, node.bit_length() - 1)
        written.append(one)
    kind = "double" if value == "mean" else "bigint"
    schema = f"array<struct<by array<int>, at_most array<double>, low array<int>, high array<int>, value array<{kind}>>>"
    x = F.array(*[F.col("`" + f.replace("`", "``") + "`").cast("double") for f in features]) if features else F.array(F.lit(0.0))

    def leaf(t: Column) -> Column:
        def step(at: Column, _: Column) -> Column:
            left = F.get(x, F.get(t["by"], at)) <= F.get(t["at_most"], at)
            return F.when(F.get(t["by"], at) < 0, at).when(left, F.get(t["low"], at)).otherwise(F.get(t["high"], at))

        return F.get(t["value"], F.aggregate(F.array_repeat(F.lit(0), depth), F.lit(0), step))

    return F.transform(F.from_json(F.lit(json.dumps(written)), schema), leaf)


def route(rows: DataFrame, nodes: DataFrame, keep: Sequence[str] = ("label",)) -> DataFrame:
    """``keep..., tree, leaf``: one row per row and tree."""
    return rows.select(*keep, F.posexplode(reached(nodes)).alias("tree", "leaf"))


def routed_prediction(nodes: DataFrame) -> Column:
    """Mean of the leaves that a row reaches."""
    each, trees = reached(nodes, "mean"), nodes.select("tree").distinct().count()
    return F.aggregate(each, F.lit(0.0), lambda total, x: total + x, lambda total: total / F.lit(float(trees)))


def node_statistics(routed: DataFrame, label: str = "label") -> DataFrame:
    """``tree, node, n, mean, impurity`` (population variance) of every node
    that a row passes, merged from the leaves' counts, means and variances."""
    y = F.col(label).cast("double")
    leaf = routed.groupBy("tree", "leaf").agg(
        F.count(y).alias("n"), F.avg(y).alias("mean"), F.var_pop(y).alias("var")
    )
    above = F.transform(
        F.sequence(F.lit(0), F.floor(F.log2(F.col("leaf").cast("double")) + F.lit(1e-9)).cast("int")),
        lambda k: F.call_function("shiftright", F.col("leaf"), k),
    )
    each = leaf.select("tree", F.explode(above).alias("node"), "n", "mean", "var")
    centre = each.groupBy("tree", "node").agg(
        F.sum("n").alias("n"),
        (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("mean"),
        F.collect_list(F.struct("n", "mean", "var")).alias("parts"),
    )
    spread = F.aggregate(
        "parts", F.lit(0.0), lambda total, p: total + p["n"] * (p["var"] + (p["mean"] - F.col("mean")) ** 2)
    )
    return centre.select("tree", "node", "n", "mean", (spread / F.col("n")).alias("impurity"))


def with_gains(stats: DataFrame) -> DataFrame:
    """``stats`` with ``gain``: impurity less the children's, weighted by rows
    (null where there are no children)."""
    below = stats.where("node > 1").groupBy("tree", F.expr("shiftright(node, 1)").alias("node")).agg(
        F.sum("n").alias("_n"), (F.sum(F.col("n") * F.col("impurity")) / F.sum("n")).alias("_left")
    )
    joined = stats.join(below, ["tree", "node"], "left")
    return joined.withColumn("gain", F.col("impurity") - F.col("_left")).drop("_n", "_left")


def importances(nodes: DataFrame) -> DataFrame:
    """``feature, importance``: each tree's gains weighted by rows and brought
    to the sum 1, then summed over the trees and brought to 1 again. Features
    that no tree splits by are left out."""
    split = nodes.where("feature is not null")
    total = split.groupBy("tree").agg(F.sum(F.col("gain") * F.col("n")).alias("total")).where("total > 0")
    share = split.join(total, "tree").groupBy("feature").agg(F.sum(F.col("gain") * F.col("n") / F.col("total")).alias("share"))
    return share.select("feature", (F.col("share") / F.sum("share").over(Window.partitionBy())).alias("importance"))


def checked_nodes(spark: SparkSession, model: PipelineModel, train: DataFrame, features: Sequence[str], label: str = "label") -> DataFrame:
    """The nodes with ``n, mean, impurity, gain`` counted anew from the training
    rows, beside the model's own (``model_n`` ...); nodes that no row reaches
    have nulls."""
    own = forest_nodes(spark, model, features)
    names = ["n", "mean", "impurity", "gain"]
    told = own.select("tree", "node", "feature", "threshold", *[F.col(c).alias(f"model_{c}") for c in names])
    counted = with_gains(node_statistics(route(train, own, [label]), label))
    return told.join(counted, ["tree", "node"], "full")


def nodes_agree(tolerance: float = 1e-9) -> Column:
    """Whether a row of ``checked_nodes`` has the model's figures."""
    leaf_without = F.col("feature").isNull() & F.col("model_impurity").isNull()
    both = [F.col("n") == F.col("model_n"), F.abs(F.col("mean") - F.col("model_mean")) <= tolerance]
    both.append(leaf_without | (F.abs(F.col("impurity") - F.col("model_impurity")) <= tolerance))
    gain = F.when(F.col("feature").isNull(), F.col("gain").isNull()).otherwise(F.abs(F.col("gain") - F.col("model_gain")) <= tolerance)
    out = gain
    for one in both:
        out = out & one
    return F.coalesce(out, F.lit(False))

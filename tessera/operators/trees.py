"""Fitted trees as tables, and tables as Catalyst expressions.

A tree model is read from its own saved form into one row per node. A compiler turns the
nodes of a tree into a nested ``CASE``, so scoring, leaf assignment and recounting of nodes are
ordinary column expressions: no model object, no Python, whole-stage codegen. The number of
nodes is bounded by the model's depth and number of trees, not by rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import scratch_path


def node_table(spark, model) -> DataFrame:
    """(tree, weight, node, parent, depth, feature, threshold, categories, left, right, prediction,
    impurity, stats, n): one row per node of a tree, forest or boosted-tree model.

    ``node`` counts like a heap: the root is 1, the children of ``i`` are ``2 i`` and ``2 i + 1``.
    Inner nodes send a row to the left if its feature is at most ``threshold`` or, where
    ``categories`` is not null, one of these; leaves have null there. ``n`` is the number of training
    rows the fit saw in the node, ``stats`` their (weighted) count per class."""
    path = scratch_path(spark, "tree-model")
    model.write().overwrite().save(path)
    data = spark.read.parquet(f"{path}/data")
    if "nodeData" in data.columns:
        data = data.select(F.col("treeID").alias("tree"), "nodeData.*")
        weights = dict(enumerate(model.treeWeights))
    else:
        data, weights = data.withColumn("tree", F.lit(0)), {0: 1.0}
    saved = {(r["tree"], r["id"]): r for r in data.collect()}
    rows, todo = [], [(tree, 0, 1, None, 0) for tree in sorted({t for t, _ in saved})]
    while todo:
        tree, at, node, parent, depth = todo.pop()
        r = saved[tree, at]
        inner, values = r["leftChild"] >= 0, list(r["split"]["leftCategoriesOrThreshold"] or [])
        by_category = inner and r["split"]["numCategories"] >= 0
        rows.append((tree, float(weights[tree]), node, parent, depth, r["split"]["featureIndex"] if inner else None,
                     values[0] if inner and not by_category else None, values if by_category else None,
                     2 * node if inner else None, 2 * node + 1 if inner else None, r["prediction"], r["impurity"],
                     list(r["impurityStats"]), r["rawCount"]))
        if inner:
            todo += [(tree, r["leftChild"], 2 * node, node, depth + 1), (tree, r["rightChild"], 2 * node + 1, node, depth + 1)]
    return spark.createDataFrame(rows, "tree int, weight double, node bigint, parent bigint, depth int, feature int, "
                                       "threshold double, categories array<double>, left bigint, right bigint, "
                                       "prediction double, impurity double, stats array<double>, n bigint")


def compile_tree(nodes: dict, features: Column, leaf: Callable[..., Column], at: int = 1) -> Column:
    """The value of ``leaf`` (a function of a leaf's row) for the leaf that ``features`` (an array column)
    reaches, as nested ``CASE``; ``nodes``: node -> row of one tree of ``node_table``."""
    r = nodes[at]
    if r["left"] is None:
        return leaf(r)
    x = F.get(features, r["feature"])
    goes_left = x.isin([float(c) for c in r["categories"]]) if r["categories"] is not None else x <= r["threshold"]
    return F.when(goes_left, compile_tree(nodes, features, leaf, r["left"])).otherwise(
        compile_tree(nodes, features, leaf, r["right"]))


def by_tree(table: DataFrame) -> dict[int, dict]:
    """tree -> node -> row."""
    out: dict[int, dict] = {}
    for r in table.collect():
        out.setdefault(r["tree"], {})[r["node"]] = r
    return out


def _argmax(values: list[Column]) -> Column:
    """Position of the largest value, the first of equal ones."""
    best = F.greatest(*values)
    out = F.lit(float(len(values) - 1))
    for i in reversed(range(len(values) - 1)):
        out = F.when(values[i] == best, F.lit(float(i))).otherwise(out)
    return out


def predict_votes(table: DataFrame, features: Column) -> Column:
    """Prediction of a tree or a forest: the class with the largest sum over the trees of the
    share of each class in the reached leaf."""
    trees = by_tree(table)
    classes = len(next(iter(trees.values()))[1]["stats"])
    votes = None
    for nodes in trees.values():
        def shares(r):
            total = sum(r["stats"])
            return F.array(*[F.lit(s / total if total else 0.0) for s in r["stats"]])
        vote = compile_tree(nodes, features, shares)
        votes = vote if votes is None else F.zip_with(votes, vote, lambda a, b: a + b)
    return _argmax([F.get(votes, c) for c in range(classes)]) if classes > 1 else F.lit(0.0)


def predict_margin(table: DataFrame, features: Column) -> Column:
    """Prediction of a boosted binary model: 1 where the weighted sum of leaf values is positive."""
    total = None
    for nodes in by_tree(table).values():
        value = compile_tree(nodes, features, lambda r: F.lit(r["prediction"])) * nodes[1]["weight"]
        total = value if total is None else total + value
    return (total > 0).cast("double")


def recount(rows: DataFrame, table: DataFrame, features: Column) -> DataFrame:
    """(tree, node, recounted): how many of ``rows`` pass each node, leaves counted in one pass and
    added up to their ancestors (a table of at most depth x leaves rows)."""
    trees = by_tree(table)
    leaves = F.array(*[F.struct(F.lit(t).alias("tree"), compile_tree(nodes, features, lambda r: F.lit(r["node"])).alias("leaf"))
                       for t, nodes in trees.items()])
    counts = rows.select(F.explode(leaves).alias("at")).groupBy("at.tree", "at.leaf").agg(F.count(F.lit(1)).alias("c"))
    above = [(t, n, n >> up) for t, nodes in trees.items() for n, r in nodes.items() if r["left"] is None
             for up in range(n.bit_length())]
    ancestors = rows.sparkSession.createDataFrame(above, "tree int, leaf bigint, node bigint")
    return (ancestors.join(counts, ["tree", "leaf"], "left").groupBy("tree", "node")
            .agg(F.coalesce(F.sum("c"), F.lit(0)).alias("recounted")))

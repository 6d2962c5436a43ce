"""Divisive clustering: a tree of clusters by level-wise bisection.

Every point carries the heap number of its node (root 1, children ``2 i`` and ``2 i + 1``). A level
divides all its leaves at once: two-means inside each node, as one aggregate over the points of
all of them per round. The table of centres has two rows per divided node, fewer than ``2 k``
in all, so it is always broadcast and a node with most of the points stays spread over all tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import cluster as KM
from tessera.operators.skew import HotKeys
from tessera.session import checkpoint

NODE = KM.GROUP


def _few(points: DataFrame) -> HotKeys:
    """All nodes are few, so all are joined by broadcast."""
    return HotKeys(points.select(NODE).distinct(), only=True, none=False)


def _bounds(points: DataFrame, dims: int) -> DataFrame:
    """Start centres of each node: the smallest and the largest value of every feature."""
    low = points.groupBy(NODE).agg(F.array(*[F.min(f"_x{d}") for d in range(dims)]).alias("low"),
                                   F.array(*[F.max(f"_x{d}") for d in range(dims)]).alias("high"))
    pair = F.array(F.struct(F.lit(0).alias("cluster"), F.col("low").alias("centre")),
                   F.struct(F.lit(1).alias("cluster"), F.col("high").alias("centre")))
    return low.select(NODE, F.explode(pair).alias("s")).select(NODE, "s.cluster", "s.centre")


def node_stats(points: DataFrame, dims: int, scales: list[float] | None) -> DataFrame:
    """(node, size, centre, cost): cost is the sum of squared distances to the node's mean."""
    n = F.count(F.lit(1))
    if scales is None:
        mean = [F.avg(f"_x{d}") for d in range(dims)]
    else:
        mean = [(F.sum(f"_i{d}").cast("double") / n.cast("double")) / F.lit(float(scales[d])) for d in range(dims)]
    means = points.groupBy(NODE).agg(n.alias("size"), F.array(*mean).alias("centre"))
    means = checkpoint(means)  # a row per node
    away = KM._sq_dist(F.col("centre"), dims)
    cost = points.join(F.broadcast(means), NODE).groupBy(NODE).agg(F.sum(away).alias("cost"))
    return means.join(F.broadcast(cost), NODE).select(F.col(NODE).alias("node"), "size", "centre", "cost")


def bisecting_tree(df: DataFrame, features: list[str], k: int = 4, iterations: int = 5,
                   scales: list[float] | None = None) -> tuple[DataFrame, DataFrame]:
    """(nodes, points): nodes is (node, size, centre, cost, leaf) of the whole tree, points the input's
    features with ``_g`` = the leaf of each.

    Each level divides its leaves of at least two different points, the largest first (of equal
    ones the smaller number) as long as there are fewer than ``k`` leaves; ``iterations`` rounds of
    two-means each, ties to the lower child. A node whose second child stays empty is not divided.
    Rows with a null feature are left out; without rows there are no nodes."""
    dims = len(features)
    points = checkpoint(KM.prepare_points(df, features, None, scales).withColumn(NODE, F.lit(1).cast("bigint")))
    stats = {r["node"]: r for r in node_stats(points, dims, scales).collect()}  # fewer than 2 k rows
    leaves, whole, fixed = set(stats), dict(stats), set()
    while True:
        open_ = sorted((n for n in leaves if n not in fixed and stats[n]["size"] > 1 and stats[n]["cost"] > 0),
                       key=lambda n: (-stats[n]["size"], n))[:max(0, k - len(leaves))]
        if not open_:
            break
        chosen = points.filter(F.col(NODE).isin(open_))
        hot, centres = _few(chosen), checkpoint(_bounds(chosen, dims))
        for _ in range(iterations):
            centres = checkpoint(KM.update(KM.assign(chosen, centres, 2, dims, hot), centres, dims, scales))
        divided = KM.assign(chosen, centres, 2, dims, hot)
        moved = divided.withColumn(NODE, F.col(NODE) * 2 + F.col("cluster")).drop("cluster")
        moved = checkpoint(moved)
        new = {r["node"]: r for r in node_stats(moved, dims, scales).collect()}
        split = [n for n in open_ if 2 * n in new and 2 * n + 1 in new]
        fixed |= set(open_) - set(split)
        if not split:
            continue
        points = checkpoint(points.filter(~F.col(NODE).isin(split)).unionByName(
            moved.filter(F.floor(F.col(NODE) / 2).isin(split))))
        children = {c for n in split for c in (2 * n, 2 * n + 1)}
        leaves = leaves - set(split) | children
        stats.update({c: new[c] for c in children})
        whole.update({c: new[c] for c in children})
    rows = [(n, r["size"], r["centre"], r["cost"], n in leaves) for n, r in sorted(whole.items())]
    nodes = df.sparkSession.createDataFrame(rows, "node bigint, size bigint, centre array<double>, cost double, leaf boolean")
    return nodes, points

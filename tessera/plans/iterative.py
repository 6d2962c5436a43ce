"""Iterative keys: PageRank on a customer/supplier graph, K-means (one group and
one per brand) and silhouettes. The oracles unroll the same rounds as CTEs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import bisecting as BI
from tessera.operators import cluster as KM
from tessera.operators import graph as G
from tessera.plans.registry import register
from tessera.session import checkpoint, spread
from tessera.sources.tables import table

# Rounds, start centres and feature scaling of the iterative keys.
PAGERANK_ITERATIONS = 5
KMEANS_ITERATIONS = 5
KMEANS_INIT = [[0.2, 0.2, 0.2], [0.4, 0.4, 0.4], [0.6, 0.6, 0.6], [0.8, 0.8, 0.8]]
# Features are fixed-point: quantity in units, discount and price in hundredths;
# the feature value is integer / scale (quantity/50, discount*10, price/1e5).
INT_SQL = ["CAST(l_quantity AS BIGINT)", "CAST(round(l_discount * 100) AS BIGINT)",
           "CAST(round(l_extendedprice * 100) AS BIGINT)"]
SCALES = [50.0, 10.0, 10000000.0]
FEATURES = ["x0", "x1", "x2"]


# ---------------------------------------------------------------- PageRank

def graph_edges(spark, sf):
    """Bipartite edges from orders x lineitem: supplier -> customer for return flag 'R',
    customer -> supplier for any other (string node ids ``c<key>``/``s<key>``)."""
    li = spread(table(spark, sf, "lineitem", "l_orderkey", "l_suppkey", "l_returnflag"))
    od = table(spark, sf, "orders", "o_orderkey", "o_custkey")
    j = li.join(od, li.l_orderkey == od.o_orderkey)
    c = F.concat(F.lit("c"), F.col("o_custkey").cast("string"))
    s = F.concat(F.lit("s"), F.col("l_suppkey").cast("string"))
    back = F.col("l_returnflag") == "R"
    return j.select(F.when(back, s).otherwise(c).alias("src"), F.when(back, c).otherwise(s).alias("dst"))


def _pagerank_sql(iterations):
    ctes = ["""edges AS (SELECT DISTINCT
                 CASE WHEN l_returnflag = 'R' THEN 's' || l_suppkey ELSE 'c' || o_custkey END AS src,
                 CASE WHEN l_returnflag = 'R' THEN 'c' || o_custkey ELSE 's' || l_suppkey END AS dst
               FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""",
            "deg AS (SELECT src, count(*) AS deg FROM edges GROUP BY src)",
            "l AS (SELECT e.src, e.dst, d.deg FROM edges e JOIN deg d USING (src))",
            "r0 AS (SELECT src AS node, CAST(1.0 AS DOUBLE) AS rank FROM deg)"]
    for i in range(1, iterations + 1):
        ctes.append(f"r{i} AS (SELECT l.dst AS node, 0.15 + 0.85 * sum(r.rank / l.deg) AS rank "
                    f"FROM l JOIN r{i - 1} r ON l.src = r.node GROUP BY l.dst)")
    return "WITH " + ",\n".join(ctes) + f"\nSELECT node, round(rank, 6) AS rank FROM r{iterations}"


@register("pagerank", sql=_pagerank_sql(PAGERANK_ITERATIONS))
def pagerank(spark, sf):
    ranks = G.pagerank(graph_edges(spark, sf), PAGERANK_ITERATIONS)
    return ranks.select("node", F.round("rank", 6).alias("rank"))


# ---------------------------------------------------------------- K-means

def kmeans_points(spark, sf, grouped: bool):
    """Scaled (quantity, discount, price) per line item; grouped by part brand."""
    li = spread(table(spark, sf, "lineitem", "l_partkey", "l_quantity", "l_discount", "l_extendedprice"))
    pts = li.select("l_partkey", F.col("l_quantity").cast("bigint").alias("x0"),
                    F.round(F.col("l_discount") * 100).cast("bigint").alias("x1"),
                    F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("x2"))
    if grouped:
        part = table(spark, sf, "part", "p_partkey", "p_brand")
        pts = pts.join(part, pts.l_partkey == part.p_partkey).select(F.col("p_brand").alias("grp"), *FEATURES)
    return pts


def _dist_sql(j):
    terms = [f"(x{d} - k{j}c{d}) * (x{d} - k{j}c{d})" for d in range(len(FEATURES))]
    expr = "0.0"
    for t in terms:
        expr = f"({expr} + {t})"
    return expr


def _argmin_sql(k):
    parts = []
    for j in range(k - 1):
        conds = " AND ".join(f"d{j} <= d{m}" for m in range(j + 1, k))
        parts.append(f"WHEN {conds} THEN {j}")
    return "CASE " + " ".join(parts) + f" ELSE {k - 1} END"


def _kmeans_ctes(grouped: bool, iterations: int):
    k, dims = len(KMEANS_INIT), len(FEATURES)
    g = "p_brand" if grouped else "0"
    src = "lineitem JOIN part ON l_partkey = p_partkey" if grouped else "lineitem"
    feats = ", ".join(f"{e} AS i{d}, CAST({e} AS DOUBLE) / CAST({SCALES[d]} AS DOUBLE) AS x{d}"
                      for d, e in enumerate(INT_SQL))
    init = ", ".join("(" + ", ".join([str(j)] + [f"CAST({v} AS DOUBLE)" for v in c]) + ")"
                     for j, c in enumerate(KMEANS_INIT))
    cols = ", ".join(f"c{d}" for d in range(dims))
    ctes = [f"pts AS (SELECT {g} AS g, {feats} FROM {src})",
            f"c0 AS (SELECT g, k, {cols} FROM (SELECT DISTINCT g FROM pts) gs, (VALUES {init}) AS t(k, {cols}))"]

    def assign(i):
        wide = ", ".join(f"max(CASE WHEN k = {j} THEN c{d} END) AS k{j}c{d}" for j in range(k) for d in range(dims))
        dists = ", ".join(f"{_dist_sql(j)} AS d{j}" for j in range(k))
        xs = ", ".join(f"x{d}" for d in range(dims))
        ints = ", ".join(f"i{d}" for d in range(dims))
        return [f"w{i} AS (SELECT g, {wide} FROM c{i} GROUP BY g)",
                f"a{i} AS (SELECT g, {xs}, {ints}, {_argmin_sql(k)} AS k FROM "
                f"(SELECT p.g, {xs}, {ints}, {dists} FROM pts p JOIN w{i} USING (g)) q)"]

    for i in range(iterations):
        ctes += assign(i)
        avgs = ", ".join(f"(CAST(sum(i{d}) AS DOUBLE) / CAST(count(*) AS DOUBLE)) / CAST({SCALES[d]} AS DOUBLE) AS c{d}"
                         for d in range(dims))
        keep = ", ".join(f"coalesce(n.c{d}, c.c{d}) AS c{d}" for d in range(dims))
        ctes.append(f"n{i + 1} AS (SELECT g, k, {avgs} FROM a{i} GROUP BY g, k)")
        ctes.append(f"c{i + 1} AS (SELECT c.g, c.k, {keep} FROM c{i} c LEFT JOIN n{i + 1} n USING (g, k))")
    ctes += assign(iterations)
    return ctes, f"c{iterations}", f"a{iterations}"


def _kmeans_sql(grouped: bool):
    ctes, c, a = _kmeans_ctes(grouped, KMEANS_ITERATIONS)
    rounded = ", ".join(f"c.c{d} AS x{d}" for d in range(len(FEATURES)))
    gsel = "c.g AS grp, " if grouped else ""
    return ("WITH " + ",\n".join(ctes) +
            f"\nSELECT {gsel}CAST(c.k AS INTEGER) AS cluster, CAST(coalesce(s.size, 0) AS BIGINT) AS size, {rounded} "
            f"FROM {c} c LEFT JOIN (SELECT g, k, count(*) AS size FROM {a} GROUP BY g, k) s USING (g, k)")


def _silhouette_sql():
    ctes, _, a = _kmeans_ctes(True, KMEANS_ITERATIONS)
    k, dims = len(KMEANS_INIT), len(FEATURES)

    def dot(u, v):
        expr = "0.0"
        for d in range(dims):
            expr = f"({expr} + {u(d)} * {v(d)})"
        return expr

    stats = ", ".join([f"sum(x{d}) AS s{d}" for d in range(dims)])
    ctes.append(f"st AS (SELECT g, k, CAST(count(*) AS DOUBLE) AS n, {stats}, "
                f"sum({dot(lambda d: f'x{d}', lambda d: f'x{d}')}) AS ss FROM {a} GROUP BY g, k)")
    wide = ", ".join([f"max(CASE WHEN k = {j} THEN n END) AS k{j}n" for j in range(k)] +
                     [f"max(CASE WHEN k = {j} THEN ss END) AS k{j}ss" for j in range(k)] +
                     [f"max(CASE WHEN k = {j} THEN s{d} END) AS k{j}s{d}" for j in range(k) for d in range(dims)])
    ctes.append(f"sw AS (SELECT g, {wide} FROM st GROUP BY g)")
    xx = dot(lambda d: f"x{d}", lambda d: f"x{d}")
    ds = ", ".join(f"{xx} + k{j}ss / k{j}n - 2.0 * {dot(lambda d: f'x{d}', lambda d, j=j: f'k{j}s{d}')} / k{j}n AS D{j}"
                   for j in range(k))
    xs = ", ".join(f"x{d}" for d in range(dims))
    ns = ", ".join(f"k{j}n" for j in range(k))
    ctes.append(f"pd AS (SELECT g, k, {xs}, {ns}, {ds} FROM {a} JOIN sw USING (g))")
    own_d = "CASE k " + " ".join(f"WHEN {j} THEN D{j}" for j in range(k)) + " END"
    own_n = "CASE k " + " ".join(f"WHEN {j} THEN k{j}n" for j in range(k)) + " END"
    other = "CASE k " + " ".join(
        f"WHEN {j} THEN least({', '.join(f'D{m}' for m in range(k) if m != j)})" for j in range(k)) + " END"
    ctes.append(f"ab AS (SELECT g, {own_n} AS n_own, {own_d} * {own_n} / ({own_n} - 1.0) AS a, {other} AS b FROM pd)")
    return ("WITH " + ",\n".join(ctes) +
            "\nSELECT g AS grp, round(avg(CASE WHEN n_own <= 1 OR b IS NULL THEN 0.0 WHEN a < b THEN 1.0 - a / b "
            "WHEN a > b THEN b / a - 1.0 ELSE 0.0 END), 6) AS silhouette, CAST(count(*) AS BIGINT) AS n FROM ab GROUP BY g")


def _kmeans_result(centres, assigned, grouped: bool):
    sizes = KM.cluster_sizes(assigned)
    out = centres.join(sizes, [KM.GROUP, "cluster"], "left")
    cols = [F.col("cluster"), F.coalesce(F.col("size"), F.lit(0)).cast("bigint").alias("size")] + \
        [F.col("centre")[d].alias(f"x{d}") for d in range(len(FEATURES))]
    return out.select(*([F.col(KM.GROUP).alias("grp")] if grouped else []), *cols)


def _fit(spark, sf, grouped: bool):
    return KM.kmeans_lloyd(kmeans_points(spark, sf, grouped), FEATURES, KMEANS_INIT, KMEANS_ITERATIONS,
                           group="grp" if grouped else None, scales=SCALES)


def _centres_and_sizes(spark, sf, grouped: bool):
    fit = _fit(spark, sf, grouped)
    try:
        return checkpoint(_kmeans_result(fit.centres, fit.assigned(), grouped))  # groups x k rows
    finally:
        fit.release()


@register("kmeans_lloyd", sql=_kmeans_sql(False))
def kmeans_lloyd(spark, sf):
    return _centres_and_sizes(spark, sf, False)


@register("kmeans_grouped", sql=_kmeans_sql(True))
def kmeans_grouped(spark, sf):
    return _centres_and_sizes(spark, sf, True)


@register("silhouette", sql=_silhouette_sql())
def silhouette(spark, sf):
    fit = _fit(spark, sf, True)
    try:
        s = checkpoint(KM.silhouette(fit.assigned(), fit.dims, fit.k, fit.hot))  # one row per group
    finally:
        fit.release()
    return s.select(F.col(KM.GROUP).alias("grp"), F.round("silhouette", 6).alias("silhouette"), "n")


#: Leaves and rounds of two-means per level of the cluster tree.
TREE_LEAVES, TREE_ITERATIONS = 4, 5


def _cluster_tree_sql(levels: int = 2, rounds: int = TREE_ITERATIONS) -> str:
    """All leaves are divided on each level: TREE_LEAVES is 2 to the power of ``levels``."""
    dims = len(FEATURES)
    every = range(dims)
    feats = ", ".join(f"{e} AS i{d}, CAST({e} AS DOUBLE) / CAST({SCALES[d]} AS DOUBLE) AS x{d}" for d, e in enumerate(INT_SQL))
    keep = ", ".join(f"x{d}, i{d}" for d in every)
    mean = ", ".join(f"(CAST(sum(i{d}) AS DOUBLE) / CAST(count(*) AS DOUBLE)) / CAST({SCALES[d]} AS DOUBLE) AS c{d}" for d in every)
    ctes, nodes = [f"p0 AS (SELECT CAST(1 AS BIGINT) AS node, {feats} FROM lineitem)"], []

    def dist(side):
        total = "(x0 - {s}0) * (x0 - {s}0)".format(s=side)
        for d in range(1, dims):
            total = f"({total} + (x{d} - {side}{d}) * (x{d} - {side}{d}))"
        return total

    def stats(level, leaf):
        away = dist("s.c")
        ctes.append(f"s{level} AS (SELECT node, count(*) AS size, {mean} FROM p{level} GROUP BY node)")
        nodes.append(f"SELECT node, any_value(size) AS size, {', '.join(f'any_value(c{d}) AS x{d}' for d in every)}, "
                     f"sum({away}) AS cost, {leaf} AS leaf FROM p{level} JOIN s{level} s USING (node) GROUP BY node")

    for level in range(levels):
        stats(level, "false")
        low = ", ".join([f"min(x{d}) AS a{d}" for d in every] + [f"max(x{d}) AS b{d}" for d in every])
        ctes.append(f"k{level}_0 AS (SELECT node, {low} FROM p{level} GROUP BY node)")
        side = f"CASE WHEN {dist('a')} <= {dist('b')} THEN 0 ELSE 1 END"
        for r in range(rounds):
            half = ", ".join(f"(CAST(sum(i{d}) FILTER (side = {s}) AS DOUBLE) / CAST(count(*) FILTER (side = {s}) AS DOUBLE)) "
                             f"/ CAST({SCALES[d]} AS DOUBLE) AS n{n}{d}" for s, n in ((0, "a"), (1, "b")) for d in every)
            new = ", ".join(f"coalesce(n{n}{d}, {n}{d}) AS {n}{d}" for n in "ab" for d in every)
            ctes.append(f"k{level}_{r + 1} AS (SELECT node, {new} FROM k{level}_{r} JOIN (SELECT node, {half} FROM "
                        f"(SELECT node, {keep}, {side} AS side FROM p{level} JOIN k{level}_{r} USING (node)) GROUP BY node) USING (node))")
        ctes.append(f"p{level + 1} AS (SELECT 2 * node + {side} AS node, {keep} FROM p{level} JOIN k{level}_{rounds} USING (node))")
    stats(levels, "true")
    cols = ", ".join(f"round(x{d}, 9) AS x{d}" for d in every)
    return (f"WITH {', '.join(ctes)} SELECT node, CAST(size AS BIGINT) AS size, {cols}, round(cost, 3) AS cost, leaf "
            f"FROM ({' UNION ALL '.join(nodes)})")


@register("cluster_tree", sql=_cluster_tree_sql())
def cluster_tree(spark, sf):
    """Line items divided twice: size, centre and cost of every node of the tree."""
    nodes, _ = BI.bisecting_tree(kmeans_points(spark, sf, False), FEATURES, TREE_LEAVES, TREE_ITERATIONS, SCALES)
    return nodes.select("node", "size", *[F.round(F.col("centre")[d], 9).alias(f"x{d}") for d in range(len(FEATURES))],
                        F.round("cost", 3).alias("cost"), "leaf")

"""Alternating least squares with errors, and the divisive cluster tree, against NumPy."""

import random

import numpy as np
from pyspark.sql import functions as F

from tessera.operators import bisecting as BI
from tessera.operators import factorise as FA


def als_numpy(ratings, rank, iterations, reg):
    users, items = sorted({u for u, _, _ in ratings}), sorted({i for _, i, _ in ratings})
    start = lambda k: [((k % FA.PRIME * rank + f + 1) * FA.MULTIPLIER % FA.PRIME) / FA.PRIME for f in range(rank)]
    x, y, errors = {u: np.array(start(u)) for u in users}, {}, []

    def solve(key, at, side):
        rows = [(side[r[1 - at]], r[2]) for r in ratings if r[at] == key]
        m, b = np.array([v for v, _ in rows]), np.array([v for _, v in rows])
        return np.linalg.solve(m.T @ m + reg * len(rows) * np.eye(rank), m.T @ b)

    for _ in range(iterations):
        y = {i: solve(i, 1, x) for i in items}
        x = {u: solve(u, 0, y) for u in users}
        errors.append(np.sqrt(np.mean([(r - x[u] @ y[i]) ** 2 for u, i, r in ratings])))
    return x, y, errors


def test_als_errors_equal_numpy(spark):
    rng = random.Random(4)
    ratings = [(u, i, rng.random() * 5) for u in range(40) for i in range(25) if rng.random() < 0.8 or u == 0]
    ratings += [(10**15 + 7, 3, 2.5), (10**15 + 7, 4, 1.0), (1, 1, 3.0)]  # a 64-bit id, a repeated pair
    df = spark.createDataFrame(ratings + [(None, 1, 2.0), (1, None, 2.0), (2, 2, None)], "user_id bigint, item_id bigint, rating double")
    users, items, errors = FA.als_errors(df, rank=10, iterations=5, reg=0.01)
    x, y, want = als_numpy(ratings, 10, 5, 0.01)
    assert [i for i, _ in errors] == [1, 2, 3, 4, 5] and np.allclose([e for _, e in errors], want, rtol=1e-9)
    got = {r["key"]: r["factors"] for r in users.collect()}
    assert got.keys() == x.keys() and all(np.allclose(got[k], x[k], atol=1e-7) for k in x)
    assert {r["key"] for r in items.collect()} == set(y)
    assert all(b <= a + 1e-9 for (_, a), (_, b) in zip(errors, errors[1:]))


def test_als_without_ratings(spark):
    users, items, errors = FA.als_errors(spark.createDataFrame([], "user_id bigint, item_id bigint, rating double"))
    assert users.count() == 0 and items.count() == 0 and errors == []


def test_a_hot_user_is_not_joined_in_one_task(spark):
    rows = [(0, i, float(i % 7)) for i in range(3000)] + [(u, u % 50, 1.0) for u in range(1, 3000)]
    df = spark.createDataFrame(rows, "user_id bigint, item_id bigint, rating double")
    _, _, errors = FA.als_errors(df, rank=2, iterations=2)
    assert np.allclose([e for _, e in errors], als_numpy(rows, 2, 2, 0.01)[2], rtol=1e-9)


def tree_numpy(x, k, iterations):
    node, nodes, fixed = np.ones(len(x), int), {}, set()

    def describe(n):
        m = x[node == n]
        nodes[n] = (len(m), m.mean(0), float(((m - m.mean(0)) ** 2).sum()))

    describe(1)
    while True:
        leaves = sorted(set(node), key=lambda n: (-nodes[n][0], n))
        todo = [n for n in leaves if n not in fixed and nodes[n][0] > 1 and nodes[n][2] > 0][:max(0, k - len(leaves))]
        if not todo:
            return nodes, node
        for n in todo:
            at = np.flatnonzero(node == n)
            m = x[at]
            c = [m.min(0), m.max(0)]
            side = lambda: (((m - c[1]) ** 2).sum(1) < ((m - c[0]) ** 2).sum(1)).astype(int)
            for _ in range(iterations):
                s = side()
                c = [m[s == j].mean(0) if (s == j).any() else c[j] for j in (0, 1)]
            s = side()
            if 0 < s.sum() < len(s):
                node[at] = 2 * n + s
                describe(2 * n), describe(2 * n + 1)
            else:
                fixed.add(n)


def test_cluster_tree_equals_numpy(spark):
    rng = np.random.default_rng(9)
    x = np.vstack([rng.normal(c, 1, (n, 3)) for c, n in (((0, 0, 0), 300), ((8, 0, 1), 120), ((0, 9, 9), 60), ((20, 20, 0), 9))])
    df = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(x)] + [(999, None, 1.0, 1.0)], "id int, a double, b double, c double")
    for k in (1, 5):
        nodes, points = BI.bisecting_tree(df, ["a", "b", "c"], k=k)
        want, node = tree_numpy(x.copy(), k, 5)
        got = {r["node"]: r for r in nodes.collect()}
        assert got.keys() == want.keys()
        for n, (size, centre, cost) in want.items():
            assert got[n]["size"] == size and np.allclose(got[n]["centre"], centre) and abs(got[n]["cost"] - cost) < 1e-6 * (1 + cost)
        assert {n for n, r in got.items() if r["leaf"]} == set(node.tolist())
        sizes = {r["_g"]: r["count"] for r in points.groupBy("_g").count().collect()}
        assert sizes == {n: want[n][0] for n in set(node.tolist())}


def test_equal_points_are_not_divided(spark):
    df = spark.createDataFrame([(1.0, 2.0)] * 50 + [(3.0, 2.0)], "a double, b double")
    nodes, _ = BI.bisecting_tree(df, ["a", "b"], k=8)
    assert {(r["node"], r["size"], r["cost"]) for r in nodes.filter("leaf").collect()} == {(2, 50, 0.0), (3, 1, 0.0)}
    empty, points = BI.bisecting_tree(df.filter(F.lit(False)), ["a", "b"])
    assert empty.count() == 0 and points.count() == 0

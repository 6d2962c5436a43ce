"""Certificates of linear models and trees as tables."""

import numpy as np
import pytest
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LinearSVC, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tessera.operators import trees as TR
from tessera.operators.certificate import certify_linear


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(6)
    x = rng.normal([1, -2, 0, 5], [1, 3, .2, 1], (600, 4))
    y = (x[:, 0] - 0.4 * x[:, 1] + rng.normal(0, 1, 600) > 1.8).astype(float)
    y3 = np.clip(np.round(x[:, 0] + rng.normal(0, .4, 600)), 0, 2)
    rows = [(i, Vectors.dense(v), float(a), float(b)) for i, (v, a, b) in enumerate(zip(x, y, y3))]
    df = spark.createDataFrame(rows, ["id", "features", "label", "label3"]).cache()
    return df, x, y, y3


def numpy_objective(x, y, w, b, reg, alpha, kind):
    sd = x.std(0, ddof=1)
    m = x @ w.T + b
    if kind == "hinge":
        loss = np.maximum(0, 1 - (2 * y - 1) * m[:, 0]).mean()
    elif len(w) == 1:
        loss = (np.logaddexp(0, m[:, 0]) - y * m[:, 0]).mean()
    else:
        top = m.max(1)
        loss = (top + np.log(np.exp(m - top[:, None]).sum(1)) - m[np.arange(len(y)), y.astype(int)]).mean()
    v = w * sd
    return loss + reg * (alpha * np.abs(v).sum() + (1 - alpha) / 2 * (v ** 2).sum())


@pytest.mark.parametrize("label,family,alpha", [("label", "binomial", 0.5), ("label3", "multinomial", 0.0), ("label3", "multinomial", 0.7)])
def test_logistic_certificate(points, label, family, alpha):
    df, x, y, y3 = points
    target = y if label == "label" else y3
    fit = lambda it: LogisticRegression(maxIter=it, tol=1e-10, regParam=0.05, elasticNetParam=alpha, family=family,
                                        labelCol=label).fit(df)
    good, poor = fit(300), fit(1)
    c = certify_linear(df, good, 0.05, alpha, label)
    w, b = good.coefficientMatrix.toArray(), good.interceptVector.toArray()
    assert abs(c.objective - numpy_objective(x, target, w, b, 0.05, alpha, "log")) < 1e-9
    assert abs(c.perturbed[0] - numpy_objective(x, target, w * .9, b, 0.05, alpha, "log")) < 1e-9
    assert c.violation < 1e-5 and c.below_null and c.below_perturbed
    assert certify_linear(df, poor, 0.05, alpha, label).violation > 1e-3
    assert not certify_linear(df, good, 0.02, alpha, label).optimal(1e-4)  # another penalty has another optimum


def test_hinge_certificate(points):
    df, x, y, _ = points
    good, poor = (LinearSVC(maxIter=it, tol=1e-10, regParam=0.05).fit(df) for it in (200, 1))
    c = certify_linear(df, good, 0.05)
    w, b = good.coefficients.toArray()[None, :], np.array([good.intercept])
    assert abs(c.objective - numpy_objective(x, y, w, b, 0.05, 0.0, "hinge")) < 1e-9
    assert c.optimal(0.02) and c.below_null and c.below_perturbed
    assert not certify_linear(df, poor, 0.05).optimal(0.02)


def test_wide_sparse_features_and_null_labels(spark):
    rng = np.random.default_rng(2)
    rows = [(Vectors.sparse(5000, sorted(int(k) for k in rng.choice(5000, 6, replace=False)), [1.0] * 6), float(i % 2))
            for i in range(200)] + [(Vectors.sparse(5000, [1], [1.0]), None)]
    df = spark.createDataFrame(rows, ["features", "label"])
    model = LogisticRegression(maxIter=200, tol=1e-10, regParam=0.1, elasticNetParam=0.1).fit(df.dropna())
    c = certify_linear(df, model, 0.1, 0.1)
    assert c.n == 200 and c.violation < 1e-4 and len(c.coefficients) == 5001


@pytest.mark.parametrize("kind", ["tree", "forest", "gbt"])
def test_trees_as_tables_predict_and_count(points, spark, kind):
    df, *_ = points
    label = "label" if kind == "gbt" else "label3"
    clf = {"tree": DecisionTreeClassifier(maxDepth=5, seed=1), "forest": RandomForestClassifier(numTrees=4, seed=1),
           "gbt": GBTClassifier(maxIter=4, seed=1)}[kind].setLabelCol(label)
    model = clf.fit(df)
    table = TR.node_table(spark, model)
    x = vector_to_array("features")
    guess = TR.predict_margin(table, x) if kind == "gbt" else TR.predict_votes(table, x)
    out = model.transform(df).withColumn("guess", guess)
    assert out.filter("guess <> prediction OR guess IS NULL").count() == 0
    counts = {(r["tree"], r["node"]): r["recounted"] for r in TR.recount(df, table, x).collect()}
    nodes = {(r["tree"], r["node"]): r for r in table.collect()}
    assert counts.keys() == nodes.keys()
    for (t, n), r in nodes.items():
        if kind == "tree":
            assert counts[t, n] == r["n"] == sum(r["stats"])
        if r["left"]:
            assert counts[t, n] == counts[t, r["left"]] + counts[t, r["right"]] and nodes[t, r["left"]]["parent"] == n


def test_categorical_splits_and_single_leaf(spark):
    from pyspark.ml.feature import VectorIndexer
    rows = [(Vectors.dense([float(i % 4), float(i)]), float(i % 4 in (1, 2))) for i in range(80)]
    df = spark.createDataFrame(rows, ["raw", "label"])
    df = VectorIndexer(inputCol="raw", outputCol="features", maxCategories=4).fit(df).transform(df)
    model = DecisionTreeClassifier(maxDepth=3).fit(df)
    table = TR.node_table(spark, model)
    assert table.filter("categories IS NOT NULL").count() > 0
    x = vector_to_array("features")
    out = model.transform(df).withColumn("guess", TR.predict_votes(table, x))
    assert out.filter("guess <> prediction").count() == 0
    one = DecisionTreeClassifier().fit(df.withColumn("label", F.lit(0.0)))
    table = TR.node_table(spark, one)
    assert table.count() == 1 and TR.recount(df, table, x).first()["recounted"] == 80

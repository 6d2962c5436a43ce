import pytest
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tessera.operators import classify as CL
from tessera.operators import cluster as KM
from tessera.operators.graph import pagerank
from tests.conftest import rows

# The eight links of the classic example graph.
EDGES = [("A", "C"), ("B", "C"), ("D", "C"), ("C", "A"), ("C", "B"), ("C", "E"), ("E", "A"), ("E", "B")]
POINTS = [(0.0, 0.0, 0.0), (0.1, 0.1, 0.1), (0.2, 0.2, 0.2), (9.0, 9.0, 9.0), (9.1, 9.1, 9.1), (9.2, 9.2, 9.2)]


def edges(spark):
    return spark.createDataFrame(EDGES + [("A", "C")], "src string, dst string")  # duplicate edge is dropped


@pytest.mark.parametrize("iters,want", [
    (1, {"A": 0.858333, "B": 0.858333, "C": 2.7, "E": 0.433333}),
    (5, {"A": 0.978486, "B": 0.978486, "C": 1.815069, "E": 0.671665}),
    (10, {"A": 0.916937, "B": 0.916937, "C": 1.721554, "E": 0.641446}),
])
def test_pagerank_example_graph(spark, iters, want):
    got = dict(rows(pagerank(edges(spark), iters), "node", "rank"))
    assert set(got) == set(want)  # D has no in-links: it drops out
    for k, v in want.items():
        assert got[k] == pytest.approx(v, abs=1e-6)


def test_pagerank_keep_all_nodes(spark):
    got = dict(rows(pagerank(edges(spark), 1, keep_all_nodes=True), "node", "rank"))
    assert got["D"] == pytest.approx(0.15)


def points(spark):
    return spark.createDataFrame(POINTS, "x double, y double, z double")


def test_kmeans_lloyd_two_clusters(spark):
    fit = KM.kmeans_lloyd(points(spark), ["x", "y", "z"], [[0.0, 0.0, 0.0], [9.0, 9.0, 9.0]], 10)
    centres, assigned = fit.centres, fit.assigned()
    got = sorted(r["centre"] for r in centres.collect())
    assert got[0] == pytest.approx([0.1] * 3) and got[1] == pytest.approx([9.1] * 3)
    assert sorted(rows(KM.cluster_sizes(assigned), "cluster", "size")) == [(0, 3), (1, 3)]


def test_empty_cluster_keeps_its_centre(spark):
    fit = KM.kmeans_lloyd(points(spark), ["x", "y", "z"], [[0.0] * 3, [9.0] * 3, [100.0] * 3], 3)
    got = {r["cluster"]: r["centre"] for r in fit.centres.collect()}
    assert got[2] == [100.0] * 3


def test_silhouette_matches_library_evaluator(spark):
    fit = KM.kmeans_lloyd(points(spark), ["x", "y", "z"], [[0.0] * 3, [9.0] * 3], 5)
    assigned = fit.assigned()
    ours = KM.silhouette(assigned, 3, 2, fit.hot).first()["silhouette"]
    lib = ClusteringEvaluator(predictionCol="cluster").evaluate(
        assigned.select(array_to_vector(F.array("_x0", "_x1", "_x2")).alias("features"), F.col("cluster").cast("int")))
    assert ours == pytest.approx(lib, abs=1e-9) and ours == pytest.approx(0.999753, abs=1e-6)


def test_grouped_equals_separate_runs(spark):
    pts = spark.createDataFrame([("g1",) + p for p in POINTS] + [("g2", x + 1, y, z) for x, y, z in POINTS],
                                "g string, x double, y double, z double")
    init = [[0.0] * 3, [9.0] * 3]
    fit = KM.kmeans_lloyd(pts, ["x", "y", "z"], init, 5, group="g")
    got = {(r["_g"], r["cluster"]): r["centre"] for r in fit.centres.collect()}
    for g in ("g1", "g2"):
        alone = KM.kmeans_lloyd(pts.filter(F.col("g") == g), ["x", "y", "z"], init, 5).centres
        for r in alone.collect():
            assert got[(g, r["cluster"])] == pytest.approx(r["centre"])


def test_exact_means_do_not_depend_on_partitioning(spark):
    df = spark.range(0, 3000).select((F.col("id") % 97).alias("a"), (F.col("id") % 13).alias("b"))
    init = [[0.0, 0.0], [0.5, 0.5]]
    one = KM.kmeans_lloyd(df.coalesce(1), ["a", "b"], init, 4, scales=[100.0, 10.0]).centres
    many = KM.kmeans_lloyd(df.repartition(7), ["a", "b"], init, 4, scales=[100.0, 10.0]).centres
    assert sorted(rows(one, "cluster", "centre")) == sorted(rows(many, "cluster", "centre"))


def test_library_kmeans_and_bisecting(spark):
    df = points(spark).select(array_to_vector(F.array("x", "y", "z")).alias("features"))
    model, out = CL.kmeans_ml(df, k=2, seed=1)
    centres = sorted(list(c) for c in model.clusterCenters())
    assert centres[0] == pytest.approx([0.1] * 3) and centres[1] == pytest.approx([9.1] * 3)
    assert CL.silhouette_ml(out) == pytest.approx(0.999753, abs=1e-6)
    bmodel, _ = CL.bisecting_kmeans(df, k=2, max_iter=5)
    assert bmodel.summary.trainingCost == pytest.approx(0.12, abs=1e-9)


def test_grouped_cluster_sizes_sum_to_points(spark):
    from tessera.plans import iterative as I
    from tests.conftest import SF_SMALL
    pts = I.kmeans_points(spark, SF_SMALL, True)
    fit = KM.kmeans_lloyd(pts, I.FEATURES, I.KMEANS_INIT, 3, group="grp", scales=I.SCALES)
    sizes = KM.cluster_sizes(fit.assigned()).groupBy("_g").agg(F.sum("size").alias("n"))
    per_group = pts.groupBy(F.col("grp").alias("_g")).count()
    assert sorted(rows(sizes, "_g", "n")) == sorted(rows(per_group, "_g", "count"))
    fit.release()


def test_bisecting_cost_not_above_one_cluster_cost(spark):
    from tessera.plans import ml
    from tests.conftest import SF_SMALL
    emb = ml._embeddings(spark, SF_SMALL)
    model, _ = CL.bisecting_kmeans(emb, k=2, max_iter=5)
    from pyspark.ml.functions import vector_to_array
    x = emb.select(F.posexplode(vector_to_array("features")).alias("pos", "v"))
    one = x.groupBy("pos").agg((F.sum(F.col("v") * F.col("v")) - F.sum("v") ** 2 / F.count("v")).alias("ss")) \
        .agg(F.sum("ss")).first()[0]
    assert model.summary.trainingCost <= one + 1e-6


def test_silhouette_with_an_empty_cluster(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    fit = KM.kmeans_lloyd(points(spark), ["x", "y", "z"], [[0.0] * 3, [9.0] * 3, [100.0] * 3], 3)
    s = KM.silhouette(fit.assigned(), 3, 3, fit.hot).first()["silhouette"]
    assert s == pytest.approx(0.999753, abs=1e-6)  # the empty cluster plays no part


def test_sampled_start_is_repeatable_and_converges(spark):
    pts = spark.createDataFrame([("g1",) + p for p in POINTS] + [("g2", x + 1, y, z) for x, y, z in POINTS] +
                                [("g3", 5.0, 5.0, 5.0)], "g string, x double, y double, z double")
    a = KM.kmeans_lloyd(pts, ["x", "y", "z"], 2, 10, group="g", seed=42)
    b = KM.kmeans_lloyd(pts.repartition(5), ["x", "y", "z"], 2, 10, group="g", seed=42)
    got = {(r["_g"], r["cluster"]): r["centre"] for r in a.centres.collect()}
    assert got == {(r["_g"], r["cluster"]): r["centre"] for r in b.centres.collect()}
    g1 = sorted(v for (g, _), v in got.items() if g == "g1")
    assert g1[0] == pytest.approx([0.1] * 3) and g1[1] == pytest.approx([9.1] * 3)
    assert got[("g3", 0)] == got[("g3", 1)] == [5.0, 5.0, 5.0]  # one point: the spare cluster repeats it
    assert sorted(rows(KM.cluster_sizes(a.assigned()).filter("_g = 'g3'"), "cluster", "size")) == [(0, 1)]

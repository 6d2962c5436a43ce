"""Hot keys (a third of all rows on one key): where their rows go, and that results are
the same with Spark's own broadcasts off."""

import contextlib

import pytest
from pyspark.sql import functions as F

from tessera.operators import cluster as KM
from tessera.operators import graph as G
from tessera.operators import relational as R
from tessera.operators import stats as S
from tessera.operators.skew import hot_keys, join_by_key
from tests.conftest import rows

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
}


@contextlib.contextmanager
def large_input_paths(spark, monkeypatch):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def hub_edges(spark):
    # node 0 links to everyone (a third of all edges); the rest form a ring plus back-links
    n = 3000
    hub = spark.range(1, n + 1).select(F.lit("0").alias("src"), F.col("id").cast("string").alias("dst"))
    ring = spark.range(1, n + 1).select(F.col("id").cast("string").alias("src"),
                                        ((F.col("id") % n) + 1).cast("string").alias("dst"))
    back = spark.range(1, n + 1).select(F.col("id").cast("string").alias("src"), F.lit("0").alias("dst"))
    return hub.union(ring).union(back)


def test_pagerank_hub_same_on_both_paths(spark, monkeypatch):
    e = hub_edges(spark)
    small = dict(rows(G.pagerank(e, 4), "node", "rank"))
    with large_input_paths(spark, monkeypatch):
        big = dict(rows(G.pagerank(e, 4), "node", "rank"))
    assert small.keys() == big.keys() and len(small) == 3001
    assert all(big[k] == pytest.approx(v, rel=1e-12) for k, v in small.items())


def test_grouped_kmeans_hot_group_same_on_both_paths(spark, monkeypatch):
    base = spark.range(0, 9000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 50).cast("string")).alias("g"),
        (F.col("id") % 101).alias("a"), (F.col("id") % 37).alias("b"))
    init = [[0.1, 0.1], [0.9, 0.9], [0.5, 0.2]]
    fit = KM.kmeans_lloyd(base, ["a", "b"], init, 4, group="g", scales=[100.0, 37.0])
    want = sorted(rows(fit.centres, "_g", "cluster", "centre"))
    sil_want = dict(rows(KM.silhouette(fit.assigned(), 2, 3, fit.hot), "_g", "silhouette"))
    fit.release()
    with large_input_paths(spark, monkeypatch):
        fit2 = KM.kmeans_lloyd(base, ["a", "b"], init, 4, group="g", scales=[100.0, 37.0])
        got = sorted(rows(fit2.centres, "_g", "cluster", "centre"))
        sil_got = dict(rows(KM.silhouette(fit2.assigned(), 2, 3, fit2.hot), "_g", "silhouette"))
        fit2.release()
    assert got == want
    assert all(sil_got[g] == pytest.approx(v, abs=1e-12) for g, v in sil_want.items())


def test_hot_key_lists_and_ranks_stay_bounded(spark):
    df = spark.range(0, 30000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"),
                                      (F.col("id") % 5).cast("double").alias("v"))
    lists = dict(rows(R.group_lists(df, "k", "v"), "k", "items"))
    entries = lists[7].split(",")  # 10,001 rows of key 7 -> one entry per distinct value
    assert [e.split("x")[0] for e in entries] == ["0.0", "1.0", "2.0", "3.0", "4.0"]
    assert sum(int(e.split("x")[1]) for e in entries) == 10001
    ranks = dict(rows(S.average_ranks(df, "k"), "k", "rank"))
    # 7 holds 10,000 + 1 rows; values below 7 are 1, 2, 4, 5 (id % 3 != 0 among 0..6)
    assert ranks[7] == pytest.approx(4 + (10001 + 1) / 2)


def shuffled_counts(spark, df, key):
    """Rows of each task after a shuffle on ``key``."""
    return [r["count"] for r in df.repartition(16, key).groupBy(F.spark_partition_id()).count().collect()]


def third_on_one_key(spark, n=30_000):
    return spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), "id")


def test_hot_keys_are_few_and_found(spark):
    df = third_on_one_key(spark)
    assert [r["k"] for r in hot_keys(df, "k").keys.collect()] == [-1]
    assert hot_keys(spark.range(5).select(F.col("id").alias("k")), "k").none  # one row each: none is hot
    many = spark.range(40_000).select((F.col("id") % 1500).alias("k"))
    assert hot_keys(many, "k", share=1000).none
    assert hot_keys(many.withColumn("k", F.lit(1)), "k").only


def test_hot_rows_never_meet_in_one_task(spark):
    df = third_on_one_key(spark)
    hot = hot_keys(df, "k")
    assert max(shuffled_counts(spark, df, "k")) > 9_000  # the plain join would put them in one task
    rest = df.join(F.broadcast(hot.keys), "k", "left_anti")
    assert max(shuffled_counts(spark, rest, "k")) < 2 * 20_000 / 16
    with large_input_paths(spark, None):
        sizes = df.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
        joined = join_by_key(df, sizes, "k", hot)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        got = joined.groupBy(F.spark_partition_id().alias("p")).agg(
            F.count(F.lit(1)).alias("n"), F.sum((F.col("k") == -1).cast("int")).alias("hot")).collect()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" in plan
    assert sum(r["n"] for r in got) == 30_000
    assert max(r["hot"] for r in got) < 5_000  # as the input lies, four partitions of 2,500


def test_pagerank_and_kmeans_broadcast_only_the_hot_side(spark, monkeypatch):
    with large_input_paths(spark, None):
        edges = hub_edges(spark)
        links = G.out_links(edges)
        plan = links._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" in plan
        deg = {r["src"]: r["deg"] for r in links.select("src", "deg").distinct().collect()}
    assert deg["0"] == 3000 and deg["5"] == 2


def test_joins_agree_with_the_plain_join(spark):
    df = third_on_one_key(spark, 3000)
    for df in (df, df.filter("k = -1"), df.filter("k <> -1").withColumn("k", F.col("k") % 1500)):  # both kinds, hot only, none hot
        per_key = df.groupBy("k").agg(F.max("id").alias("m")).filter("k % 2 <> 0")
        want = sorted(rows(df.join(per_key, "k"), "k", "id", "m"))
        assert sorted(rows(join_by_key(df, per_key, "k", hot_keys(df, "k")), "k", "id", "m")) == want

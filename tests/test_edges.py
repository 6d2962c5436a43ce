"""Bad and odd data: it must neither kill a job nor bend its result."""

import math
import os

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Correlation
from pyspark.sql import functions as F

from tessera.operators import classify as CL
from tessera.operators import stats as S
from tessera.session import scratch_path
from tessera.sources.files import parse_delimited
from tessera.streaming import batch_counts as BC


def test_short_and_unparsable_lines_give_nulls(spark):
    lines = spark.createDataFrame([("1,ann,2.5",), ("2",), ("",), ("x,y,z,more",), (None,)], "value string")
    got = parse_delimited(lines, ",", [("a", "int"), ("b", "string"), ("c", "double")]).collect()
    assert [tuple(r) for r in got] == [(1, "ann", 2.5), (2, None, None), (None, None, None),
                                       (None, "y", None), (None, None, None)]


def test_constant_and_null_columns_in_correlations(spark):
    df = spark.createDataFrame([(float(i), 5.0, float(i * i) if i % 3 else None) for i in range(12)], "a double, k double, b double")
    assert math.isnan(S.corr_pair(df, "a", "k").first()["r"]) and math.isnan(S.corr_spearman(df, "a", "k").first()["r"])
    cells = {(r["i"], r["j"]): r["r"] for r in S.corr_matrix(df, ["a", "k", "b"]).collect()}
    assert math.isnan(cells[0, 1]) and cells[0, 2] == pytest.approx(df.dropna().stat.corr("a", "b"))
    assert S.corr_spearman(df, "a", "b").first()["r"] == pytest.approx(1.0)
    none = df.filter("a < 0")
    assert math.isnan(S.corr_pair(none, "a", "b").first()["r"])


def test_spearman_ranks_complete_pairs_only(spark):
    rows = [(1.0, 1.0), (2.0, 3.0), (3.0, 2.0), (4.0, 4.0)] + [(None, float(x)) for x in (0, 9, 8)] + [(float(x), None) for x in (0, 2.5, 7)]
    assert S.corr_spearman(spark.createDataFrame(rows, "a double, b double"), "a", "b").first()["r"] == pytest.approx(0.8)


@pytest.mark.parametrize("method", ["pearson", "spearman"])
def test_correlation_of_a_vector_column(spark, method):
    df = spark.range(40).select(F.array(*[((F.col("id") * p) % 17).cast("double") for p in (1, 3, 7)]).alias("a"))
    df = df.select(array_to_vector("a").alias("features"))
    want = Correlation.corr(df, "features", method).first()[0].toArray()
    assert {(r["i"], r["j"]): r["r"] for r in S.corr_vector(df, method=method).collect()} == pytest.approx(
        {(i, j): want[i][j] for i in range(3) for j in range(3)})


def test_regression_metrics_of_a_constant_label(spark):
    m = S.regression_metrics(spark.createDataFrame([(1.0, 2.0), (3.0, 2.0)], "p double, y double"), "p", "y").first()
    assert m["n"] == 2 and m["rmse"] == pytest.approx(1.0) and math.isnan(m["r2"])


@pytest.mark.parametrize("kind", ["tree", "forest"])
def test_label_and_category_only_in_the_test_split(spark, kind):
    rows = [(float(i % 2), float(i % 3), "ab"[i % 2]) for i in range(60)]
    odd = [(9.0, 1.0, "new"), (0.0, 2.0, "a")]
    frame = lambda r: VectorAssembler(inputCols=["x", "y"], outputCol="features").transform(
        spark.createDataFrame(r, "x double, y double, label string"))
    _, out = CL.tree_models(frame(rows), frame(odd), kind)
    assert out.count() == 2


def test_als_with_ids_beyond_32_bits(spark):
    big = 1 << 40
    rows = [(big + u, big * 2 + i, float((u * i) % 5)) for u in range(12) for i in range(9)]
    model, out = CL.als(spark.createDataFrame(rows, "user_id bigint, item_id bigint, rating double"), rank=4, max_iter=5)
    got = CL.factor_product(out, model).collect()
    assert len(got) == 108 and all(r["is_product"] for r in got) and min(r["user_id"] for r in got) == big


def test_als_deals_the_ratings_out_once_by_user_and_once_by_item(spark):
    """Every exchange of the ratings counts: the model's joins and those of the check share theirs."""
    ratings = spark.range(4000).select((F.col("id") % 2000).alias("user_id"), (F.col("id") * 7 % 3000).alias("item_id"),
                                       (F.col("id") % 5).cast("double").alias("rating"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        model, out = CL.als(ratings, rank=2, max_iter=1)
        plan = CL.factor_product(out, model)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning") == 2 + 4  # ratings by user and by item; each factor table twice


@pytest.mark.parametrize("user,item", [(-7, 3), (1 << 40, 3), (5, -(1 << 40))])
def test_als_with_large_keys_nulls_and_mixed_ids(spark, user, item):
    """One user and one item hold many of the ratings, ids of one side need numbering; rows without an id are left out."""
    rows = ([(user, item + i, float(i % 5)) for i in range(1500)] + [(user + u, item, float(u % 3)) for u in range(1, 1500)]
            + [(user + u, item + u, 1.0) for u in range(1, 1500)] + [(None, item, 1.0), (user, None, 1.0)])
    model, out = CL.als(spark.createDataFrame(rows, "user_id bigint, item_id bigint, rating double"), rank=2, max_iter=2)
    got = CL.factor_product(out, model).collect()
    assert sorted((r["user_id"], r["item_id"], r["rating"]) for r in got) == sorted(r for r in rows if None not in r)
    assert all(r["is_product"] for r in got)


def test_als_keeps_its_blocks_even_bounded_and_on_disk(spark, monkeypatch):
    """Ids in steps of the number of blocks would all lie in one; more ratings need more blocks; cached blocks
    would take the memory in which others are built."""
    seen, make = [], CL.ALS
    monkeypatch.setattr(CL, "ALS", lambda **given: seen.append(make(**given)) or seen[-1])
    rows = [(u * 3, -6 * i, float((u * i) % 5)) for u in range(200) for i in range(u % 7, 60, 7)]
    ratings = spark.createDataFrame(rows, "user_id bigint, item_id int, rating double")
    for most, blocks in ((CL.ALS_BLOCK_RATINGS, CL.ALS_BLOCKS), (len(rows) // 6 + 1, 6)):
        monkeypatch.setattr(CL, "ALS_BLOCK_RATINGS", most)
        model, out = CL.als(ratings, rank=2, max_iter=2)
        sizes = [r["count"] for r in model.userFactors.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) == blocks and max(sizes) < 1.5 * 200 / blocks
        got = CL.factor_product(out, model)
        assert got.schema["user_id"].dataType.simpleString() == "bigint" and got.schema["item_id"].dataType.simpleString() == "int"
        assert sorted((r["user_id"], r["item_id"], r["rating"]) for r in got.collect()) == sorted(rows)
        assert seen[-1].getIntermediateStorageLevel() == "DISK_ONLY"


def test_mixed_ids_are_one_to_one(spark):
    ids = [-(1 << 31), -7, -1, 0, 1, 2, 65535, 65536, (1 << 31) - 1, *range(1000, 9000, 3)]
    df = spark.createDataFrame([(i,) for i in ids], "k int").select("k", CL._mixed(F.col("k")).alias("m"))
    got = df.select("k", "m", CL._unmixed(F.col("m")).alias("back")).collect()
    assert all(r["k"] == r["back"] for r in got) and len({r["m"] for r in got}) == len(ids)


def test_flags_see_a_wrong_model(spark):
    rows = [(float(i % 2), float(i % 5)) for i in range(40)]
    df = VectorAssembler(inputCols=["label", "z"], outputCol="features").transform(spark.createDataFrame(rows, "label double, z double"))
    good, out = CL.logistic(df, df, reg=0.01)
    other, _ = CL.logistic(df, df, reg=0.3)
    assert out.filter(~CL.follows_linear(good)).count() == 0 < out.filter(~CL.follows_linear(other)).count()
    svc, scored = CL.linear_svc(df, df)
    assert scored.filter(~CL.follows_linear(svc)).count() == 0
    wrong = scored.withColumn("prediction", 1.0 - F.col("prediction"))
    assert wrong.filter(CL.follows_linear(svc)).count() == 0
    km, assigned = CL.kmeans_ml(df, k=2)
    assert assigned.filter(~CL.nearest_centre(assigned, km)).count() == 0
    swapped = assigned.withColumn("prediction", 1 - F.col("prediction"))
    assert swapped.filter(CL.nearest_centre(swapped, km)).count() == 0
    _, trees = CL.tree_models(df, df, "tree")
    assert trees.filter(~CL.follows_votes()).count() == 0
    assert trees.withColumn("prediction", 1.0 - F.col("prediction")).filter(CL.follows_votes()).count() == 0


def test_model_tables(spark):
    df = VectorAssembler(inputCols=["label", "z"], outputCol="features").transform(
        spark.createDataFrame([(float(i % 2), float(i % 5)) for i in range(40)], "label double, z double"))
    model, _ = CL.logistic(df, df, reg=0.01)
    got = {r["feature"]: r["value"] for r in CL.coefficients(model).collect()}
    assert got == pytest.approx({-1: model.intercept, 0: model.coefficients[0], 1: model.coefficients[1]})
    svc, _ = CL.linear_svc(df, df)
    assert CL.coefficients(svc).count() == 3
    km, out = CL.kmeans_ml(df, k=2)
    assert CL.centres(km).count() == 4
    summary = CL.clustering_summary(km, out).first()
    assert summary["cost"] == pytest.approx(km.summary.trainingCost) and -1 <= summary["silhouette"] <= 1


def test_later_parameter_wins(spark):
    df = VectorAssembler(inputCols=["label"], outputCol="features").transform(
        spark.createDataFrame([(float(i % 2),) for i in range(20)], "label double"))
    model, _ = CL.logistic_with_params(df, df, {"maxIter": 7, "threshold": 0.7})
    assert model.getMaxIter() == 7 and model.getThreshold() == 0.7 and model.getRegParam() == 0.01


def test_stray_queue_rows_are_an_error(spark):
    rows = spark.createDataFrame([(0, 1), (1, 2), (None, 3), (7, 4)], "chunk int, v int")
    with pytest.raises(ValueError, match="2 rows"):
        BC.replay_queue(rows, "chunk", 2, scratch_path(spark, "q"), "parquet", lambda: None)


def test_results_of_a_stream_without_batches(spark):
    assert BC.read_batches(spark, scratch_path(spark, "never"), "k int, n bigint").count() == 0


def test_a_stopped_stream_counts_all_that_arrived(spark):
    folder, sink, ckpt = (scratch_path(spark, n) for n in ("in", "out", "ckpt"))
    for i in range(4):
        spark.range(100).select((F.col("id") % 3).alias("k")).write.mode("append").parquet(folder)
    stream = BC.file_stream(spark, folder, "k bigint", files_per_batch=1)
    BC.per_batch_counts(stream, ["k"], sink, ckpt, available_now=False, interval="30 seconds", timeout_s=1)
    assert BC.read_batches(spark, sink, "k bigint, n bigint, batch_id int").agg(F.sum("n")).first()[0] == 400


def test_scratch_belongs_to_the_application(spark):
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and os.path.dirname(a) == os.path.dirname(b) and spark.sparkContext.applicationId in a


def test_scratch_is_gone_when_the_application_ends(tmp_path):
    import subprocess
    import sys

    code = f"""
import sys; sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.abspath(__file__)))!r})
from tessera.session import build_session, scratch_path
s = build_session("local[1]", extra={{"spark.checkpoint.dir": {str(tmp_path)!r}, "spark.driver.memory": "1g"}})
p = scratch_path(s, "t"); s.range(3).write.parquet(p); assert s.read.parquet(p).count() == 3
s.stop()
"""
    subprocess.run([sys.executable, "-c", code], check=True, timeout=120)
    import time

    left = tmp_path / "tessera-scratch"
    for _ in range(100):
        if not any(left.glob("*")):
            return
        time.sleep(0.1)
    raise AssertionError(list(left.rglob("*")))

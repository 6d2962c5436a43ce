import math

import pytest
from pyspark.ml.functions import vector_to_array

from tessera.operators import features as FE
from tessera.operators import stats as S
from tests.conftest import rows


def test_corr_pair_series(spark):
    df = spark.createDataFrame(list(zip([1.0, 2.0, 3.0, 3.0, 5.0], [11.0, 22.0, 33.0, 33.0, 555.0])), "x double, y double")
    assert S.corr_pair(df, "x", "y").first()[0] == pytest.approx(0.850028676877, abs=1e-9)


def test_corr_matrix_vectors(spark):
    df = spark.createDataFrame([(1.0, 10.0, 100.0), (2.0, 20.0, 200.0), (5.0, 33.0, 366.0)], "a double, b double, c double")
    m = {(i, j): r for i, j, r in rows(S.corr_matrix(df, ["a", "b", "c"]), "i", "j", "r")}
    assert m[(0, 1)] == pytest.approx(0.978883, abs=1e-6)
    assert m[(0, 2)] == pytest.approx(0.990390, abs=1e-6)
    assert m[(1, 2)] == pytest.approx(0.997748, abs=1e-6)
    assert m[(2, 1)] == m[(1, 2)] and m[(1, 1)] == 1.0 and len(m) == 9


def test_spearman_matches_average_rank_pearson(spark):
    import pandas as pd
    xs = [1, 2, 2, 3, 7, 7, 7, 9, 4, 4]
    ys = [5, 3, 3, 8, 1, 2, 2, 9, 6, 4]
    df = spark.createDataFrame(list(zip(xs, ys)), "x int, y int")
    want = pd.Series(xs).rank().corr(pd.Series(ys).rank())
    assert S.corr_spearman(df, "x", "y").first()[0] == pytest.approx(want, abs=1e-12)


def test_average_ranks_with_ties(spark):
    df = spark.createDataFrame([(v,) for v in [10, 20, 20, 30, 30, 30]], "v int")
    assert dict(rows(S.average_ranks(df, "v"), "v", "rank")) == {10: 1.0, 20: 2.5, 30: 5.0}


def test_kernel_density_sample(spark):
    sample = [1, 1, 1, 2, 3, 4, 5, 5, 6, 7, 8, 9, 9]
    df = spark.createDataFrame([(float(v),) for v in sample], "x double")
    got = dict(rows(S.kernel_density(df, "x", [-1.0, 2.0, 5.0], 3.0), "point", "density"))
    assert got[-1.0] == pytest.approx(0.041459440233, abs=1e-9)
    assert got[2.0] == pytest.approx(0.079020169331, abs=1e-9)
    assert got[5.0] == pytest.approx(0.089629201273, abs=1e-9)


def test_kernel_density_of_many_points(spark):
    import math

    values = [1.0, 2.0, 2.0, 5.0]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double")
    pts = [p / 2 for p in range(-30, 70)]
    got = dict(rows(S.kernel_density(df, "x", pts, 1.5), "point", "density"))
    want = {p: sum(math.exp(-0.5 * ((p - v) / 1.5) ** 2) for v in values) / (4 * 1.5 * math.sqrt(2 * math.pi)) for p in pts}
    assert got == pytest.approx(want) and len(got) == 100
    with pytest.raises(ValueError):
        S.kernel_density(df, "x", [], 1.0)


def test_mc_ratio_over_range(spark):
    r = S.mc_ratio(spark.range(1, 200001), "id").first()
    assert r["n"] == 200000 and r["estimate"] == pytest.approx(3.14142, abs=1e-5)


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 2.0), (3.0, 2.5)], "y double, p double")
    m = S.regression_metrics(df, "p", "y").first()
    assert m["rmse"] == pytest.approx(math.sqrt(0.5 / 3))
    assert m["r2"] == pytest.approx(1 - 0.5 / 2.0)


def test_sample_k_is_repeatable(spark):
    df = spark.range(0, 1000)
    a = sorted(rows(S.sample_k(df, 7, "id"), "id"))
    assert a == sorted(rows(S.sample_k(df.repartition(5), 7, "id"), "id")) and len(a) == 7


def _vec(spark, data):
    return FE.to_vector(spark.createDataFrame([(i, v) for i, v in enumerate(data)], "id int, arr array<double>"), "arr")


def test_normalize(spark):
    df = _vec(spark, [[3.0, 4.0]])
    l2 = FE.normalize(df, "features", 2.0).select(vector_to_array("normed")).first()[0]
    linf = FE.normalize(df, "features", float("inf")).select(vector_to_array("normed")).first()[0]
    assert l2 == pytest.approx([0.6, 0.8]) and linf == pytest.approx([0.75, 1.0])


def test_standardize_centered_uses_sample_std(spark):
    df = _vec(spark, [[3.0, 4.0], [0.0, 1.0]])
    out = FE.standardize(df, "features", with_mean=True).orderBy("id").select(vector_to_array("scaled")).collect()
    assert out[0][0] == pytest.approx([0.70710678, 0.70710678]) and out[1][0] == pytest.approx([-0.70710678, -0.70710678])


def test_string_index_most_frequent_first_then_alphabetical(spark):
    df = spark.createDataFrame([(x,) for x in ["b", "a", "c", "c", "b", "d"]], "s string")
    out, model = FE.string_index(df, "s")
    assert list(model.labels) == ["b", "c", "a", "d"]
    back = FE.index_to_string(out, "idx", list(model.labels))
    assert all(r["s"] == r["label"] for r in back.collect())


def test_vector_index_marks_low_cardinality_features(spark):
    df = _vec(spark, [[0.0, 1.5], [13.0, 2.5], [17.0, 3.5], [13.0, 4.5], [0.0, 5.5], [17.0, 6.5]])
    out, model = FE.vector_index(df, "features", 4)
    assert set(model.categoryMaps) == {0}
    got = [r[0] for r in out.orderBy("id").select(vector_to_array("indexed")[0]).collect()]
    assert got == [0.0, 1.0, 2.0, 1.0, 0.0, 2.0]


def test_tokenizer_term_counts(spark):
    df = spark.createDataFrame([(1, "Hi  hi\tthere \n")], "id int, text string")
    assert dict(rows(FE.term_counts(df, "id", "text"), "term", "n")) == {"hi": 2, "there": 1, "": 1}


def test_native_tokens_equal_ml_tokenizer(spark):
    from tessera.functions.text import tokens_of
    texts = ["Hi  hi\tthere \n", "   ", "", "\nLead and\u000bmid", "ÄÉÑ sind Straße"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    ml = {r["id"]: r["tokens"] for r in FE.tokenize(df, "text").collect()}
    native = {r["id"]: r["t"] for r in df.select("id", tokens_of("text").alias("t")).collect()}
    assert ml == native


def test_spearman_equals_library_spearman_on_a_table(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import Correlation
    from tessera.sources.tables import table
    from tests.conftest import SF_SMALL
    li = table(spark, SF_SMALL, "lineitem", "l_quantity", "l_tax")
    ours = S.corr_spearman(li, "l_quantity", "l_tax").first()[0]
    vec = VectorAssembler(inputCols=["l_quantity", "l_tax"], outputCol="v").transform(li)
    lib = Correlation.corr(vec, "v", "spearman").first()[0].toArray()[0][1]
    assert ours == pytest.approx(lib, abs=1e-9)

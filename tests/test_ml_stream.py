import pytest
from pyspark.sql import functions as F

from tessera.operators import classify as CL
from tessera.session import scratch_path
from tessera.streaming import batch_counts as BC
from tests.conftest import SF_SMALL

BASKETS = ["r z h k p", "z y x w v u t s", "s x o n r", "x z y m t s q e", "z", "x z y r q t p"]


def baskets(spark):
    return spark.createDataFrame([(b,) for b in BASKETS], "line string").select(F.split("line", " ").alias("items"))


def test_fpgrowth_low_support(spark):
    sets = CL.freq_itemsets(baskets(spark), "items", 0.2).collect()
    sizes = {}
    for r in sets:
        sizes[len(r["items"])] = sizes.get(len(r["items"]), 0) + 1
    assert len(sets) == 54 and sizes == {1: 8, 2: 18, 3: 17, 4: 9, 5: 2}


def test_fpgrowth_high_support_and_repeated_items(spark):
    df = baskets(spark).withColumn("items", F.concat("items", F.slice("items", 1, 1)))  # a repeated item is tolerated
    sets = [(sorted(r["items"]), r["freq"]) for r in CL.freq_itemsets(df, "items", 0.8).collect()]
    assert sets == [(["z"], 5)]


def test_queue_stream_counts_each_batch_alone(spark):
    """Five queued batches of 1..1000, keyed by x % 10: 100 per key in every batch."""
    folder, sink, ckpt = (scratch_path(spark, n) for n in ("queue-in", "queue-out", "queue-ckpt"))
    batches = spark.range(0, 5).select(F.col("id").cast("int").alias("chunk")) \
        .select("chunk", F.explode(F.sequence(F.lit(1), F.lit(1000))).alias("x"))

    def trigger():
        stream = BC.file_stream(spark, folder, "x int, chunk int")
        BC.per_batch_counts(stream.select("chunk", F.pmod("x", F.lit(10)).alias("key")), ["chunk", "key"], sink,
                            ckpt, timeout_s=120)

    BC.replay_queue(batches, "chunk", 5, folder, "parquet", trigger)
    out = BC.read_batches(spark, sink, "chunk int, key int, n bigint, batch_id int").collect()
    assert len(out) == 50 and {r["n"] for r in out} == {100}
    per_batch = {}
    for r in out:
        per_batch.setdefault(r["batch_id"], set()).add(r["chunk"])
    assert len(per_batch) == 5 and all(len(c) == 1 for c in per_batch.values())  # no state across batches


def test_bounded_processing_time_run_stops(spark):
    folder, sink, ckpt = (scratch_path(spark, n) for n in ("tick-in", "tick-out", "tick-ckpt"))
    spark.range(0, 100).select((F.col("id") % 3).alias("k")).write.parquet(folder)
    q = BC.per_batch_counts(BC.file_stream(spark, folder, "k bigint"), ["k"], sink, ckpt, available_now=False,
                            interval="1 second", timeout_s=6)
    assert not q.isActive
    got = {r["k"]: r["n"] for r in BC.read_batches(spark, sink, "k bigint, n bigint, batch_id int").collect()}
    assert got == {0: 34, 1: 33, 2: 33}


def test_letter_models_beat_majority(spark):
    from tessera.plans import ml
    train, test = ml._split(ml.letter_docs(spark, SF_SMALL))
    base = test.agg(F.avg("label")).first()[0]
    for fit in (CL.logistic, CL.linear_svc):
        assert CL.accuracy(fit(train, test)[1]) >= max(base, 1 - base)
    assert all(r["follows"] and r["beats_majority"] for r in ml.logreg_binomial(spark, SF_SMALL).collect())


def test_saved_model_predicts_the_same(spark):
    from tessera.plans import ml
    out = ml.model_save_load(spark, SF_SMALL).collect()
    assert out and all(r["same_prediction"] for r in out)


def test_als_fits_known_pairs(spark):
    from tessera.plans import ml
    _, out = CL.als(ml.nation_ratings(spark, SF_SMALL), rank=10, max_iter=5, reg=0.01, seed=42)
    assert out.count() > 0 and CL.rmse(out) < 0.35


def test_train_test_split_both_ways(spark):
    df = spark.range(0, 1000)
    tr, te = CL.train_test_split(df, id_col="id")
    assert (tr.count(), te.count()) == (700, 300)
    a, b = CL.train_test_split(df, seed=7)
    a2, _ = CL.train_test_split(df, seed=7)
    assert a.count() + b.count() == 1000 and sorted(r[0] for r in a.collect()) == sorted(r[0] for r in a2.collect())


def test_stream_counts_equal_batch_counts(spark):
    from tessera.plans import streaming as PS
    from tessera.sources.tables import table
    got = sorted(rows_of(PS.stream_queue_counts(spark, SF_SMALL)))
    ev = table(spark, SF_SMALL, "events", "event_id", "user_id")
    want = ev.groupBy(F.pmod("event_id", F.lit(5)).cast("int").alias("chunk"),
                      F.pmod("user_id", F.lit(10)).alias("key")).count()
    assert got == sorted(rows_of(want.withColumnRenamed("count", "n")))


def rows_of(df):
    return [(r["chunk"], r["key"], r["n"]) for r in df.collect()]


def test_als_ratings_fit_known_pairs_far_better_than_the_mean(spark):
    from tessera.operators import stats as S
    from tessera.plans import ml
    _, out = CL.als(ml.quantity_ratings(spark, SF_SMALL), rank=10, max_iter=10, reg=0.01, seed=42)
    m = S.regression_metrics(out, "prediction", "rating").first()
    assert m["n"] > 0 and m["r2"] > 0.5


@pytest.mark.parametrize("key,iterations", [("als_ratings", 10), ("als_dense", 5)])
def test_als_keys_keep_their_iterations(spark, monkeypatch, key, iterations):
    from tessera.plans import ml
    seen, fit = [], CL.als
    monkeypatch.setattr(CL, "als", lambda *args, **given: seen.append(given["max_iter"]) or fit(*args, **given))
    assert all(r["fits"] and r["is_product"] for r in getattr(ml, key)(spark, SF_SMALL).collect())
    assert seen == [iterations]

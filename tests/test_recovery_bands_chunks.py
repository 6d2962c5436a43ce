"""Recovery of a stream from a lost batch, the band join of the kernel density, lists in chunks and
label dictionaries."""

import math
import random
import threading

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tessera.operators import features as FE
from tessera.operators import relational as R
from tessera.operators import stats as S
from tessera.session import scratch_path
from tessera.streaming import batch_counts as BC

SCHEMA = "k bigint, n bigint, batch_id int"


def start(spark, folder, sink, ckpt):
    stream = BC.file_stream(spark, folder, "k bigint", files_per_batch=1)
    return BC.per_batch_counts(stream, ["k"], sink, ckpt, timeout_s=300)


def staged(spark, batches=3):
    folder, sink, ckpt = (scratch_path(spark, n) for n in ("recover-in", "recover-out", "recover-ckpt"))
    for i in range(batches):
        spark.range(100 * (i + 1)).select((F.col("id") % 4).alias("k")).coalesce(1).write.mode("append").parquet(folder)
    return folder, sink, ckpt


def totals(spark, sink):
    return {r["k"]: r["n"] for r in BC.read_batches(spark, sink, SCHEMA).groupBy("k").agg(F.sum("n").alias("n")).collect()}


def test_a_batch_killed_in_progress_is_counted_once(spark, monkeypatch):
    """The second batch dies after some of its files are written; readers never see them, and the
    restarted stream counts the batch again from its start."""
    folder, sink, ckpt = staged(spark)
    whole = BC.write_batch

    def dies(counts, sink_, batch_id):
        whole(counts, sink_, batch_id)
        if batch_id == 1:
            raise RuntimeError("executor lost")

    monkeypatch.setattr(BC, "write_batch", dies)
    with pytest.raises(StreamingQueryException):
        start(spark, folder, sink, ckpt)
    assert BC.committed_batches(spark, sink) == {0}
    seen = BC.read_batches(spark, sink, SCHEMA).agg(F.sum("n")).first()[0]
    assert seen in (100, 200, 300)  # one file: the files' order is the source's
    # what a lost task leaves: a stray file in the folder of the lost batch
    spark.createDataFrame([(0, 999)], "k bigint, n bigint").write.mode("append").parquet(f"{sink}/batch_id=1")
    monkeypatch.setattr(BC, "write_batch", whole)
    start(spark, folder, sink, ckpt)
    assert BC.committed_batches(spark, sink) == {0, 1, 2}
    assert totals(spark, sink) == {k: 150 for k in range(4)}


def test_a_stream_stopped_in_a_batch_goes_on_where_it_was(spark, monkeypatch):
    folder, sink, ckpt = staged(spark)
    inside, whole = threading.Event(), BC.write_batch

    def slow(counts, sink_, batch_id):
        whole(counts, sink_, batch_id)
        if batch_id == 1:
            inside.set()
            threading.Event().wait(3)

    monkeypatch.setattr(BC, "write_batch", slow)

    def stop():
        inside.wait(200)
        for q in spark.streams.active:
            q.stop()

    stopper = threading.Thread(target=stop)
    stopper.start()
    try:
        start(spark, folder, sink, ckpt)
    except StreamingQueryException:
        pass
    stopper.join()
    monkeypatch.setattr(BC, "write_batch", whole)
    start(spark, folder, sink, ckpt)
    assert totals(spark, sink) == {k: 150 for k in range(4)}


def test_a_committed_batch_is_not_written_again(spark, monkeypatch):
    folder, sink, ckpt = staged(spark, 1)
    start(spark, folder, sink, ckpt)
    monkeypatch.setattr(BC, "write_batch", lambda *a: pytest.fail("written again"))
    start(spark, folder, sink, scratch_path(spark, "recover-other"))  # a lost checkpoint replays all
    assert totals(spark, sink) == {k: 25 for k in range(4)}


def test_density_at_a_table_of_points(spark):
    rng = random.Random(1)
    values = [rng.gauss(0, 3) for _ in range(800)] + [2.0] * 700
    points = [rng.uniform(-12, 12) for _ in range(60)] + [500.0, 2.0, 2.0]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double").repartition(3)
    at = spark.createDataFrame([(p,) for p in points] + [(None,)], "p double")
    rows = S.kernel_density_at(df, "x", at, "p", 0.7, tail=1e-6).collect()
    assert len(rows) == len(set(points))
    for r in rows:
        exact = sum(math.exp(-0.5 * ((r["point"] - v) / 0.7) ** 2) for v in values) / (len(values) * 0.7 * math.sqrt(2 * math.pi))
        assert exact - r["error_bound"] <= r["density"] + 1e-15 and r["density"] <= exact + 1e-12
    assert {r["density"] for r in rows if r["point"] == 500.0} == {0.0}
    plan = S.kernel_density_at(df, "x", at, "p", 0.7)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert S.kernel_density_at(df.filter(F.lit(False)), "x", at, "p", 1.0).count() == 0


def test_lists_in_chunks(spark):
    rng = random.Random(2)
    rows = [("hot", i % 900) for i in range(3000)] + [(f"k{i % 40}", rng.randint(0, 9)) for i in range(500)] + [(None, 1), (None, 1), ("n", None)]
    df = spark.createDataFrame(rows, "k string, v int").repartition(4)
    out = R.group_list_chunks(df, "k", "v", 50, scratch_path(spark, "chunks")).collect()
    got = {}
    for r in sorted(out, key=lambda r: (r["k"] or "", r["chunk"])):
        assert 0 < len(r["values"]) <= 50 and len(r["values"]) == len(r["counts"])
        assert r["chunk"] == sum(o["k"] == r["k"] and o["chunk"] < r["chunk"] for o in out)
        got.setdefault(r["k"], []).extend(zip(r["values"], r["counts"]))
    want = {}
    for k in {k for k, _ in rows}:
        mine = [v for a, v in rows if a == k]
        want[k] = [(v, mine.count(v)) for v in sorted(set(mine), key=lambda v: (v is not None, v))]
    assert {k: v for k, v in got.items() if k != "n"} == {k: v for k, v in want.items() if k != "n"}
    assert got["n"] == [(None, 1)] and sum(r["k"] == "hot" for r in out) >= 18


def test_label_dictionary_agrees_with_the_indexer(spark):
    rng = random.Random(6)
    labels = ["hot"] * 900 + [f"v{rng.randint(0, 60):02d}" for _ in range(700)] + [None, "", "é"]
    df = spark.createDataFrame(list(enumerate(labels)), "id int, s string").repartition(3).cache()
    words = FE.label_dictionary(df, "s", scratch_path(spark, "dictionary"))
    model = FE.string_index(df.dropna(), "s")[1]
    assert [r["label"] for r in words.orderBy("idx").collect()] == list(model.labels)
    indexed = FE.index_by_dictionary(df, "s", words).cache()
    back = FE.labels_by_dictionary(indexed, "idx", words, "again").collect()
    assert len(back) == len(labels) - 1 and all(r["s"] == r["again"] for r in back)
    assert FE.labels_by_dictionary(spark.createDataFrame([(99999.0,)], "idx double"), "idx", words).count() == 0

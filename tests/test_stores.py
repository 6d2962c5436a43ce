"""Sorted tables with a manifest, bucketed tables, and readers with a reject channel."""

import random

import pytest

from tessera.operators.sorted_store import open_sorted, order_by, write_sorted
from tessera.session import scratch_path
from tessera.sources import catalog as C
from tessera.sources import files as FS


@pytest.fixture(scope="module", autouse=True)
def several_files(spark):
    """Small sorts would be written by one task."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.fixture(scope="module")
def numbers(spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, 1, 2, 3, 5, 8]), rng.choice("abcde"), i) for i in range(4000)]
    return rows, spark.createDataFrame(rows, "n int, word string, id long").repartition(4)


@pytest.mark.parametrize("order", [("n", "id"), ("-n", "word", "id"), ("word", "-n", "-id")])
def test_sorted_store_keeps_the_order_and_places(spark, numbers, order):
    rows, df = numbers
    store = write_sorted(df, order_by(*order), scratch_path(spark, "sorted"))
    want = rows
    for c in reversed(order):  # stable sorts from the last column on; nulls are the smallest
        at = ("n", "word", "id").index(c.lstrip("-"))
        want = sorted(want, key=lambda r: (r[at] is not None, r[at] or 0 if at != 1 else r[at]), reverse=c[0] == "-")
    assert len(store.manifest) > 1 and store.is_ordered() and sum(f["n"] for f in store.manifest) == 4000
    got = {r["pos"]: (r["n"], r["word"], r["id"]) for r in store.read("pos").collect()}
    assert [got[i + 1] for i in range(4000)] == want
    assert [tuple(r) for b in store.batches() for r in b.collect()] == want
    assert all(r["ordered"] for r in store.rows_in_order().collect())
    plan = store.read("pos")._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Exchange hashpartitioning" not in plan


def test_manifest_out_of_order_is_noticed(spark, numbers):
    _, df = numbers
    path = scratch_path(spark, "unsorted")
    df.write.parquet(path)
    store = open_sorted(spark, path, order_by("n", "id"))
    assert not store.is_ordered() and not all(r["ordered"] for r in store.rows_in_order().collect())


def test_a_range_of_keys_reads_few_files(spark):
    store = write_sorted(spark.range(0, 100_000, 1, 6).selectExpr("(id * 7919) % 100000 AS k", "id"), order_by("-k"), scratch_path(spark, "zones"))
    df = store.between(500, 600)
    assert sorted(r["k"] for r in df.collect()) == list(range(500, 601))
    assert len(df.inputFiles()) < len(store.manifest)
    assert store.between(200_000, 300_000).count() == 0


def test_empty_table_is_sorted(spark):
    store = write_sorted(spark.createDataFrame([], "k int"), order_by("k"), scratch_path(spark, "empty"))
    assert store.manifest == [] and store.is_ordered() and store.read("pos").count() == 0


def exchanges_above(node, name):
    """Whether an exchange lies between the root and each scan of ``name``."""
    out, todo = [], [(node, False)]
    while todo:
        n, seen = todo.pop()
        text = n.nodeName()
        children = [n.children().apply(i) for i in range(n.children().size())]
        if "Scan" in text and name in n.toString():
            out.append(seen)
        todo += [(c, seen or "Exchange" in text) for c in children]
    return out


def test_bucketed_join_shuffles_the_other_side_only(spark):
    rows = spark.range(0, 5000).selectExpr("id AS key", "id % 7 AS value").repartition(3)
    name = C.store_bucketed(rows, "src_bucketed_test", ["key"], scratch_path(spark, "bucketed"))
    other = spark.range(0, 9000).selectExpr("id % 6000 AS key").groupBy("key").count()
    joined = other.join(spark.table(name).hint("merge"), "key")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = joined._jdf.queryExecution().executedPlan()
        assert exchanges_above(plan, name) == [False] and "SortMergeJoin" in plan.toString()
        stored_side = plan.toString().split("SortMergeJoin", 1)[1]
        assert stored_side.count("Exchange") == 1  # the aggregate's, on the other side
        both = spark.table(name).join(spark.table(name).withColumnRenamed("value", "v"), "key")
        assert "Exchange" not in both.hint("merge")._jdf.queryExecution().executedPlan().toString().replace("BroadcastExchange", "")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert joined.count() == 5000
    spark.sql(f"DROP TABLE {name}")


def test_tables_without_their_folder_are_dropped(spark):
    path = scratch_path(spark, "gone")
    C.store_bucketed(spark.range(5).toDF("key"), "src_gone_test", ["key"], path, buckets=2)
    C.store_bucketed(spark.range(5).toDF("key"), "src_here_test", ["key"], scratch_path(spark, "here"), buckets=2)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    assert "src_gone_test" in C.drop_tables(spark, "src_")
    assert spark.catalog.tableExists("src_here_test") and not spark.catalog.tableExists("src_gone_test")
    spark.sql("DROP TABLE src_here_test")


def lines(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_delimited_rejects(spark):
    texts = ["1::2::3.5", "1::2", "x::2::3", "1::2::3::4", "  7:: ::2 ", "", None, "::5::1", "1::2::nine"]
    c = FS.check_delimited(lines(spark, texts), "::", [("u", "bigint"), ("i", "bigint"), ("r", "double")],
                           scratch_path(spark, "checked"), required=("u",))
    assert {tuple(r) for r in c.good.collect()} == {(1, 2, 3.5), (7, None, 2.0)}
    assert {tuple(r) for r in c.rejects.collect()} == {
        ("1::2", "fields: 2 of 3"), ("x::2::3", "u: not a bigint"), ("1::2::3::4", "fields: 4 of 3"), ("", "fields: 1 of 3"),
        (None, "no line"), ("::5::1", "u: missing"), ("1::2::nine", "r: not a double")}


def test_json_rejects(spark):
    texts = ['{"a": 1, "b": "x"}', '{"a": "no", "b": "x"}', '{"a": 1', "[1,2]", '{"b": 3}', "", None, '{"a": null, "b": "z"}',
             '{"a": 1.5, "b": "y"}', "7", '{"a": 2}']
    c = FS.check_json(lines(spark, texts), "a bigint, b string", scratch_path(spark, "checked"), required=("b",))
    assert {tuple(r) for r in c.good.collect()} == {(1, "x"), (None, "3"), (None, "z")}
    reasons = {r["line"]: r["reason"] for r in c.rejects.collect()}
    assert reasons == {'{"a": "no", "b": "x"}': "a: not a bigint", '{"a": 1': "not JSON", "[1,2]": "not JSON", "": "not JSON",
                       None: "no line", '{"a": 1.5, "b": "y"}': "a: not a bigint", "7": "not JSON", '{"a": 2}': "b: missing"}


def test_csv_rejects(spark):
    path = scratch_path(spark, "csv")
    lines(spark, ["a,b,c", "1,x,2.5", "2,y", "3,z,1.0,9", "q,w,1", "5,,2", '6,"a,b",3', ",k,1"]).coalesce(1).write.text(path)
    c = FS.check_csv(spark, path, "a bigint, b string, c double", scratch_path(spark, "checked"), required=("a",))
    assert {tuple(r) for r in c.good.collect()} == {(1, "x", 2.5), (5, None, 2.0), (6, "a,b", 3.0)}
    assert {tuple(r) for r in c.rejects.collect()} == {("2,y", "fields"), ("3,z,1.0,9", "fields"), ("q,w,1", "a: not a bigint"),
                                                       (",k,1", "a: missing")}

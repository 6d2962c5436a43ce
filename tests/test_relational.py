from pyspark.sql import functions as F

from tessera.operators import relational as R
from tessera.operators.sorting import ordered_cumsum, with_position
from tests.conftest import rows

PEOPLE = [(None, "Michael"), (30, "Andy"), (19, "Justin")]


def people(spark):
    return spark.createDataFrame(PEOPLE, "age long, name string")


def test_kv_filter_pairs(spark):
    kv = spark.createDataFrame([(1, 4), (2, 5), (3, 6), (4, 7)], "k int, v int")
    assert sorted(rows(R.kv_filter(kv, "k", 2), "k", "v")) == [(3, 6), (4, 7)]


def test_people_filter_group_and_computed(spark):
    p = people(spark)
    assert rows(R.filter_gt(p, "age", 21), "age", "name") == [(30, "Andy")]
    assert sorted(rows(R.group_count(p, "age"), "age", "n"), key=lambda r: (r[0] is not None, r[0])) == \
        [(None, 1), (19, 1), (30, 1)]
    got = dict(rows(R.computed_col(p, "age", 1, "age1"), "name", "age1"))
    assert got == {"Michael": None, "Andy": 31, "Justin": 20}
    assert rows(R.filter_range(p, "age", 13, 19), "name") == [("Justin",)]


def test_filter_odd_uses_floor_mod(spark):
    df = spark.createDataFrame([(-3,), (-2,), (5,), (0,)], "x int")
    assert sorted(rows(R.filter_odd(df, "x"), "x")) == [(-3,), (5,)]


def test_map_and_flatmap(spark):
    df = spark.createDataFrame([(3,), (100000,)], "x int")
    assert sorted(rows(R.map_square(df, "x"), "x", "sq")) == [(3, 9), (100000, 10**10)]
    got = sorted(rows(R.flatmap_triple(df.filter("x = 3"), "x"), "k", "v"))
    assert got == [(0, 3), (1, 300), (2, 9)]


def test_sort_composite_with_positions(spark):
    t = spark.createDataFrame([(1, 6, 3), (2, 3, 3), (1, 1, 2), (1, 3, 5), (2, 1, 2)], "a int, b int, c int")
    got = rows(with_position(t, ["a", "c", "b"]).orderBy("pos"), "pos", "a", "b", "c")
    assert got == [(1, 1, 1, 2), (2, 1, 6, 3), (3, 1, 3, 5), (4, 2, 1, 2), (5, 2, 3, 3)]


def test_positions_span_many_partitions(spark):
    df = spark.range(0, 5000, 1, 7).select(((F.col("id") * 7919) % 5000).alias("v"))
    got = rows(with_position(df, ["v"]), "pos", "v")
    assert sorted(got) == [(i + 1, i) for i in range(5000)]


def test_weighted_running_sum(spark):
    df = spark.createDataFrame([(3, 2), (1, 5), (2, 1)], "v int, w bigint")
    got = rows(ordered_cumsum(df, ["v"], "w", "cum").orderBy("v"), "v", "cum")
    assert got == [(1, 5), (2, 6), (3, 8)]


def test_group_lists_collapse_repeats(spark):
    df = spark.createDataFrame([(1, 2), (1, 2), (1, 1), (2, 5)] + [(3, 7)] * 1000, "k int, v int")
    assert dict(rows(R.group_lists(df, "k", "v"), "k", "items")) == {1: "1x1,2x2", 2: "5x1", 3: "7x1000"}
    halves = spark.createDataFrame([(1, 2.5), (1, 10.0)], "k int, v double")
    assert rows(R.group_lists(halves, "k", "v"), "items") == [("2.5x1,10.0x1",)]  # numeric order


def test_union_keeps_duplicates_and_distinct_removes(spark):
    a = spark.createDataFrame([(1,), (2,)], "v int")
    b = spark.createDataFrame([(2,), (3,)], "v int")
    assert sorted(rows(R.union_bag(a, b), "v")) == [(1,), (2,), (2,), (3,)]
    assert sorted(rows(R.distinct_vals(R.union_bag(a, b), "v"), "v")) == [(1,), (2,), (3,)]
    mm = R.min_max(R.union_bag(a, b), "v").first()
    assert (mm["min_v"], mm["max_v"]) == (1, 3)


def test_spread_only_touches_plain_scans(spark):
    from tessera.session import spread
    base = spark.range(0, 100, 1, 1)
    assert spread(base) is not base and spread(base).rdd.getNumPartitions() >= 2
    agg = base.groupBy((F.col("id") % 3).alias("k")).count()
    assert spread(agg) is agg  # shuffled input: left alone, and nothing was run to decide
    wide = spark.range(0, 100, 1, 64)
    assert spread(wide) is wide

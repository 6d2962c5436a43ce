"""Relational keys over customer / orders / part / lineitem / supplier."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import relational as R
from tessera.operators.sorted_store import order_by, write_sorted
from tessera.plans.registry import register
from tessera.session import scratch_path
from tessera.sources.tables import table

# Predicate bounds used by the keys below.
ORDERS_GT = 15
ORDERS_LO, ORDERS_HI = 13, 19
QTY_LT = 10
KEY_GT = 2
# Meaning of each return flag (the inline table of ``inline_rows``).
FLAG_MEANING = [("A", "accepted"), ("N", "none"), ("R", "returned")]

ACTIVITY_SQL = """
  SELECT c_custkey, c_name, o.n_orders
  FROM customer LEFT JOIN (SELECT o_custkey, CAST(count(*) AS BIGINT) AS n_orders
                           FROM orders GROUP BY o_custkey) o ON c_custkey = o.o_custkey"""


def activity(spark, sf):
    """``(c_custkey, c_name, n_orders)``; ``n_orders`` is null for customers
    without orders -- the nullable "age" of the people examples."""
    per_cust = (table(spark, sf, "orders", "o_custkey").groupBy("o_custkey")
                .agg(F.count(F.lit(1)).alias("n_orders")))
    cust = table(spark, sf, "customer", "c_custkey", "c_name")
    return (cust.join(per_cust, cust.c_custkey == per_cust.o_custkey, "left")
            .select("c_custkey", "c_name", "n_orders"))


@register("select_cols", sql="SELECT c_custkey, c_name, c_mktsegment FROM customer")
def select_cols(spark, sf):
    return R.select_cols(table(spark, sf, "customer"), "c_custkey", "c_name", "c_mktsegment")


@register("computed_col", sql=f"""
  SELECT c_name, n_orders + 1 AS n_orders_next FROM ({ACTIVITY_SQL}) a""")
def computed_col(spark, sf):
    return R.computed_col(activity(spark, sf), "n_orders", 1, "n_orders_next").select("c_name", "n_orders_next")


@register("filter_gt", sql=f"SELECT c_custkey, c_name, n_orders FROM ({ACTIVITY_SQL}) a WHERE n_orders > {ORDERS_GT}")
def filter_gt(spark, sf):
    return R.filter_gt(activity(spark, sf), "n_orders", ORDERS_GT)


@register("filter_range", sql=f"""
  SELECT c_name FROM ({ACTIVITY_SQL}) a WHERE n_orders BETWEEN {ORDERS_LO} AND {ORDERS_HI}""")
def filter_range(spark, sf):
    view = f"activity_{abs(hash(sf)) % 10**8}"
    activity(spark, sf).createOrReplaceTempView(view)
    return spark.sql(f"SELECT c_name FROM {view} WHERE n_orders BETWEEN {ORDERS_LO} AND {ORDERS_HI}")


@register("group_count", sql=f"""
  SELECT n_orders, CAST(count(*) AS BIGINT) AS n FROM ({ACTIVITY_SQL}) a GROUP BY n_orders""")
def group_count(spark, sf):
    return R.group_count(activity(spark, sf), "n_orders")


def sorted_rows(df, *order):
    """``df`` as a sorted table; ``pos`` is each row's place in it, from the manifest. A
    manifest out of order fails the key."""
    store = write_sorted(df, order_by(*order), scratch_path(df.sparkSession, "sorted"))
    if not store.is_ordered():
        raise RuntimeError(f"files out of order in {store.path}")
    return store.read("pos")


@register("filter_order", sql=f"""
  SELECT CAST(row_number() OVER (ORDER BY l_quantity, l_orderkey, l_linenumber) AS BIGINT) AS pos,
         l_quantity, l_orderkey, l_linenumber
  FROM lineitem WHERE l_quantity < {QTY_LT}""")
def filter_order(spark, sf):
    li = table(spark, sf, "lineitem", "l_quantity", "l_orderkey", "l_linenumber")
    return sorted_rows(li.filter(F.col("l_quantity") < QTY_LT), "l_quantity", "l_orderkey", "l_linenumber") \
        .select("pos", "l_quantity", "l_orderkey", "l_linenumber")


@register("map_square", sql="SELECT p_partkey, p_size, CAST(p_size AS BIGINT) * p_size AS sq FROM part")
def map_square(spark, sf):
    return R.map_square(table(spark, sf, "part", "p_partkey", "p_size"), "p_size")


@register("flatmap_triple", sql="""
  SELECT p_partkey, CAST(UNNEST([0, 1, 2]) AS INTEGER) AS k,
         UNNEST([CAST(p_size AS BIGINT), 100 * CAST(p_size AS BIGINT), CAST(p_size AS BIGINT) * p_size]) AS v
  FROM part""")
def flatmap_triple(spark, sf):
    return R.flatmap_triple(table(spark, sf, "part", "p_partkey", "p_size"), "p_size", keep=("p_partkey",))


@register("filter_odd", sql="SELECT p_partkey, p_size FROM part WHERE p_size % 2 = 1")
def filter_odd(spark, sf):
    return R.filter_odd(table(spark, sf, "part", "p_partkey", "p_size"), "p_size")


@register("distinct_vals", sql="SELECT DISTINCT l_quantity FROM lineitem")
def distinct_vals(spark, sf):
    return R.distinct_vals(table(spark, sf, "lineitem"), "l_quantity")


@register("min_max", sql="SELECT min(l_extendedprice) AS min_v, max(l_extendedprice) AS max_v FROM lineitem")
def min_max(spark, sf):
    return R.min_max(table(spark, sf, "lineitem"), "l_extendedprice")


@register("union_bag", sql="""
  SELECT c_nationkey AS nationkey FROM customer UNION ALL SELECT s_nationkey FROM supplier""")
def union_bag(spark, sf):
    a = table(spark, sf, "customer").select(F.col("c_nationkey").alias("nationkey"))
    b = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("nationkey"))
    return R.union_bag(a, b)


@register("kv_keys", sql="SELECT l_orderkey FROM lineitem")
def kv_keys(spark, sf):
    return table(spark, sf, "lineitem", "l_orderkey", "l_quantity").select("l_orderkey")


@register("kv_values", sql="SELECT l_quantity FROM lineitem")
def kv_values(spark, sf):
    return table(spark, sf, "lineitem", "l_orderkey", "l_quantity").select("l_quantity")


@register("kv_filter", sql=f"SELECT l_orderkey, l_quantity FROM lineitem WHERE l_orderkey > {KEY_GT}")
def kv_filter(spark, sf):
    return R.kv_filter(table(spark, sf, "lineitem", "l_orderkey", "l_quantity"), "l_orderkey", KEY_GT)


@register("sum_by_key", sql="SELECT l_orderkey, sum(l_quantity) AS total FROM lineitem GROUP BY l_orderkey")
def sum_by_key(spark, sf):
    return R.sum_by_key(table(spark, sf, "lineitem", "l_orderkey", "l_quantity"), "l_orderkey", "l_quantity")


@register("group_lists", sql="""
  SELECT l_orderkey, string_agg(CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || 'x' || CAST(c AS VARCHAR), ','
                                ORDER BY l_quantity) AS items
  FROM (SELECT l_orderkey, l_quantity, count(*) AS c FROM lineitem GROUP BY 1, 2) p
  GROUP BY l_orderkey""")
def group_lists(spark, sf):
    li = table(spark, sf, "lineitem", "l_orderkey", "l_quantity")  # quantities are whole units
    return R.group_lists(li.withColumn("l_quantity", F.col("l_quantity").cast("bigint")), "l_orderkey", "l_quantity") \
        .select("l_orderkey", "items")


#: Entries of a list chunk.
CHUNK = 100


@register("group_list_chunks", sql=f"""
  WITH p AS (SELECT l_returnflag, l_partkey, count(*) AS c FROM lineitem GROUP BY 1, 2),
  b AS (SELECT *, (row_number() OVER (ORDER BY l_returnflag, l_partkey) - 1) // {CHUNK} AS block FROM p)
  SELECT l_returnflag, CAST(block - min(min(block)) OVER (PARTITION BY l_returnflag) AS BIGINT) AS chunk,
         string_agg(l_partkey || 'x' || c, ',' ORDER BY l_partkey) AS items
  FROM b GROUP BY l_returnflag, block""")
def group_list_chunks(spark, sf):
    """Three hot keys with very many distinct values each, in lists of at most CHUNK."""
    li = table(spark, sf, "lineitem", "l_returnflag", "l_partkey")
    chunks = R.group_list_chunks(li, "l_returnflag", "l_partkey", CHUNK, scratch_path(spark, "chunks"))
    items = F.zip_with("values", "counts", lambda v, c: F.concat(v.cast("string"), F.lit("x"), c.cast("string")))
    return chunks.select("l_returnflag", "chunk", F.concat_ws(",", items).alias("items"))


@register("group_struct_list", sql="""
  SELECT l_orderkey, string_agg(l_returnflag || ':' || CAST(n AS VARCHAR) || ':' || CAST(total AS VARCHAR), ';'
                                ORDER BY l_returnflag) AS summary
  FROM (SELECT l_orderkey, l_returnflag, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS total
        FROM lineitem GROUP BY 1, 2) p
  GROUP BY l_orderkey""")
def group_struct_list(spark, sf):
    li = table(spark, sf, "lineitem", "l_orderkey", "l_returnflag", "l_quantity") \
        .withColumn("qty", F.col("l_quantity").cast("bigint"))
    return R.group_struct_list(li, "l_orderkey", "l_returnflag", "qty").select("l_orderkey", "summary")


@register("sort_ints", sql="""
  SELECT CAST(row_number() OVER (ORDER BY p_size, p_partkey) AS BIGINT) AS pos, p_size, p_partkey FROM part""")
def sort_ints(spark, sf):
    """The key breaks ties: equal sizes alone could not be spread over partitions."""
    return sorted_rows(table(spark, sf, "part", "p_size", "p_partkey"), "p_size", "p_partkey") \
        .select("pos", "p_size", "p_partkey")


@register("sort_composite", sql="""
  SELECT CAST(row_number() OVER (ORDER BY p_size, p_retailprice, p_partkey) AS BIGINT) AS pos,
         p_size, p_retailprice, p_partkey FROM part""")
def sort_composite(spark, sf):
    p = table(spark, sf, "part", "p_size", "p_retailprice", "p_partkey")
    return sorted_rows(p, "p_size", "p_retailprice", "p_partkey").select("pos", "p_size", "p_retailprice", "p_partkey")


@register("inline_rows", sql="""
  SELECT l_returnflag, meaning, CAST(count(*) AS BIGINT) AS n
  FROM lineitem JOIN (VALUES ('A', 'accepted'), ('N', 'none'), ('R', 'returned')) AS f(flag, meaning)
       ON l_returnflag = flag
  GROUP BY l_returnflag, meaning""")
def inline_rows(spark, sf):
    counts = R.group_count(table(spark, sf, "lineitem", "l_returnflag"), "l_returnflag")
    return R.inline_lookup(counts, FLAG_MEANING, "l_returnflag string, meaning string", "l_returnflag") \
        .select("l_returnflag", "meaning", "n")


@register("format_rows", sql="""
  SELECT 'Key: ' || CAST(c_custkey AS VARCHAR) || ', Value: ' || c_name AS text FROM customer
  UNION ALL SELECT 'Name: ' || c_name FROM customer""")
def format_rows(spark, sf):
    c = table(spark, sf, "customer", "c_custkey", "c_name")
    return R.union_bag(R.format_rows(c, "Key: %d, Value: %s", "c_custkey", "c_name"),
                       c.select(F.concat(F.lit("Name: "), F.col("c_name")).alias("text")))

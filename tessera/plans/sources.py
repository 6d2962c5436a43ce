"""Source/sink keys: rows are written from the shared tables into the shared
folder (the test tables are read-only), then read back through the operator."""

from __future__ import annotations

import uuid

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from tessera.operators import text as TX
from tessera.plans.registry import register
from tessera.plans.relational import ACTIVITY_SQL, activity
from tessera.plans.text import LINES_SQL, WORDS_SQL
from tessera.session import scratch_path, spread
from tessera.sources import catalog as C
from tessera.sources import files as FS
from tessera.sources.tables import SCHEMAS, table

# Field layout of the staged files, mirroring the example inputs.
PEOPLE_FIELDS = "name age"
RATING_SEP = "::"
NUM_FEATURES = 64


def _uid() -> str:
    return uuid.uuid4().hex[:10]


@register("text_scan", sql=f"SELECT line AS value FROM ({LINES_SQL}) l")
def text_scan(spark, sf):
    path = FS.write_text(spread(table(spark, sf, "documents", "text")), scratch_path(spark, "docs-text"), "text")
    return FS.read_text(spark, path)


@register("text_sink", sql=f"""
  SELECT '(' || word || ',' || CAST(count(*) AS VARCHAR) || ')' AS value FROM ({WORDS_SQL}) w GROUP BY word""")
def text_sink(spark, sf):
    counts = TX.wordcount(table(spark, sf, "documents", "text"))
    path = FS.write_text(counts, scratch_path(spark, "wordcount-text"), F.format_string("(%s,%d)", "word", "n"))
    return FS.read_text(spark, path)


@register("json_scan", sql="""
  SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""")
def json_scan(spark, sf):
    ev = table(spark, sf, "events", "event_id", "props")
    line = F.concat(F.lit('{"event_id": '), F.col("event_id").cast("string"), F.lit(', "props": '),
                    F.col("props"), F.lit("}"))
    path = FS.write_text(ev, scratch_path(spark, "events-json"), line)
    return FS.read_json_inferred(spark, path).select("event_id", F.col("props.k").alias("k"))


def _staged_lineitem_csv(spark, sf):
    return FS.write_csv(spread(table(spark, sf, "lineitem")), scratch_path(spark, "lineitem-csv"))


@register("csv_scan", sql="SELECT l_orderkey, l_partkey, l_quantity, l_extendedprice FROM lineitem")
def csv_scan(spark, sf):
    path = _staged_lineitem_csv(spark, sf)
    return FS.read_csv(spark, path, SCHEMAS["lineitem"]).select("l_orderkey", "l_partkey", "l_quantity",
                                                                "l_extendedprice")


def _staged_activity_csv(spark, sf):
    acts = activity(spark, sf).join(table(spark, sf, "customer", "c_custkey", "c_acctbal"), "c_custkey")
    return FS.write_csv(acts.select("c_custkey", "c_name", "n_orders", "c_acctbal"),
                        scratch_path(spark, "activity-csv"))


@register("cast_clean", sql=f"""
  SELECT a.c_custkey, a.n_orders, c.c_acctbal FROM ({ACTIVITY_SQL}) a JOIN customer c USING (c_custkey)
  WHERE a.n_orders IS NOT NULL""")
def cast_clean(spark, sf):
    raw = FS.read_csv(spark, _staged_activity_csv(spark, sf))  # every column a string
    typed = raw.select(F.col("c_custkey").try_cast("bigint").alias("c_custkey"),
                       F.col("n_orders").try_cast("bigint").alias("n_orders"),
                       F.col("c_acctbal").try_cast("double").alias("c_acctbal"))
    return typed.dropna()


@register("drop_nulls", sql=f"""
  SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(n_orders AS VARCHAR) AS n_orders
  FROM ({ACTIVITY_SQL}) a WHERE n_orders IS NOT NULL""")
def drop_nulls(spark, sf):
    raw = FS.read_csv(spark, _staged_activity_csv(spark, sf))
    return raw.select("c_custkey", "c_name", "n_orders").dropna()


@register("parse_delimited", sql="SELECT l_suppkey AS user, l_partkey AS item, l_quantity AS rating FROM lineitem")
def parse_delimited(spark, sf):
    li = spread(table(spark, sf, "lineitem", "l_suppkey", "l_partkey", "l_quantity"))
    line = F.concat_ws(RATING_SEP, F.col("l_suppkey").cast("string"), F.col("l_partkey").cast("string"),
                       F.col("l_quantity").cast("string"))
    path = FS.write_text(li, scratch_path(spark, "ratings-text"), line)
    return FS.parse_delimited(FS.read_text(spark, path), RATING_SEP,
                              [("user", "bigint"), ("item", "bigint"), ("rating", "double")])


def _staged_people(spark, sf):
    """``name, n`` lines (a space after the comma), one per customer with orders."""
    acts = activity(spark, sf).filter(F.col("n_orders").isNotNull())
    return FS.write_text(acts, scratch_path(spark, "people-text"),
                         F.format_string("%s, %d", "c_name", "n_orders"))


@register("people_inferred", sql=f"""
  SELECT c_name AS name FROM ({ACTIVITY_SQL}) a WHERE n_orders BETWEEN 13 AND 19""")
def people_inferred(spark, sf):
    lines = FS.read_text(spark, _staged_people(spark, sf))
    people = FS.parse_delimited(lines, ",", [("name", "string"), ("age", "int")])
    view = C.temp_view(people, f"people_{_uid()}")
    return spark.sql(f"SELECT name FROM {view} WHERE age >= 13 AND age <= 19")


@register("people_typed", sql=f"""
  SELECT c_name AS name, CAST(n_orders AS VARCHAR) AS age FROM ({ACTIVITY_SQL}) a WHERE n_orders IS NOT NULL""")
def people_typed(spark, sf):
    schema = FS.schema_from_names(PEOPLE_FIELDS)
    people = FS.read_csv(spark, _staged_people(spark, sf), schema, header=False, ignoreLeadingWhiteSpace=True)
    view = C.temp_view(people, f"people_{_uid()}")
    return spark.sql(f"SELECT name, age FROM {view}")


def _stored_orders_table(spark, sf):
    name = f"src_{_uid()}"
    C.create_table(spark, name, "key BIGINT, value STRING", scratch_path(spark, "table-src"))
    C.load_table(spark, name, table(spark, sf, "orders", "o_orderkey", "o_orderpriority"))
    return name


@register("table_load", sql="SELECT o_orderkey AS key, o_orderpriority AS value FROM orders")
def table_load(spark, sf):
    return spark.sql(f"SELECT key, value FROM {_stored_orders_table(spark, sf)}")


@register("view_query", sql="SELECT c_custkey, c_name FROM customer WHERE c_acctbal > 0")
def view_query(spark, sf):
    view = C.temp_view(table(spark, sf, "customer"), f"customer_{_uid()}")
    return spark.sql(f"SELECT c_custkey, c_name FROM {view} WHERE c_acctbal > 0")


@register("global_view", sql="SELECT c_custkey, c_mktsegment FROM customer")
def global_view(spark, sf):
    name = C.global_view(table(spark, sf, "customer", "c_custkey", "c_mktsegment"), f"customers_{_uid()}")
    return C.query_from_new_session(spark, f"SELECT c_custkey, c_mktsegment FROM {name}")


@register("join_view_table", sql="""
  SELECT s.key, s.value, r.total
  FROM (SELECT l_orderkey AS key, sum(l_quantity) AS total FROM lineitem GROUP BY l_orderkey) r
  JOIN (SELECT o_orderkey AS key, o_orderpriority AS value FROM orders) s ON r.key = s.key""")
def join_view_table(spark, sf):
    stored = _stored_orders_table(spark, sf)
    records = (table(spark, sf, "lineitem", "l_orderkey", "l_quantity").groupBy(F.col("l_orderkey").alias("key"))
               .agg(F.sum("l_quantity").alias("total")))
    view = C.temp_view(records, f"records_{_uid()}")
    return spark.sql(f"SELECT s.key, s.value, r.total FROM {view} r JOIN {stored} s ON r.key = s.key")


@register("join_bucketed", sql="""
  SELECT l_orderkey AS key, o_orderpriority AS value, sum(l_quantity) AS total
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2""")
def join_bucketed(spark, sf):
    """Stored table x records, the table bucketed by its key: only the records are shuffled."""
    C.drop_tables(spark, "src_")
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_orderpriority").alias("value"))
    stored = C.store_bucketed(orders, f"src_bucketed_{_uid()}", ["key"], scratch_path(spark, "table-bucketed"))
    records = (table(spark, sf, "lineitem", "l_orderkey", "l_quantity").groupBy(F.col("l_orderkey").alias("key"))
               .agg(F.sum("l_quantity").alias("total")))
    return records.join(spark.table(stored).hint("merge"), "key").select("key", "value", "total")


def _both(checked, *names):
    """Good rows and rejects in one table: the columns of the other kind are null."""
    return checked.good.select(*names, F.lit(None).cast("string").alias("line"), F.lit(None).cast("string").alias("reason")) \
        .unionByName(checked.rejects, allowMissingColumns=True)


_RATING_LINES_SQL = f"""
  SELECT l_linenumber AS k, l_suppkey AS u, l_partkey AS i, l_quantity AS r, l_returnflag AS flag,
         concat_ws('{RATING_SEP}', CASE WHEN l_linenumber = 7 THEN '' ELSE CAST(l_suppkey AS VARCHAR) END, CAST(l_partkey AS VARCHAR),
           CASE l_linenumber WHEN 5 THEN NULL WHEN 6 THEN l_returnflag ELSE CAST(l_quantity AS VARCHAR) END) AS line
  FROM lineitem"""


@register("parse_checked", sql=f"""
  WITH l AS ({_RATING_LINES_SQL})
  SELECT u AS user, i AS item, r AS rating, NULL AS line, NULL AS reason FROM l WHERE k < 5
  UNION ALL SELECT NULL, NULL, NULL, line, CASE k WHEN 5 THEN 'fields: 2 of 3' WHEN 6 THEN 'rating: not a double'
                                                  ELSE 'user: missing' END FROM l WHERE k >= 5""")
def parse_checked(spark, sf):
    """Delimited ratings with a reject channel. Staged lines of some line numbers lack a field, hold
    a return flag for the rating, or no user."""
    li = spread(table(spark, sf, "lineitem", "l_suppkey", "l_partkey", "l_quantity", "l_linenumber", "l_returnflag"))
    k = F.col("l_linenumber")
    line = F.concat_ws(RATING_SEP, F.when(k == 7, F.lit("")).otherwise(F.col("l_suppkey").cast("string")),
                       F.col("l_partkey").cast("string"),
                       F.when(k == 6, F.col("l_returnflag")).when(k != 5, F.col("l_quantity").cast("string")))
    lines = FS.read_text(spark, FS.write_text(li, scratch_path(spark, "ratings-text"), line))
    checked = FS.check_delimited(lines, RATING_SEP, [("user", "bigint"), ("item", "bigint"), ("rating", "double")],
                                 scratch_path(spark, "ratings-checked"), required=("user", "item"))
    return _both(checked, "user", "item", "rating")


@register("json_checked", sql="""
  WITH l AS (
    SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
           CASE WHEN event_id % 11 = 0 THEN '{"event_id": ' || event_id || ', "k": '
                WHEN event_id % 13 = 0 THEN '{"event_id": ' || event_id || ', "k": "n/a"}'
                WHEN event_id % 17 = 0 THEN '{"k": ' || json_extract(props, '$.k') || '}'
                ELSE '{"event_id": ' || event_id || ', "k": ' || json_extract(props, '$.k') || '}' END AS line
    FROM events)
  SELECT event_id, k, NULL AS line, NULL AS reason FROM l WHERE event_id % 11 > 0 AND event_id % 13 > 0 AND event_id % 17 > 0
  UNION ALL SELECT NULL, NULL, line, CASE WHEN event_id % 11 = 0 THEN 'not JSON' WHEN event_id % 13 = 0 THEN 'k: not a bigint'
                                          ELSE 'event_id: missing' END
  FROM l WHERE event_id % 11 = 0 OR event_id % 13 = 0 OR event_id % 17 = 0""")
def json_checked(spark, sf):
    """JSON lines with a reject channel. Staged lines of some events are cut off, hold a text for
    the number, or no event."""
    ev = table(spark, sf, "events", "event_id", "props")
    i, k = F.col("event_id"), F.get_json_object("props", "$.k")
    head, close = F.concat(F.lit('{"event_id": '), i.cast("string"), F.lit(', "k": ')), F.lit("}")
    line = (F.when(i % 11 == 0, head).when(i % 13 == 0, F.concat(head, F.lit('"n/a"}')))
            .when(i % 17 == 0, F.concat(F.lit('{"k": '), k, close)).otherwise(F.concat(head, k, close)))
    lines = FS.read_text(spark, FS.write_text(ev, scratch_path(spark, "events-json"), line))
    checked = FS.check_json(lines, "event_id bigint, k bigint", scratch_path(spark, "events-checked"), required=("event_id",))
    return _both(checked, "event_id", "k")


@register("libsvm_scan", sql="""
  SELECT label, pos, CAST(count(*) AS BIGINT) AS n, round(sum(v), 4) AS total, round(max(v), 6) AS most
  FROM (SELECT CAST(label AS DOUBLE) AS label, UNNEST(range(len(embedding)))::INTEGER AS pos,
               UNNEST(CAST(embedding AS DOUBLE[])) AS v FROM embeddings) e
  GROUP BY label, pos""")
def libsvm_scan(spark, sf):
    emb = table(spark, sf, "embeddings", "label", "embedding") \
        .select("label", array_to_vector("embedding").alias("features"))
    path = FS.write_libsvm(emb, scratch_path(spark, "embeddings-libsvm"))
    back = FS.read_libsvm(spark, path, NUM_FEATURES)
    cells = back.select("label", F.posexplode(vector_to_array("features")).alias("pos", "v"))
    return cells.groupBy("label", "pos").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("v"), 4).alias("total"),
                                             F.round(F.max("v"), 6).alias("most"))

"""Feature keys: vectors are compared exploded to ``(id, pos, value)`` rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import features as FE
from tessera.plans.registry import register
from tessera.session import checkpoint, scratch_path
from tessera.sources.tables import table

# Inputs of the feature keys.
ASSEMBLE_COLS = ["l_quantity", "l_discount", "l_extendedprice"]
MAX_CATEGORIES = 4
HASH_BUCKETS = 1000

EMB_SQL = """
  SELECT vec_id, CAST(UNNEST(generate_series(0, len(embedding) - 1)) AS INTEGER) AS pos,
         UNNEST(CAST(embedding AS DOUBLE[])) AS x
  FROM embeddings"""
WS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _emb(spark, sf):
    return FE.to_vector(table(spark, sf, "embeddings", "vec_id", "embedding"), "embedding")


@register("assemble", sql=f"""
  SELECT l_orderkey, l_linenumber, CAST(UNNEST([0, 1, 2]) AS INTEGER) AS pos,
         round(UNNEST([{", ".join(ASSEMBLE_COLS)}]), 6) AS value
  FROM lineitem""")
def assemble(spark, sf):
    li = table(spark, sf, "lineitem", "l_orderkey", "l_linenumber", *ASSEMBLE_COLS)
    return FE.explode_vector(FE.assemble(li, ASSEMBLE_COLS), "features", ("l_orderkey", "l_linenumber"))


@register("normalize_l2", sql=f"""
  SELECT vec_id, pos, round(x / sqrt(sum(x * x) OVER (PARTITION BY vec_id)), 6) AS value FROM ({EMB_SQL}) e""")
def normalize_l2(spark, sf):
    return FE.explode_vector(FE.normalize(_emb(spark, sf), "features", 2.0), "normed", ("vec_id",))


@register("normalize_linf", sql=f"""
  SELECT vec_id, pos, round(x / max(abs(x)) OVER (PARTITION BY vec_id), 6) AS value FROM ({EMB_SQL}) e""")
def normalize_linf(spark, sf):
    return FE.explode_vector(FE.normalize(_emb(spark, sf), "features", float("inf")), "normed", ("vec_id",))


@register("standardize", sql=f"""
  SELECT vec_id, pos, round(x / stddev_samp(x) OVER (PARTITION BY pos), 6) AS value FROM ({EMB_SQL}) e""")
def standardize(spark, sf):
    return FE.explode_vector(FE.standardize(_emb(spark, sf), "features"), "scaled", ("vec_id",))


@register("standardize_centered", sql=f"""
  SELECT vec_id, pos, round((x - avg(x) OVER (PARTITION BY pos)) / stddev_samp(x) OVER (PARTITION BY pos), 6) AS value
  FROM ({EMB_SQL}) e""")
def standardize_centered(spark, sf):
    return FE.explode_vector(FE.standardize(_emb(spark, sf), "features", with_mean=True), "scaled", ("vec_id",))


STRING_INDEX_SQL = """
  SELECT p_partkey, p_type, idx FROM part JOIN (
    SELECT p_type, CAST(row_number() OVER (ORDER BY n DESC, p_type) - 1 AS DOUBLE) AS idx
    FROM (SELECT p_type, count(*) AS n FROM part GROUP BY p_type) c) r USING (p_type)"""


@register("string_index", sql=STRING_INDEX_SQL)
def string_index(spark, sf):
    out, _ = FE.string_index(table(spark, sf, "part", "p_partkey", "p_type"), "p_type")
    return out.select("p_partkey", "p_type", "idx")


@register("index_to_string", sql=f"SELECT p_partkey, idx, p_type AS label FROM ({STRING_INDEX_SQL}) s")
def index_to_string(spark, sf):
    out, model = FE.string_index(table(spark, sf, "part", "p_partkey", "p_type"), "p_type")
    return FE.index_to_string(out.select("p_partkey", "idx"), "idx", list(model.labels))


def _codes():
    """Letter flags as numbers (code point minus that of 'A')."""
    return [F.ascii("l_returnflag") - 65.0, F.ascii("l_linestatus") - 65.0, F.col("l_tax"), F.col("l_quantity")]


@register("vector_index", sql=f"""
  WITH f AS (SELECT l_orderkey, l_linenumber, CAST(UNNEST([0, 1, 2, 3]) AS INTEGER) AS pos,
                    UNNEST([ascii(l_returnflag) - 65.0, ascii(l_linestatus) - 65.0, l_tax, l_quantity]) AS v
             FROM lineitem),
  nd AS (SELECT pos, count(DISTINCT v) AS nd FROM f GROUP BY pos),
  cat AS (SELECT pos, v, dense_rank() OVER (PARTITION BY pos ORDER BY v) - 1 AS c FROM (SELECT DISTINCT pos, v FROM f) d)
  SELECT l_orderkey, l_linenumber, pos,
         round(CASE WHEN nd.nd <= {MAX_CATEGORIES} THEN CAST(cat.c AS DOUBLE) ELSE CAST(f.v AS DOUBLE) END, 6) AS value
  FROM f JOIN nd USING (pos) JOIN cat USING (pos, v)""")
def vector_index(spark, sf):
    li = table(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_tax",
               "l_quantity")
    vec = li.select("l_orderkey", "l_linenumber", F.array(*[c.cast("double") for c in _codes()]).alias("arr"))
    out, _ = FE.vector_index(FE.to_vector(vec, "arr"), "features", MAX_CATEGORIES)
    return FE.explode_vector(out, "indexed", ("l_orderkey", "l_linenumber"))


TOKENS_SQL = f"""
  SELECT doc_id, UNNEST(regexp_split_to_array(rtrim(lower(text), {WS}), '\\s')) AS term FROM documents"""


@register("tokenize_terms", sql=f"""
  SELECT doc_id, term, CAST(count(*) AS BIGINT) AS n FROM ({TOKENS_SQL}) t GROUP BY doc_id, term""")
def tokenize_terms(spark, sf):
    return FE.term_counts(table(spark, sf, "documents", "doc_id", "text"), "doc_id", "text")


@register("hashing_tf", sql=f"""
  SELECT doc_id, CAST(count(*) AS DOUBLE) AS n_tokens FROM ({TOKENS_SQL}) t GROUP BY doc_id""")
def hashing_tf(spark, sf):
    """Hashed term frequencies; compared through their conservation law: the
    counts of a document's buckets add up to its number of tokens."""
    toks = FE.tokenize(table(spark, sf, "documents", "doc_id", "text"), "text")
    tf = FE.hashing_tf(toks, "tokens", HASH_BUCKETS)
    from pyspark.ml.functions import vector_to_array
    return tf.select("doc_id", F.aggregate(vector_to_array("tf"), F.lit(0.0), lambda a, x: a + x).alias("n_tokens"))


@register("label_dictionary", sql="""
  WITH d AS (SELECT p_name AS label, row_number() OVER (ORDER BY count(*) DESC, p_name) - 1 AS idx FROM part GROUP BY p_name)
  SELECT p_partkey, p_name, CAST(idx AS DOUBLE) AS idx, label AS restored FROM part JOIN d ON p_name = label""")
def label_dictionary(spark, sf):
    """Part names indexed by a dictionary table and turned back: as many labels as the table has."""
    parts = checkpoint(table(spark, sf, "part", "p_partkey", "p_name"))
    words = checkpoint(FE.label_dictionary(parts, "p_name", scratch_path(spark, "dictionary")))
    indexed = checkpoint(FE.index_by_dictionary(parts, "p_name", words))
    return FE.labels_by_dictionary(indexed, "idx", words, "restored")

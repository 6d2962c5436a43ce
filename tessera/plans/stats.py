"""Statistics keys: correlations, kernel density, Monte-Carlo ratio, regression
metrics on a composite-key join, sampling, a deterministic split and accuracy."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tessera.operators import stats as S
from tessera.operators.skew import hot_keys, join_by_key
from tessera.plans.registry import register
from tessera.session import checkpoint, spread
from tessera.sources.tables import table

# Columns, query points and bandwidth of the statistics keys.
CORR_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
DENSITY_POINTS = [-1.0, 2.0, 5.0, 25.0]
BANDWIDTH = 3.0
SAMPLE_K = 10
TRAIN_BUCKETS = 7  # pmod(id, 10) < 7 -> train


def _corr_matrix_sql():
    n = len(CORR_COLS)
    aggs = ", ".join(f"corr({CORR_COLS[i]}, {CORR_COLS[j]}) AS r_{i}_{j}" for i in range(n) for j in range(i + 1, n))
    rows = []
    for i in range(n):
        for j in range(n):
            r = "1.0" if i == j else f"r_{min(i, j)}_{max(i, j)}"
            rows.append(f"SELECT {i} AS i, {j} AS j, round(CAST({r} AS DOUBLE), 6) AS r FROM c")
    return f"WITH c AS (SELECT {aggs} FROM lineitem) " + " UNION ALL ".join(rows)


@register("corr_pair", sql="SELECT round(corr(l_quantity, l_extendedprice), 6) AS r FROM lineitem")
def corr_pair(spark, sf):
    r = S.corr_pair(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice")
    return r.select(F.round("r", 6).alias("r"))


@register("corr_matrix", sql=_corr_matrix_sql())
def corr_matrix(spark, sf):
    m = S.corr_matrix(table(spark, sf, "lineitem"), CORR_COLS)
    return m.select("i", "j", F.round("r", 6).alias("r"))


@register("corr_vector", sql="""
  SELECT CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, round(CASE WHEN i = j THEN 1.0 ELSE corr(a, b) END, 6) AS r
  FROM (SELECT i, j, CAST(embedding[i + 1] AS DOUBLE) AS a, CAST(embedding[j + 1] AS DOUBLE) AS b
        FROM embeddings, range(64) x(i), range(64) y(j)) GROUP BY i, j""")
def corr_vector(spark, sf):
    vectors = table(spark, sf, "embeddings", "embedding").select(array_to_vector("embedding").alias("features"))
    return S.corr_vector(vectors).select("i", "j", F.round("r", 6).alias("r"))


@register("corr_spearman", sql="""
  SELECT round(corr(ra, rb), 6) AS r FROM (
    SELECT rank() OVER (ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_quantity) - 1) / 2.0 AS ra,
           rank() OVER (ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY l_extendedprice) - 1) / 2.0 AS rb
    FROM lineitem) t""")
def corr_spearman(spark, sf):
    r = S.corr_spearman(table(spark, sf, "lineitem", "l_quantity", "l_extendedprice"), "l_quantity",
                        "l_extendedprice")
    return r.select(F.round("r", 6).alias("r"))


@register("kernel_density", sql=f"""
  SELECT CAST(p AS DOUBLE) AS point,
         round(avg(exp(-0.5 * pow((p - l_quantity) / {BANDWIDTH}, 2))) / ({BANDWIDTH} * sqrt(2 * pi())), 6) AS density
  FROM lineitem, (VALUES {", ".join(f"({p})" for p in DENSITY_POINTS)}) AS t(p)
  GROUP BY p""")
def kernel_density(spark, sf):
    d = S.kernel_density(table(spark, sf, "lineitem", "l_quantity"), "l_quantity", DENSITY_POINTS, BANDWIDTH)
    return d.select("point", F.round("density", 6).alias("density"))


#: Bandwidth of the density of prices at the parts' prices, and the kernel's tail.
PRICE_BANDWIDTH, PRICE_TAIL = 200.0, 1e-9


@register("kernel_density_points", sql=f"""
  SELECT point, round(avg(exp(-0.5 * pow((point - l_extendedprice) / {PRICE_BANDWIDTH}, 2))) / ({PRICE_BANDWIDTH} * sqrt(2 * pi())), 9) AS density,
         {PRICE_TAIL} / ({PRICE_BANDWIDTH} * sqrt(2 * pi())) AS error_bound
  FROM lineitem, (SELECT DISTINCT CAST(p_retailprice AS DOUBLE) AS point FROM part) p GROUP BY point""")
def kernel_density_points(spark, sf):
    """The points are a table: the distinct prices of the parts."""
    d = S.kernel_density_at(table(spark, sf, "lineitem", "l_extendedprice"), "l_extendedprice",
                            table(spark, sf, "part", "p_retailprice"), "p_retailprice", PRICE_BANDWIDTH, PRICE_TAIL)
    return d.select("point", F.round("density", 9).alias("density"), "error_bound")


@register("mc_ratio", sql=f"""
  SELECT CAST(count(*) AS BIGINT) AS n,
         round(CAST(4.0 AS DOUBLE) * sum(CASE WHEN x * x + y * y <= 1.0 THEN 1 ELSE 0 END) / count(*), 6) AS estimate
  FROM (SELECT 2.0 * {S.frac_sql("o_orderkey", S.ALPHA_X)} - 1.0 AS x,
               2.0 * {S.frac_sql("o_orderkey", S.ALPHA_Y)} - 1.0 AS y
        FROM orders) p""")
def mc_ratio(spark, sf):
    r = S.mc_ratio(table(spark, sf, "orders", "o_orderkey"), "o_orderkey")
    return r.select("n", F.round("estimate", 6).alias("estimate"))


RATINGS_SQL = """
  ratings AS (SELECT o_custkey AS user_id, l_partkey AS item_id, avg(l_quantity) AS rating
              FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2),
  um AS (SELECT user_id, avg(rating) AS umean FROM ratings GROUP BY 1),
  im AS (SELECT item_id, avg(rating) AS imean FROM ratings GROUP BY 1),
  pred AS (SELECT r.user_id, r.item_id, im.imean + um.umean - (SELECT avg(rating) FROM ratings) AS prediction
           FROM ratings r JOIN um USING (user_id) JOIN im USING (item_id)),
  scored AS (SELECT p.user_id, p.item_id, p.prediction, r.rating AS label
             FROM pred p JOIN ratings r USING (user_id, item_id))"""


def ratings(spark, sf):
    """``(user_id, item_id, rating)``: mean quantity a customer bought of a part."""
    li = spread(table(spark, sf, "lineitem", "l_orderkey", "l_partkey", "l_quantity"))
    od = table(spark, sf, "orders", "o_orderkey", "o_custkey")
    return (li.join(od, li.l_orderkey == od.o_orderkey)
            .groupBy(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"))
            .agg(F.avg("l_quantity").alias("rating")))


def predicted(spark, sf):
    """Ratings with a baseline prediction (item mean + user offset):
    ``(user_id, item_id, label, prediction)``. The means are one row per user or item;
    hot users and items take the broadcast path of ``join_by_key``."""
    r = checkpoint(ratings(spark, sf))  # used several times below: compute the join + aggregate once
    gm = r.agg(F.avg("rating")).scalar()
    um = r.groupBy("user_id").agg(F.avg("rating").alias("umean"))
    im = r.groupBy("item_id").agg(F.avg("rating").alias("imean"))
    with_user = checkpoint(join_by_key(r, um, "user_id", hot_keys(r, "user_id")))
    both = join_by_key(with_user, im, "item_id", hot_keys(r, "item_id"))
    return r, both.select("user_id", "item_id", F.col("rating").alias("label"),
                          (F.col("imean") + F.col("umean") - gm).alias("prediction"))


@register("score_and_labels", sql=f"""
  WITH {RATINGS_SQL}
  SELECT user_id, item_id, round(prediction, 6) AS prediction, round(label, 6) AS label FROM scored""")
def score_and_labels(spark, sf):
    """Predictions joined back to the observed ratings on the composite key."""
    r, pred = predicted(spark, sf)
    s = (pred.select("user_id", "item_id", "prediction")
         .join(r.withColumnRenamed("rating", "label"), ["user_id", "item_id"]))
    return s.select("user_id", "item_id", F.round("prediction", 6).alias("prediction"),
                    F.round("label", 6).alias("label"))


@register("regression_metrics", sql=f"""
  WITH {RATINGS_SQL}
  SELECT CAST(count(*) AS BIGINT) AS n, round(sqrt(avg(pow(prediction - label, 2))), 6) AS rmse,
         round(1 - sum(pow(prediction - label, 2)) / (count(*) * var_pop(label)), 6) AS r2,
         round(avg(abs(prediction - label)), 6) AS mae
  FROM scored""")
def regression_metrics(spark, sf):
    m = S.regression_metrics(predicted(spark, sf)[1], "prediction", "label")
    return m.select("n", *[F.round(c, 6).alias(c) for c in ("rmse", "r2", "mae")])


@register("sample_k", sql=f"""
  SELECT doc_id, lang FROM documents
  ORDER BY {S.frac_sql("doc_id", S.ALPHA_X)}, doc_id
  LIMIT {SAMPLE_K}""")
def sample_k(spark, sf):
    return S.sample_k(table(spark, sf, "documents", "doc_id", "lang"), SAMPLE_K, "doc_id")


def split_flag(id_col: str):
    """``'train'`` for ``pmod(id, 10) < 7``, else ``'test'``: a 70/30 split that any
    engine reproduces (``randomSplit([0.7, 0.3], seed)`` is the sampled variant)."""
    return F.when(F.pmod(F.col(id_col), F.lit(10)) < TRAIN_BUCKETS, F.lit("train")).otherwise(F.lit("test"))


@register("split_70_30", sql=f"""
  SELECT doc_id, CASE WHEN doc_id % 10 < {TRAIN_BUCKETS} THEN 'train' ELSE 'test' END AS part FROM documents""")
def split_70_30(spark, sf):
    return table(spark, sf, "documents", "doc_id").select("doc_id", split_flag("doc_id").alias("part"))


@register("accuracy", sql=f"""
  WITH d AS (SELECT l.doc_id, l.quality, doc.source FROM labels l JOIN documents doc USING (doc_id)),
  tr AS (SELECT * FROM d WHERE doc_id % 10 < {TRAIN_BUCKETS}),
  te AS (SELECT * FROM d WHERE doc_id % 10 >= {TRAIN_BUCKETS}),
  sc AS (SELECT source, quality, count(*) AS c FROM tr GROUP BY 1, 2),
  maj AS (SELECT source, quality AS pred FROM (
            SELECT source, quality, row_number() OVER (PARTITION BY source ORDER BY c DESC, quality) AS rn FROM sc) x
          WHERE rn = 1),
  g AS (SELECT quality AS gq FROM (SELECT quality, count(*) AS c FROM tr GROUP BY 1) y ORDER BY c DESC, quality LIMIT 1)
  SELECT CAST(count(*) AS BIGINT) AS n,
         round(avg(CASE WHEN coalesce(maj.pred, g.gq) = te.quality THEN 1.0 ELSE 0.0 END), 6) AS accuracy
  FROM te LEFT JOIN maj USING (source), g""")
def accuracy(spark, sf):
    """Accuracy of a majority-class-per-source rule learned on the train split,
    measured on the test split: ``avg(prediction = label)``."""
    d = table(spark, sf, "labels", "doc_id", "quality").join(table(spark, sf, "documents", "doc_id", "source"),
                                                              "doc_id")
    d = d.withColumn("part", split_flag("doc_id"))
    tr, te = d.filter(F.col("part") == "train"), d.filter(F.col("part") == "test")
    best = F.struct(F.col("c"), -F.col("quality"))
    maj = (tr.groupBy("source", "quality").agg(F.count(F.lit(1)).alias("c"))
           .groupBy("source").agg(F.max_by("quality", best).alias("pred")))
    overall = (tr.groupBy("quality").agg(F.count(F.lit(1)).alias("c"))
               .agg(F.max_by("quality", best)).scalar())
    pred = te.join(maj, "source", "left").withColumn("pred", F.coalesce(F.col("pred"), overall))
    return pred.agg(F.count(F.lit(1)).alias("n"),
                    F.round(F.avg((F.col("pred") == F.col("quality")).cast("double")), 6).alias("accuracy"))

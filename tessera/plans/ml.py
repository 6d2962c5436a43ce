"""Model keys (``pyspark.ml``). Their results hold what the tables decide exactly (ids,
labels, label indexes, ratings) and flags computed from the fitted model: predictions
follow from its parameters and are no worse than a stated bound. An oracle states the
exact part and expects every flag to be true."""

from __future__ import annotations

from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from tessera.functions.text import letter_shares
from tessera.operators import classify as CL
from tessera.operators import factorise as FA
from tessera.operators import trees as TR
from tessera.plans.registry import register
from tessera.plans.stats import TRAIN_BUCKETS, split_flag
from tessera.session import checkpoint, scratch_path, spread, stored
from tessera.sources.tables import table

# Letters whose shares describe a document's language.
LETTERS = ["a", "e", "i", "o", "u", "c", "d", "h", "n", "r", "s", "t", "l", "ä", "é", "ñ"]
# Parameter overrides of the estimator/param example.
PARAM_OVERRIDES = {"maxIter": 30, "regParam": 0.1, "threshold": 0.55, "probabilityCol": "myProbability"}
MIN_SUPPORT = 0.004


def letter_docs(spark, sf):
    """``(doc_id, lang, label, features, part)``: letter shares of every document;
    ``label`` = 1.0 for English.

    The feature table is small (16 numbers per text) and every estimator passes
    over it many times, so it is computed once from the texts and checkpointed."""
    docs = spread(table(spark, sf, "documents", "doc_id", "text", "lang"))
    low = docs.select("doc_id", "lang", F.lower("text").alias("_t")).withColumn("_n", F.length("_t"))
    feats = low.select("doc_id", "lang", (F.col("lang") == "en").cast("double").alias("label"),
                       *letter_shares("_t", "_n", LETTERS))
    vec = VectorAssembler(inputCols=[f"f{i}" for i in range(len(LETTERS))], outputCol="features").transform(feats)
    return checkpoint(vec.select("doc_id", "lang", "label", "features", split_flag("doc_id").alias("part")))


def _split(df):
    return df.filter(F.col("part") == "train"), df.filter(F.col("part") == "test")


TEST = f"doc_id % 10 >= {TRAIN_BUCKETS}"


def _judged(out, follows, label: str = "label"):
    """Scored test rows with two flags computed from the fitted model: the row's prediction
    follows from the model's parameters, and the test split's accuracy is at least that of
    its most frequent class."""
    right = F.avg((F.col("prediction") == F.col(label)).cast("double"))
    out = checkpoint(out.withColumn("follows", follows))
    accuracy = out.agg(right).first()[0]
    majority = (out.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
                .agg(F.max("n") / F.sum("n")).first()[0])
    ok = accuracy is None or accuracy >= majority - 1e-9
    return out.withColumn("beats_majority", F.lit(ok))


def _lang_index_sql(condition: str = "lang") -> str:
    """Labels indexed by falling frequency over all rows, ties by label."""
    return f"""idx AS (SELECT label, CAST(row_number() OVER (ORDER BY n DESC, label) - 1 AS DOUBLE) AS pos FROM (
                 SELECT {condition} AS label, count(*) AS n FROM documents GROUP BY 1) c)"""


_BINOMIAL_SQL = f"""
  SELECT doc_id, CAST(CASE WHEN lang = 'en' THEN 1 ELSE 0 END AS DOUBLE) AS label, true AS follows, true AS beats_majority
  FROM documents WHERE {TEST}"""


@register("logreg_binomial", sql=_BINOMIAL_SQL)
def logreg_binomial(spark, sf):
    train, test = _split(letter_docs(spark, sf))
    model, out = CL.logistic(train, test)
    return _judged(out, CL.follows_linear(model)).select("doc_id", "label", "follows", "beats_majority")


@register("logreg_multinomial", sql=f"""
  WITH {_lang_index_sql()}
  SELECT doc_id, pos AS label, true AS follows, true AS beats_majority
  FROM documents JOIN idx ON lang = label WHERE {TEST}""")
def logreg_multinomial(spark, sf):
    docs = letter_docs(spark, sf).drop("label")
    docs = StringIndexer(inputCol="lang", outputCol="label").fit(docs).transform(docs)
    train, test = _split(docs)
    model, out = CL.logistic(train, test, family="multinomial")
    return _judged(out, CL.follows_linear(model)).select("doc_id", "label", "follows", "beats_majority")


@register("logreg_params", sql=f"""
  SELECT doc_id, CAST(CASE WHEN lang = 'en' THEN 1 ELSE 0 END AS DOUBLE) AS label, true AS follows, true AS overridden
  FROM documents WHERE {TEST}""")
def logreg_params(spark, sf):
    """``overridden``: the fitted model carries the overriding values, not the base ones."""
    train, test = _split(letter_docs(spark, sf))
    model, out = CL.logistic_with_params(train, test, PARAM_OVERRIDES)
    held = all(model.getOrDefault(k) == v for k, v in PARAM_OVERRIDES.items())
    return out.select("doc_id", "label", CL.follows_linear(model, probability="myProbability").alias("follows"),
                      F.lit(held).alias("overridden"))


@register("linear_svc", sql=_BINOMIAL_SQL)
def linear_svc(spark, sf):
    train, test = _split(letter_docs(spark, sf))
    model, out = CL.linear_svc(train, test)
    return _judged(out, CL.follows_linear(model)).select("doc_id", "label", "follows", "beats_majority")


def _tree(spark, sf, kind):
    train, test = _split(letter_docs(spark, sf).drop("label").withColumnRenamed("lang", "label"))
    if kind == "gbt":  # binary only
        train, test = [d.withColumn("label", F.when(F.col("label") == "en", "en").otherwise("other"))
                       for d in (train, test)]
    model, out = CL.tree_models(train, test, kind)
    table = TR.node_table(spark, model.stages[2])
    x = vector_to_array("indexedFeatures")
    by_table = TR.predict_margin(table, x) if kind == "gbt" else TR.predict_votes(table, x)
    return _judged(out.withColumn("by_table", by_table == F.col("prediction")), CL.follows_votes(), "indexedLabel")


def _tree_sql(label: str = "lang", extra: str = "") -> str:
    return f"""
  WITH {_lang_index_sql(label)}
  SELECT doc_id, label, pos AS "indexedLabel", true AS follows, true AS beats_majority, true AS by_table{extra}
  FROM documents JOIN idx ON {label} = label WHERE {TEST}"""


@register("tree_classifier", sql=_tree_sql())
def tree_classifier(spark, sf):
    """``by_table``: the nodes as a table, compiled to an expression, predict what the model does."""
    return _tree(spark, sf, "tree").select("doc_id", "label", "indexedLabel", "follows", "beats_majority", "by_table")


@register("forest_classifier", sql=_tree_sql(extra=", true AS label_restored"))
def forest_classifier(spark, sf):
    """``label_restored``: the predicted label is the one its index stands for."""
    out = _tree(spark, sf, "forest")
    restored = (F.col("predictedLabel") == F.col("label")) == (F.col("prediction") == F.col("indexedLabel"))
    return out.select("doc_id", "label", "indexedLabel", "follows", "beats_majority", "by_table",
                      restored.alias("label_restored"))


@register("gbt_classifier", sql=_tree_sql("CASE WHEN lang = 'en' THEN 'en' ELSE 'other' END"))
def gbt_classifier(spark, sf):
    return _tree(spark, sf, "gbt").select("doc_id", "label", "indexedLabel", "follows", "beats_majority", "by_table")


def labelled_texts(spark, sf):
    """Labelled texts as hashed term counts, tokenised once and stored for every pass of a fit."""
    docs = spread(table(spark, sf, "documents", "doc_id", "text"))
    labels = table(spark, sf, "labels", "doc_id", "quality")
    return (docs.join(labels, "doc_id").select("doc_id", "text", F.col("quality").cast("double").alias("label"),
                                               split_flag("doc_id").alias("part")))


@register("text_classifier", sql=f"""
  SELECT doc_id, CAST(quality AS DOUBLE) AS label, true AS follows, true AS beats_majority
  FROM labels JOIN documents USING (doc_id) WHERE {TEST}""")
def text_classifier(spark, sf):
    tokenizer, hasher, fit = CL.text_model().getStages()
    terms = hasher.transform(tokenizer.transform(labelled_texts(spark, sf))).select("doc_id", "label", "part", "features")
    train, test = _split(checkpoint(terms))
    model = fit.fit(train)
    return _judged(model.transform(test), CL.follows_linear(model)).select("doc_id", "label", "follows", "beats_majority")


@register("model_save_load", sql=f"""
  SELECT doc_id, CAST(quality AS DOUBLE) AS label, true AS same_prediction
  FROM labels JOIN documents USING (doc_id) WHERE {TEST}""")
def model_save_load(spark, sf):
    """Fit, save to the shared folder, load back; the loaded model scores the fitted one's result."""
    train, test = _split(checkpoint(labelled_texts(spark, sf)))
    model = CL.text_model().fit(train)
    CL.text_model().write().overwrite().save(scratch_path(spark, "model-unfitted"))
    loaded = CL.save_and_load(model, scratch_path(spark, "model-fitted"))
    first = model.transform(test).select("doc_id", "text", "label", F.col("prediction").alias("fitted"))
    return loaded.transform(first).select("doc_id", "label", (F.col("prediction") == F.col("fitted")).alias("same_prediction"))


def _embeddings(spark, sf):
    return table(spark, sf, "embeddings", "vec_id", "embedding", "label") \
        .select("vec_id", "label", array_to_vector("embedding").alias("features"))


_NEAREST_SQL = "SELECT vec_id, true AS nearest, true AS known_cluster FROM embeddings"


def _clustered(model, out):
    known = F.col("prediction").between(0, len(model.clusterCenters()) - 1)
    return out.select("vec_id", CL.nearest_centre(out, model).alias("nearest"), known.alias("known_cluster"))


@register("kmeans_ml", sql=_NEAREST_SQL)
def kmeans_ml(spark, sf):
    return _clustered(*CL.kmeans_ml(_embeddings(spark, sf), k=2, seed=1))


@register("bisecting_kmeans", sql=_NEAREST_SQL)
def bisecting_kmeans(spark, sf):
    """Two leaves: the bisection's choice is the nearer of the two centres."""
    return _clustered(*CL.bisecting_kmeans(_embeddings(spark, sf), k=2, max_iter=5))


def quantity_ratings(spark, sf):
    """``(user_id, item_id, rating)``: a customer's mean quantity of a part, on a
    1..5-like scale (/10), shifted by -2.5 as the recommender example does."""
    li = spread(table(spark, sf, "lineitem", "l_orderkey", "l_partkey", "l_quantity"))
    od = table(spark, sf, "orders", "o_orderkey", "o_custkey")
    return (li.join(od, li.l_orderkey == od.o_orderkey)
            .groupBy(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"))
            .agg((F.avg("l_quantity") / 10.0 - 2.5).alias("rating")))


def _factored(ratings, max_iter):
    """Exact ratings, and flags from the model: each prediction is the product of its
    factors, and the error over all ratings is below their standard deviation (the error
    of predicting the mean). The scored rows are stored: scoring joins every rating with both
    factors, and the error and the result each read it."""
    model, out = CL.als(ratings, rank=10, max_iter=max_iter, reg=0.01, seed=42)
    out = stored(CL.factor_product(out, model).select("user_id", "item_id", "rating", "prediction", "is_product"), "scored")
    fits = CL.rmse(out) <= out.agg(F.stddev_pop("rating")).first()[0]
    return out.select("user_id", "item_id", F.round("rating", 6).alias("rating"), "is_product", F.lit(fits).alias("fits"))


@register("als_ratings", sql="""
  SELECT o_custkey AS user_id, l_partkey AS item_id, round(avg(l_quantity) / 10.0 - 2.5, 6) AS rating,
         true AS is_product, true AS fits
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2""")
def als_ratings(spark, sf):
    return _factored(quantity_ratings(spark, sf), max_iter=10)


@register("als_dense", sql="""
  SELECT c_nationkey AS user_id, s_nationkey AS item_id, round(avg(l_quantity) / 10.0, 6) AS rating,
         true AS is_product, true AS fits
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2""")
def als_dense(spark, sf):
    """Five iterations over ``nation_ratings``."""
    return _factored(nation_ratings(spark, sf), max_iter=5)


def nation_ratings(spark, sf):
    """Customer nation x supplier nation mean quantity / 10 (a full 25 x 25 matrix)."""
    li = spread(table(spark, sf, "lineitem", "l_orderkey", "l_suppkey", "l_quantity"))
    od = table(spark, sf, "orders", "o_orderkey", "o_custkey")
    cu = table(spark, sf, "customer", "c_custkey", "c_nationkey")
    su = table(spark, sf, "supplier", "s_suppkey", "s_nationkey")
    return (li.join(od, li.l_orderkey == od.o_orderkey).join(cu, F.col("o_custkey") == F.col("c_custkey"))
            .join(su, F.col("l_suppkey") == F.col("s_suppkey"))
            .groupBy(F.col("c_nationkey").alias("user_id"), F.col("s_nationkey").alias("item_id"))
            .agg((F.avg("l_quantity") / 10.0).alias("rating")))


#: Factors and iterations of ``als_dense_errors``, and the penalty per rating.
ERROR_RANK, ERROR_ITERATIONS, ERROR_REG = 3, 5, 0.01


def _solve_sql(sums: str, rank: int) -> str:
    """(key, x0, ...) from (key, a<i><j>, b<i>): Gauss-Jordan elimination, a column a subquery."""
    cells = [f"a{i}{j}" for i in range(rank) for j in range(rank)] + [f"b{i}" for i in range(rank)]
    for k in range(rank):
        def cell(name, i, right):
            pivot = f"{right} / a{k}{k}"
            return f"{pivot} AS {name}" if i == k else f"{name} - a{i}{k} * ({pivot}) AS {name}"
        cols = [cell(c, int(c[1]), f"a{k}{c[2]}" if c[0] == "a" else f"b{k}") for c in cells]
        sums = f"SELECT key, {', '.join(cols)} FROM ({sums})"
    return f"SELECT key, {', '.join(f'b{i} AS x{i}' for i in range(rank))} FROM ({sums})"


def _als_errors_sql(rank: int, iterations: int, reg: float) -> str:
    start = ", ".join(f"((key % {FA.PRIME} * {rank} + {f + 1}) * {FA.MULTIPLIER}) % {FA.PRIME} / {FA.PRIME}.0::DOUBLE AS x{f}"
                      for f in range(rank))
    ctes = [f"u0 AS (SELECT key, {start} FROM (SELECT DISTINCT u::BIGINT AS key FROM m))"]

    def half(name, target, source, factors):
        a = ", ".join(f"sum(x{i} * x{j}) + {f'{reg} * count(*)' if i == j else '0'} AS a{i}{j}"
                      for i in range(rank) for j in range(rank))
        b = ", ".join(f"sum(x{i} * rating) AS b{i}" for i in range(rank))
        sums = f"SELECT {target} AS key, {a}, {b} FROM m JOIN {factors} f ON f.key = m.{source} GROUP BY {target}"
        ctes.append(f"{name} AS ({_solve_sql(sums, rank)})")

    parts = []
    for t in range(1, iterations + 1):
        half(f"i{t}", "i", "u", f"u{t - 1}")
        half(f"u{t}", "u", "i", f"i{t}")
        dot = " + ".join(f"p.x{f} * q.x{f}" for f in range(rank))
        parts.append(f"SELECT {t} AS iteration, round(sqrt(avg((rating - ({dot})) ** 2)), 6) AS rmse "
                     f"FROM m JOIN u{t} p ON p.key = m.u JOIN i{t} q ON q.key = m.i")
    return f"""
  WITH m AS (SELECT c_nationkey AS u, s_nationkey AS i, avg(l_quantity) / 10.0 AS rating
             FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
                  JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2),
  {", ".join(ctes)}
  {" UNION ALL ".join(parts)}"""


@register("als_dense_errors", sql=_als_errors_sql(ERROR_RANK, ERROR_ITERATIONS, ERROR_REG))
def als_dense_errors(spark, sf):
    """The error of every iteration from a fixed start, by normal equations."""
    _, _, errors = FA.als_errors(nation_ratings(spark, sf), ERROR_RANK, ERROR_ITERATIONS, ERROR_REG)
    return spark.createDataFrame([(i, round(e, 6)) for i, e in errors], "iteration int, rmse double")


def _itemsets_sql(max_size: int = 4) -> str:
    parts = []
    for n in range(1, max_size + 1):
        tabs = ", ".join(f"b b{i}" for i in range(n))
        conds = [f"b{i}.o = b0.o" for i in range(1, n)] + [f"b{i - 1}.item < b{i}.item" for i in range(1, n)]
        where = (" WHERE " + " AND ".join(conds)) if conds else ""
        items = " || ',' || ".join(f"b{i}.item" for i in range(n))
        parts.append(f"SELECT {items} AS items, count(*) AS freq FROM {tabs}{where} GROUP BY 1")
    return f"""
  WITH b AS (SELECT DISTINCT l_orderkey AS o, p_brand AS item FROM lineitem JOIN part ON l_partkey = p_partkey),
  m AS (SELECT ceil({MIN_SUPPORT} * count(DISTINCT o)) AS minc FROM b)
  SELECT items, CAST(freq AS BIGINT) AS freq FROM ({" UNION ALL ".join(parts)}) s, m WHERE freq >= minc"""


@register("freq_itemsets", sql=_itemsets_sql())
def freq_itemsets(spark, sf):
    """Baskets = the distinct brands of each order."""
    li = spread(table(spark, sf, "lineitem", "l_orderkey", "l_partkey"))
    part = table(spark, sf, "part", "p_partkey", "p_brand")
    # materialised once: the fit counts items, and the itemsets are mined later,
    # lazily, after the fit has released its own cache of the input
    baskets = checkpoint(li.join(part, li.l_partkey == part.p_partkey).groupBy("l_orderkey")
                         .agg(F.collect_set("p_brand").alias("items")))
    # conditional trees are spread over the cluster's parallelism, not over however
    # few partitions AQE coalesced the baskets into
    sets = CL.freq_itemsets(baskets, "items", MIN_SUPPORT, num_partitions=spark.sparkContext.defaultParallelism)
    return sets.select(F.concat_ws(",", F.array_sort("items")).alias("items"), F.col("freq").cast("bigint"))

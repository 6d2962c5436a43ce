"""Fitted models as tables: linear ones with a certificate of optimality, trees node by node. The
oracles fit the same objectives with a solver of their own (``solver_sql``) and grow the same tree
(``trees_sql``)."""

from __future__ import annotations

from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tessera.operators import classify as CL
from tessera.operators import trees as TR
from tessera.operators.certificate import certify_linear
from tessera.plans.ml import LETTERS, _lang_index_sql, _split, letter_docs
from tessera.plans.registry import register
from tessera.plans.solver_sql import coefficients_sql, fit_sql, letter_rows_sql
from tessera.plans.stats import TRAIN_BUCKETS
from tessera.plans.trees_sql import grow_sql

# The penalties of the classification examples.
REG, ELASTIC_NET, SVC_REG = 0.3, 0.8, 0.1
#: Fits run to convergence, so that the coefficients are the objective's, not the solver's.
MAX_ITER, TOL, TOLERANCE = 200, 1e-10, 1e-5
#: The hinge is not smooth: the fit's iterations, its tolerance, and the oracle's smoothing and steps.
SVC_ITER, SVC_TOLERANCE, KINK, SVC_STEPS = 50, 0.02, 0.02, 900
WHERE = f"doc_id % 10 < {TRAIN_BUCKETS}"
_SCHEMA = "class_id int, feature int, value double, scaled double"


def _table(spark, certificate):
    """Coefficients rounded to what two solvers agree on, with the certificate's verdicts."""
    rows = spark.createDataFrame(certificate.coefficients, _SCHEMA)
    return rows.select("class_id", "feature", (F.round("value", 3) + 0.0).alias("value"),
                       (F.round("scaled", 4) + 0.0).alias("scaled"), F.lit(certificate.optimal(TOLERANCE)).alias("optimal"),
                       F.lit(certificate.below_null).alias("below_null"),
                       F.lit(certificate.below_perturbed).alias("below_perturbed"))


def _logistic(spark, train, family):
    model = LogisticRegression(maxIter=MAX_ITER, tol=TOL, regParam=REG, elasticNetParam=ELASTIC_NET, family=family).fit(train)
    return _table(spark, certify_linear(train, model, REG, ELASTIC_NET))


@register("logreg_binomial_coefficients", sql=f"""
  WITH RECURSIVE {letter_rows_sql(LETTERS, WHERE)},
  {fit_sql("d", "[1 / (1 + exp(-list_dot_product(x, u))) - (lang = 'en')::INT]", len(LETTERS), 1, 250, 3.0, 0.06, REG, ELASTIC_NET)}
  {coefficients_sql(len(LETTERS), 1, 250)}""")
def logreg_binomial_coefficients(spark, sf):
    """English against the rest: (class_id, feature, value, scaled) and the certificate."""
    train, _ = _split(letter_docs(spark, sf))
    return _logistic(spark, train, "binomial")


def _softmax_slopes(classes: int, width: int) -> str:
    margins = ", ".join(f"list_dot_product(x, u[{c * width + 1}:{(c + 1) * width}])" for c in range(classes))
    return f"""(SELECT list_transform(range(1, {classes + 1}), lambda c: e[c] / list_sum(e) - (pos = c - 1)::INT)
                 FROM (SELECT list_transform([{margins}], lambda m: exp(m)) AS e))"""


@register("logreg_multinomial_coefficients", sql=f"""
  WITH RECURSIVE {_lang_index_sql()}, {letter_rows_sql(LETTERS, WHERE)},
  p AS (SELECT x, n, pos FROM d JOIN idx ON lang = label),
  {fit_sql("p", _softmax_slopes(4, len(LETTERS) + 1), len(LETTERS), 4, 300, 5.0, 0.06, REG, ELASTIC_NET)}
  {coefficients_sql(len(LETTERS), 4, 300)}""")
def logreg_multinomial_coefficients(spark, sf):
    """The four languages, classes by falling frequency: as the binomial key, per class."""
    docs = letter_docs(spark, sf).drop("label")
    docs = StringIndexer(inputCol="lang", outputCol="label").fit(docs).transform(docs)
    train, _ = _split(docs)
    return _logistic(spark, train, "multinomial")


_HINGE = f"""[(SELECT CASE WHEN t >= 1 THEN 0 WHEN t <= {1 - KINK} THEN -y ELSE y * (t - 1) / {KINK} END
               FROM (SELECT y * list_dot_product(x, u) AS t))]"""


@register("linear_svc_objective", sql=f"""
  WITH RECURSIVE {letter_rows_sql(LETTERS, WHERE)},
  h AS (SELECT x, n, CASE WHEN lang = 'en' THEN 1.0 ELSE -1.0 END AS y FROM d),
  {fit_sql("h", _HINGE, len(LETTERS), 1, SVC_STEPS, 8 / KINK, SVC_REG, SVC_REG, 0.0)}
  SELECT count(*)::BIGINT AS n, round(avg(greatest(0, 1 - y * list_dot_product(x, v)))
           + {SVC_REG / 2} * (list_dot_product(any_value(v), any_value(v)) - any_value(v)[{len(LETTERS) + 1}] ** 2), 3) AS objective,
         round(2 * least(avg((y > 0)::INT), avg((y < 0)::INT)), 6) AS null_objective,
         true AS optimal, true AS below_null, true AS below_perturbed
  FROM h, s WHERE step = {SVC_STEPS}""")
def linear_svc_objective(spark, sf):
    """The hinge objective at the fitted model. Its coefficients move by a hundredth without
    changing the objective's third digit, so the key returns the objective; the table is
    ``certify_linear(...).coefficients``."""
    train, _ = _split(letter_docs(spark, sf))
    model = LinearSVC(maxIter=SVC_ITER, tol=TOL, regParam=SVC_REG).fit(train)
    c = certify_linear(train, model, SVC_REG)
    rows = [(c.n, round(c.objective, 3), round(c.null_objective, 6), c.optimal(SVC_TOLERANCE), c.below_null, c.below_perturbed)]
    return spark.createDataFrame(rows, "n bigint, objective double, null_objective double, optimal boolean, "
                                       "below_null boolean, below_perturbed boolean")


#: Depth of the example's tree (the library's default).
DEPTH = 5


@register("tree_nodes", sql=f"""
  WITH RECURSIVE {_lang_index_sql()}, {letter_rows_sql(LETTERS, WHERE)},
  t AS (SELECT doc_id, CAST(pos AS INTEGER) AS pos, x FROM f JOIN idx ON lang = label),
  {grow_sql("t", len(LETTERS), 4, DEPTH)}
  SELECT node, CAST(feature AS INTEGER) AS feature, round(threshold, 6) AS threshold, CAST(n AS BIGINT) AS n,
         CAST(n AS BIGINT) AS recounted, label AS prediction, leaf
  FROM tree JOIN idx ON idx.pos = tree.pos""")
def tree_nodes(spark, sf):
    """The language tree's nodes (heap numbers), each with the fit's row count and the count of
    the training rows that the compiled expression sends through it."""
    train, test = _split(letter_docs(spark, sf).drop("label").withColumnRenamed("lang", "label"))
    model, _ = CL.tree_models(train, test, "tree")
    table = TR.node_table(spark, model.stages[2])
    rows = model.transform(train)
    counted = TR.recount(rows, table, vector_to_array("indexedFeatures"))
    names = F.array(*[F.lit(v) for v in model.stages[0].labels])
    return table.join(counted, ["tree", "node"]).select(
        "node", "feature", F.round("threshold", 6).alias("threshold"), "n", F.col("recounted").cast("bigint").alias("recounted"),
        F.get(names, F.col("prediction").cast("int")).alias("prediction"), F.col("left").isNull().alias("leaf"))

"""Classification, clustering, recommendation and itemset mining through
``pyspark.ml`` (training runs as distributed aggregates; the fitted model --
coefficients, trees, centres, factors -- is bounded by features, not rows).

Every fitter returns ``(model, predictions)``; seeds are explicit so a fit is
repeatable.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LinearSVC, LinearSVCModel,
                                       LogisticRegression, RandomForestClassifier)
from pyspark.ml.clustering import BisectingKMeans, KMeans
from pyspark.ml.evaluation import ClusteringEvaluator, MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import HashingTF, IndexToString, StringIndexer, Tokenizer, VectorIndexer
from pyspark.ml.fpm import FPGrowth
from pyspark.ml.functions import vector_to_array
from pyspark.ml.recommendation import ALS
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from tessera.operators.skew import hot_keys, join_by_key
from tessera.operators.sorting import with_position
from tessera.session import checkpoint, stored

#: Blocks of users and of items in a factorisation, at least. What a half step ships grows with this
#: number, the tasks that solve it are as many.
ALS_BLOCKS = 3
#: Ratings of a block on average, at most. A task holds its block whole, at about 55 bytes a rating while
#: it is built.
ALS_BLOCK_RATINGS = 75_000_000
#: Factors modulo 2**32, each the other's inverse; below 2**31, so that products of 32-bit ids fit 64 bits.
MIX, UNMIX = 1_354_542_311, 1_217_111_767


def logistic(train: DataFrame, test: DataFrame, max_iter: int = 10, reg: float = 0.3, elastic_net: float = 0.8,
             family: str = "auto", label: str = "label", features: str = "features"):
    """Elastic-net logistic regression (binomial or multinomial)."""
    model = LogisticRegression(maxIter=max_iter, regParam=reg, elasticNetParam=elastic_net, family=family,
                               labelCol=label, featuresCol=features).fit(train)
    return model, model.transform(test)


def logistic_with_params(train: DataFrame, test: DataFrame, overrides: dict, label: str = "label"):
    """Fit with a parameter map: a base estimator (maxIter 10, regParam 0.01)
    whose params are overridden at ``fit`` time; the later value wins."""
    lr = LogisticRegression(maxIter=10, regParam=0.01, labelCol=label)
    pm = {getattr(lr, k): v for k, v in overrides.items()}
    model = lr.fit(train, pm)
    return model, model.transform(test)


def linear_svc(train: DataFrame, test: DataFrame, max_iter: int = 10, reg: float = 0.1, label: str = "label"):
    model = LinearSVC(maxIter=max_iter, regParam=reg, labelCol=label).fit(train)
    return model, model.transform(test)


def tree_models(train: DataFrame, test: DataFrame, kind: str, label: str = "label", features: str = "features",
                max_categories: int = 4, seed: int = 42):
    """Decision tree, random forest (10 trees, labels mapped back) or gradient-boosted
    trees (10 rounds) in one fitted pipeline."""
    if kind == "tree":
        clf = DecisionTreeClassifier(seed=seed)
    elif kind == "forest":
        clf = RandomForestClassifier(numTrees=10, seed=seed)
    elif kind == "gbt":
        clf = GBTClassifier(maxIter=10, seed=seed)
    else:
        raise ValueError(kind)
    # indexers are fitted on all rows: a label or category only the test split has must not fail
    whole = train.select(label, features).unionByName(test.select(label, features))
    label_model = StringIndexer(inputCol=label, outputCol="indexedLabel").fit(whole)
    stages = [label_model,
              VectorIndexer(inputCol=features, outputCol="indexedFeatures", maxCategories=max_categories).fit(whole),
              clf.setLabelCol("indexedLabel").setFeaturesCol("indexedFeatures")]
    if kind == "forest":
        stages.append(IndexToString(inputCol="prediction", outputCol="predictedLabel", labels=label_model.labels))
    model = Pipeline(stages=stages).fit(train)
    return model, model.transform(test)


def text_model(text_col: str = "text", label: str = "label", num_features: int = 1000,
                  max_iter: int = 10, reg: float = 0.001) -> Pipeline:
    """Tokenizer -> hashed term counts -> logistic regression."""
    return Pipeline(stages=[Tokenizer(inputCol=text_col, outputCol="words"),
                            HashingTF(inputCol="words", outputCol="features", numFeatures=num_features),
                            LogisticRegression(maxIter=max_iter, regParam=reg, labelCol=label)])


def save_and_load(model: PipelineModel, path: str) -> PipelineModel:
    """Persist a fitted pipeline (to a shared folder) and load it back."""
    model.write().overwrite().save(path)
    return PipelineModel.load(path)


def accuracy(predictions: DataFrame, label: str = "label", prediction: str = "prediction") -> float:
    return MulticlassClassificationEvaluator(labelCol=label, predictionCol=prediction,
                                             metricName="accuracy").evaluate(predictions)


def kmeans_ml(df: DataFrame, k: int = 2, seed: int = 1, features: str = "features"):
    model = KMeans(k=k, seed=seed, featuresCol=features).fit(df)
    return model, model.transform(df)


def bisecting_kmeans(df: DataFrame, k: int = 2, max_iter: int = 5, seed: int = 1, features: str = "features"):
    model = BisectingKMeans(k=k, maxIter=max_iter, seed=seed, featuresCol=features).fit(df)
    return model, model.transform(df)


def silhouette_ml(predictions: DataFrame, features: str = "features") -> float:
    return ClusteringEvaluator(featuresCol=features).evaluate(predictions)


def coefficients(model) -> DataFrame:
    """``(class_id, feature, value)`` of a fitted linear model; feature -1 is the intercept."""
    spark = SparkSession.active()
    if isinstance(model, LinearSVCModel):
        rows, intercepts = [model.coefficients.toArray()], [model.intercept]
    else:
        rows, intercepts = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    cells = [(c, f, float(v)) for c, row in enumerate(rows) for f, v in [(-1, intercepts[c]), *enumerate(row)]]
    return spark.createDataFrame(cells, "class_id int, feature int, value double")


def centres(model) -> DataFrame:
    """``(cluster, pos, value)`` of a fitted (bisecting) K-means."""
    cells = [(c, i, float(v)) for c, centre in enumerate(model.clusterCenters()) for i, v in enumerate(centre)]
    return SparkSession.active().createDataFrame(cells, "cluster int, pos int, value double")


def clustering_summary(model, predictions: DataFrame, features: str = "features") -> DataFrame:
    """``(cost, silhouette)``: the summed squared distance to the own centre, and the mean
    silhouette of the predictions."""
    cost = predictions.agg(F.sum(_nearest(predictions, model, features)[0])).first()[0]
    return SparkSession.active().createDataFrame([(cost, silhouette_ml(predictions, features))], "cost double, silhouette double")


def test_error(predictions: DataFrame, label: str = "label", prediction: str = "prediction") -> float:
    return 1.0 - accuracy(predictions, label, prediction)


def _numbers(values) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def _dot(x: Column, weights) -> Column:
    return F.aggregate(F.zip_with(x, _numbers(weights), lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)


def _close(a: Column, b: Column) -> Column:
    return F.abs(a - b) <= 1e-6 * (1.0 + F.abs(b))


def follows_linear(model, features: str = "features", probability: str = "probability") -> Column:
    """Whether a scored row's raw values are its features times the model's coefficients plus
    intercept, and its prediction is the class they decide."""
    x, raw = vector_to_array(features), vector_to_array("rawPrediction")
    if isinstance(model, LinearSVCModel):
        m = _dot(x, model.coefficients.toArray()) + float(model.intercept)
        return _close(raw[1], m) & (F.col("prediction") == (raw[1] > model.getThreshold()).cast("double"))
    matrix, intercepts = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    margins = [_dot(x, row) + float(b) for row, b in zip(matrix, intercepts)]
    if len(margins) == 1:
        chosen = (vector_to_array(probability)[1] > model.getThreshold()).cast("double")
        return _close(raw[1], margins[0]) & (F.col("prediction") == chosen)
    same = F.lit(True)
    for c, m in enumerate(margins):
        same = same & _close(raw[c], m)
    return same & (F.col("prediction") == _argmax(raw))


def _argmax(values: Column) -> Column:
    return (F.array_position(values, F.array_max(values)) - 1).cast("double")


def follows_votes() -> Column:
    """Whether a tree model's prediction is the class with the largest raw value."""
    return F.col("prediction") == _argmax(vector_to_array("rawPrediction"))


def _nearest(predictions: DataFrame, model, features: str) -> tuple[Column, Column]:
    """(squared distance to the predicted centre, whether no other centre is nearer)."""
    x = vector_to_array(features)
    d = F.array(*[F.aggregate(F.zip_with(x, _numbers(c), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda a, b: a + b)
                  for c in model.clusterCenters()])
    own = F.get(d, F.col("prediction"))
    return own, own <= F.array_min(d) + 1e-6


def nearest_centre(predictions: DataFrame, model, features: str = "features") -> Column:
    return _nearest(predictions, model, features)[1]


def _factors(factors: DataFrame, key: str, out: str) -> DataFrame:
    return factors.select(F.col("id").alias(key), F.col("features").alias(out))


def factor_product(scored: DataFrame, model) -> DataFrame:
    """``scored`` of ``als`` plus ``is_product``: the prediction is the product of the user's
    and the item's factors. The user's factors came along from ``als``; the item's join on the
    key by which the model has just dealt the rows."""
    if "_uf" not in scored.columns:
        scored = scored.join(_factors(model.userFactors, "_user", "_uf"), "_user")
    terms = F.zip_with("_uf", "_if", lambda a, b: a.cast("double") * b.cast("double"))
    product = F.aggregate(terms, F.lit(0.0), lambda a, b: a + b)
    size = F.aggregate(terms, F.lit(1.0), lambda a, b: a + F.abs(b))  # the model adds in single precision
    return (scored.join(_factors(model.itemFactors, "_item", "_if"), "_item")
            .withColumn("is_product", F.abs(product - F.col("prediction")) <= 1e-5 * size).drop("_uf", "_if"))


def _dense(rows: DataFrame, col: str, out: str) -> DataFrame:
    """``rows`` plus ``out``: 0, 1, 2, ... for the distinct values of ``col`` in their order. The
    factoriser takes 32-bit ids; values may be any 64-bit integers."""
    ids = with_position(rows.select(col).distinct(), [col], "_pos")
    ids = checkpoint(ids.select(col, (F.col("_pos") - 1).cast("int").alias(out)))
    return join_by_key(rows, ids, col, hot_keys(rows, col))


def _fits_int(rows: DataFrame, cols: list[str]) -> list[bool]:
    """Whether all values of each column are whole numbers of 32 bits."""
    ends = rows.agg(*[f(c) for c in cols for f in (F.min, F.max)]).first()
    whole = [isinstance(rows.schema[c].dataType, IntegralType) for c in cols]
    return [w and ends[2 * k] is not None and -(1 << 31) <= ends[2 * k] and ends[2 * k + 1] < 1 << 31
            for k, w in enumerate(whole)]


def _fold(low: Column) -> Column:
    return low.bitwiseXOR(F.shiftright(low, 16))  # its own inverse below 2**32


def _mixed(key: Column) -> Column:
    """Another 32-bit id for each, one to one, with even remainders."""
    low = ((key.cast("bigint") + (1 << 31)) * MIX).bitwiseAND(F.lit((1 << 32) - 1))
    return (_fold(low) - (1 << 31)).cast("int")


def _unmixed(key: Column) -> Column:
    return (_fold(key.cast("bigint") + (1 << 31)) * UNMIX).bitwiseAND(F.lit((1 << 32) - 1)) - (1 << 31)


def _uneven(rows: DataFrame, key: str, blocks: int) -> bool:
    """Whether a block gets over a quarter more ratings than the mean. The factoriser deals 32-bit ids to
    blocks by their remainder: ids in steps, or with every third one missing, fill some blocks only."""
    sizes = rows.groupBy(F.pmod(key, F.lit(blocks))).agg(F.count(F.lit(1)).alias("_n"))
    most, total = sizes.agg(F.max("_n"), F.sum("_n")).first()
    return most * blocks > 1.25 * total


def als(ratings: DataFrame, rank: int = 10, max_iter: int = 10, reg: float = 0.01, seed: int = 42,
        user: str = "user_id", item: str = "item_id", rating: str = "rating"):
    """Alternating least squares over any 64-bit ids (``_user`` and ``_item`` are what the
    factoriser takes for them: ids of 32 bits as they are, or ``_mixed``, else dense numbers);
    ``coldStartStrategy='drop'`` keeps NaN predictions for unseen ids out of the result. The
    ratings are stored once for the fit and the scoring.

    Every half step sends each factor to nearly every block of the other side, so the blocks
    are few (``ALS_BLOCKS``), until one would hold more than ``ALS_BLOCK_RATINGS``. The factoriser
    builds them in memory that Spark does not manage, and what it caches does not make room for
    that: its intermediate tables lie on disk. For scoring, the user's factors join first, by the
    key on which the model joins them again, so that both need one exchange of the ratings;
    ``factor_product`` does the same with the item's. Keys with many ratings would then stay in one
    task: where there are such, each of these joins deals the rows out anew."""
    rows = stored(ratings.filter(F.col(user).isNotNull() & F.col(item).isNotNull()), "ratings")
    blocks, restored = max(ALS_BLOCKS, -(-rows.count() // ALS_BLOCK_RATINGS)), {}
    for col, out, fits in zip((user, item), ("_user", "_item"), _fits_int(rows, [user, item])):
        if fits:
            mix = _uneven(rows, col, blocks)
            restored[col] = (_unmixed(F.col(out)) if mix else F.col(out)).cast(rows.schema[col].dataType)
            rows = rows.withColumnRenamed(col, out).withColumn(out, _mixed(F.col(out)) if mix else F.col(out).cast("int"))
        else:
            rows = stored(_dense(rows, col, out), "numbered")
    # no id is null: said so, the model's own check for nulls does not hide how the rows are dealt
    rows = rows.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("_user", "_item")})
    model = ALS(rank=rank, maxIter=max_iter, regParam=reg, seed=seed, userCol="_user", itemCol="_item", ratingCol=rating,
                numUserBlocks=blocks, numItemBlocks=blocks, intermediateStorageLevel="DISK_ONLY", coldStartStrategy="drop").fit(rows)
    hot_users, hot_items = hot_keys(rows, "_user"), hot_keys(rows, "_item")
    scored = model.transform(join_by_key(rows, _factors(model.userFactors, "_user", "_uf"), "_user", hot_users))
    if not hot_items.none:
        scored = checkpoint(scored)
    return model, scored.withColumns(restored)


def rmse(predictions: DataFrame, label: str = "rating", prediction: str = "prediction") -> float:
    return RegressionEvaluator(labelCol=label, predictionCol=prediction, metricName="rmse").evaluate(predictions)


def freq_itemsets(baskets: DataFrame, items: str = "items", min_support: float = 0.2,
                  num_partitions: int | None = None) -> DataFrame:
    """Frequent itemsets by parallel FP-growth: ``(items array, freq)``. Items in a
    basket are made distinct first (repeats would abort the fit)."""
    fp = FPGrowth(itemsCol="_items", minSupport=min_support)
    if num_partitions:
        fp = fp.setNumPartitions(num_partitions)
    model = fp.fit(baskets.select(F.array_distinct(F.col(items)).alias("_items")))
    return model.freqItemsets


def train_test_split(df: DataFrame, train_share: float = 0.7, seed: int = 42, id_col: str | None = None):
    """70/30 (by default) split. With ``id_col`` the split is by ``pmod(id, 10)`` --
    repeatable in any engine; otherwise ``randomSplit`` with an explicit seed."""
    if id_col is not None:
        buckets = int(round(train_share * 10))
        is_train = F.pmod(F.col(id_col), F.lit(10)) < buckets
        return df.filter(is_train), df.filter(~is_train)
    train, test = df.randomSplit([train_share, 1.0 - train_share], seed=seed)
    return train, test

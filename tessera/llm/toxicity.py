"""Toxicity as an ordinal severity: cumulative-link regression on sparse text features.

P(grade >= k | x) = sigmoid(w.x - t_k) with one weight vector w for all grades and ordered
thresholds t_1 < t_2 < ...; the output is the expected grade. Features are words and
four-letter word beginnings, present or not, whose document frequency differs between
toxic and clean labelled rows.

The labels say toxic or not. Grades of toxic rows are therefore made from their text:
thirds (``GRADES`` parts) of the number of distinct features that almost only toxic rows
have.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import materialise

#: Labelled texts the model is fitted on at most (those with the smallest id hash), and the
#: largest number of words and beginnings it uses.
FIT_ROWS, FEATURES = 40_000, 1_024
GRADES, LEAST_ROWS, LEAST_CHI2, STEM = 3, 5, 20.0, 4
#: A document is rejected when P(grade >= 1) reaches this.
REJECT = 0.5
_WORD = re.compile(r"[^\W_]+")


def text_features(text: str | None) -> set[str]:
    """Distinct words and beginnings ('idio*') of a whole text."""
    words = set(_WORD.findall((text or "").lower()))
    return words | {w[:STEM] + "*" for w in words if len(w) > STEM}


@dataclass
class SeverityModel:
    names: list[str]
    weights: np.ndarray
    thresholds: np.ndarray

    def __post_init__(self):
        self.index = {n: i for i, n in enumerate(self.names)}

    def design(self, text: str | None) -> list[int]:
        """Sparse row of the text: its features, in order."""
        index = self.index
        return sorted(index[f] for f in text_features(text) if f in index)

    def reach(self, score: float) -> np.ndarray:
        """P(grade >= k) for k = 1.. of a linear score."""
        return 1 / (1 + np.exp(-np.clip(score - self.thresholds, -60, 60)))

    def predict(self, text: str | None) -> tuple[float, float]:
        """(expected grade, P(grade >= 1))."""
        p = self.reach(float(self.weights[self.design(text)].sum()))
        return float(p.sum()), float(p[0])


def fit_thresholds(rows: list[list[int]], grades: np.ndarray, n_columns: int, n_grades: int,
                   start: np.ndarray | None = None, steps: int = 1000, rate: float = 0.1, penalty: float = 2e-5) -> tuple[np.ndarray, np.ndarray]:
    """(weights, ordered thresholds) by full-batch Adam on the mean negative log-likelihood."""
    row = np.repeat(np.arange(len(rows)), [len(c) for c in rows])
    col = np.array([c for cs in rows for c in cs], np.int64)
    n = len(rows)
    # thresholds t_1 and t_k = t_(k-1) + exp(gap_k): ordered by construction
    params = np.concatenate([np.zeros(n_columns) if start is None else start, [2.0], np.zeros(n_grades - 1)])
    m, v = np.zeros_like(params), np.zeros_like(params)
    weight = 1 / n
    for step in range(1, steps + 1):
        w, first, gaps = params[:n_columns], params[n_columns], params[n_columns + 1:]
        t = first + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])
        score = np.bincount(row, w[col], n) if len(col) else np.zeros(n)
        reach = 1 / (1 + np.exp(-np.clip(score[:, None] - t, -60, 60)))
        full = np.hstack([np.ones((n, 1)), reach, np.zeros((n, 1))])
        slope = np.hstack([np.zeros((n, 1)), reach * (1 - reach), np.zeros((n, 1))])
        at = np.arange(n)
        p = np.maximum(full[at, grades] - full[at, grades + 1], 1e-12)
        d_score = -weight * (slope[at, grades] - slope[at, grades + 1]) / p
        d_t = np.zeros(n_grades + 2)
        np.add.at(d_t, grades, weight * slope[at, grades] / p)
        np.add.at(d_t, grades + 1, -weight * slope[at, grades + 1] / p)
        d_t = d_t[1:-1]
        tail = np.cumsum(d_t[::-1])[::-1]
        grad = np.concatenate([(np.bincount(col, d_score[row], n_columns) if len(col) else np.zeros(n_columns)) + penalty * w,
                               [tail[0]], tail[1:] * np.exp(gaps)])
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        params = params - rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return params[:n_columns], params[n_columns] + np.concatenate([[0.0], np.cumsum(np.exp(params[n_columns + 1:]))])


def _sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, fit_rows: int) -> DataFrame:
    marks = (labels.select(labels[id_col].alias("id"), labels["toxic"].alias("toxic")).dropna()
             .groupBy("id").agg((F.max("toxic") > 0).cast("int").alias("toxic")))
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    # equal texts count once, else a few copied rows would look like evidence
    texts = (rows.select("id", F.xxhash64("text").alias("hash")).join(marks, "id")
             .groupBy("hash").agg(F.min("id").alias("id"), F.max("toxic").alias("toxic")))
    texts = materialise(texts, "labelled")
    # the ids in the lowest part of the hash range: fit_rows of them at most (five per cent, ten
    # standard deviations, below on average), so they are broadcast and no text is shuffled
    part = min(1.0, 0.95 * fit_rows / max(1, texts.count()))
    drawn = F.shiftrightunsigned(F.xxhash64("id"), 11) <= F.lit(int(part * (1 << 53)))
    chosen = texts.filter(drawn).select("id", "toxic").distinct()
    return rows.join(F.broadcast(chosen), "id").select("toxic", "text")


def _informative(sample: DataFrame, features: int) -> tuple[dict[str, float], list[str]]:
    """(log odds of the features with the largest chi-square of presence in toxic and clean
    rows, those features that almost only toxic rows use)."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n: dict[str, list[int]] = {}
            for toxic, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for f in (*text_features(text), ""):  # "" counts the rows themselves
                    n.setdefault(f, [0, 0])[toxic] += 1
            yield pa.RecordBatch.from_arrays([pa.array(n, pa.string()), pa.array([x[0] for x in n.values()], pa.int64()),
                                              pa.array([x[1] for x in n.values()], pa.int64())], names=["f", "c", "t"])

    counts = (sample.mapInArrow(count, "f string, c bigint, t bigint").groupBy("f")
              .agg(F.sum("c").alias("c"), F.sum("t").alias("t")).filter(F.col("t") >= LEAST_ROWS))
    top = counts.crossJoin(F.broadcast(counts.filter("f = ''").select(F.col("c").alias("all_c"), F.col("t").alias("all_t"))))
    n = F.col("all_c") + F.col("all_t")
    gap = F.col("t") * (F.col("all_c") - F.col("c")) - F.col("c") * (F.col("all_t") - F.col("t"))
    rest = (F.col("c") + F.col("t")) * (n - F.col("c") - F.col("t")) * F.col("all_c") * F.col("all_t")
    chi2 = F.try_divide(n * gap.cast("double") * gap.cast("double"), rest.cast("double"))
    rows = (top.withColumn("chi2", chi2).filter((F.col("chi2") >= LEAST_CHI2) & (F.col("f") != ""))
            .orderBy(F.col("chi2").desc(), "f").limit(features).collect())
    odds = {r["f"]: math.log((r["t"] + 0.5) / (r["all_t"] + 1)) - math.log((r["c"] + 0.5) / (r["all_c"] + 1)) for r in rows}
    return odds, [f for f, o in odds.items() if o > math.log(20)]


def fit_severity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 fit_rows: int = FIT_ROWS, features: int = FEATURES, grades: int = GRADES) -> SeverityModel:
    """The model of ``labels`` (id, toxic 0/1), fitted on at most ``fit_rows`` labelled rows.

    Without labelled rows, or with one class only, no feature is informative and every
    document gets the severity of the thresholds alone."""
    sample = _sample(docs, labels, id_col, text_col, fit_rows)
    odds, markers = _informative(sample, features)
    names = list(odds)
    model = SeverityModel(names, np.zeros(len(names)), np.arange(2.0, 2.0 + grades))
    marked = {i for i, f in enumerate(names) if f in set(markers)}

    def design(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = [model.design(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(cols, pa.list_(pa.int32()))], names=["toxic", "cols"])

    rows = sample.mapInArrow(design, "toxic int, cols array<int>").toPandas() if names else None
    if rows is None or rows["toxic"].nunique() < 2:
        return model
    pairs = sorted(zip(rows["toxic"].tolist(), map(list, rows["cols"])))  # one order, so that refits agree
    toxic = np.array([t for t, _ in pairs]) > 0
    found = np.array([len(marked.intersection(cols)) for _, cols in pairs])
    cuts = np.quantile(found[toxic], np.arange(1, grades) / grades)
    grade = np.where(toxic, 1 + np.searchsorted(cuts, found, side="left"), 0)
    model.weights, model.thresholds = fit_thresholds([cols for _, cols in pairs], grade, len(names), grades,
                                                     np.array([*odds.values()]) / 3)
    return model


def severity(model: SeverityModel, text):
    """Struct column (severity, p_toxic) of a text column, by a vectorised function."""
    schema = T.StructType([T.StructField("severity", T.DoubleType()), T.StructField("p_toxic", T.DoubleType())])

    @F.pandas_udf(schema)
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in parts:
            yield pd.DataFrame([model.predict(t) for t in texts], columns=["severity", "p_toxic"], dtype=float)

    return score(text)


def toxicity_report(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    reject: float = REJECT, **fit) -> DataFrame:
    """One row per document: doc_id, severity (expected grade, 0 to ``GRADES``), p_toxic, toxic.

    Null and empty texts have no features and score as such. Repeated rows score alike.
    Labels of unknown ids and null labels are ignored; a document labelled twice is toxic
    if any label says so. Empty table: empty result. Other columns are not read."""
    model = fit_severity(docs, labels, id_col, text_col, **fit)
    scored = docs.select(docs[id_col].alias("doc_id"), severity(model, docs[text_col]).alias("s"))
    return scored.select("doc_id", "s.severity", "s.p_toxic", (F.col("s.p_toxic") >= reject).alias("toxic"))


def keep_clean(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               reject: float = REJECT, **fit) -> DataFrame:
    """The rows of ``docs`` that are not rejected, all columns; no shuffle."""
    model = fit_severity(docs, labels, id_col, text_col, **fit)
    packed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), severity(model, docs[text_col]).alias("s"))
    return packed.filter(F.col("s.p_toxic") < reject).select("doc.*")

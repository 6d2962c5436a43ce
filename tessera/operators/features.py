"""Feature operators: assembling, scaling, indexing, tokenizing, hashing.

These use ``pyspark.ml`` transformers (JVM side). Fitting an indexer or scaler is
one distributed aggregate; the fitted state (label list, means and deviations)
is bounded by the number of categories or features, not by the rows.
"""

from __future__ import annotations

from pyspark.ml.feature import (HashingTF, IndexToString, Normalizer, StandardScaler, StringIndexer, Tokenizer,
                                VectorAssembler, VectorIndexer)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.skew import hot_keys, join_by_key
from tessera.operators.sorted_store import order_by, write_sorted

from tessera.functions.text import tokens_of
from tessera.session import spread


def to_vector(df: DataFrame, array_col: str, out: str = "features") -> DataFrame:
    """``array<float|double>`` -> ml dense vector."""
    return df.withColumn(out, array_to_vector(F.col(array_col)))


def explode_vector(df: DataFrame, vec_col: str, keep: tuple, digits: int | None = 6) -> DataFrame:
    """``(keep..., pos, value)`` rows from a vector column (comparable as a table)."""
    out = df.select(*keep, F.posexplode(vector_to_array(vec_col)).alias("pos", "value"))
    return out.withColumn("value", F.round("value", digits)) if digits is not None else out


def assemble(df: DataFrame, cols: list[str], out: str = "features", handle_invalid: str = "skip") -> DataFrame:
    """Columns -> one vector; rows with a null or NaN input are skipped (the
    default would fail the job)."""
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid=handle_invalid).transform(df)


def normalize(df: DataFrame, vec_col: str, p: float = 2.0, out: str = "normed") -> DataFrame:
    """Scale each row to unit p-norm (``p=float('inf')`` for the max norm)."""
    return Normalizer(inputCol=vec_col, outputCol=out, p=p).transform(df)


def standardize(df: DataFrame, vec_col: str, with_mean: bool = False, with_std: bool = True,
                out: str = "scaled") -> DataFrame:
    """Column-wise scaling by the sample standard deviation, optionally centred."""
    model = StandardScaler(inputCol=vec_col, outputCol=out, withMean=with_mean, withStd=with_std).fit(df)
    return model.transform(df)


def string_index(df: DataFrame, col: str, out: str = "idx", order: str = "frequencyDesc"):
    """Index labels by frequency, most frequent = 0, ties alphabetical. Returns
    ``(indexed DataFrame, fitted model)``."""
    model = StringIndexer(inputCol=col, outputCol=out, stringOrderType=order).fit(df)
    return model.transform(df), model


def label_dictionary(df: DataFrame, col: str, path: str) -> DataFrame:
    """``(label, idx)``: every label with its place by falling frequency, ties alphabetical -- the order of
    ``string_index``, as a table of any size: counts are sorted into a table at ``path``
    (``sorted_store``) and a label's index is its place there. Nulls have no index; no label passes
    the driver."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(F.col(col).cast("string").alias("label")).agg(F.count(F.lit(1)).alias("_n"))
    return write_sorted(counts, order_by("-_n", "label"), path).read("_pos").select("label", (F.col("_pos") - 1).cast("double").alias("idx"))


def index_by_dictionary(df: DataFrame, col: str, dictionary: DataFrame, out: str = "idx") -> DataFrame:
    """``df`` plus ``out`` from a ``label_dictionary``; rows whose label is null or unknown are left out. Frequent
    labels are joined by broadcast, the others by a shuffle (``skew``). Pass a stored or cached ``df``."""
    names = dictionary.select(F.col("label").alias("_label"), F.col("idx").alias(out))
    rows = df.withColumn("_label", F.col(col).cast("string"))
    return join_by_key(rows, names, "_label", hot_keys(rows, "_label")).select(*df.columns, out)


def labels_by_dictionary(df: DataFrame, idx_col: str, dictionary: DataFrame, out: str = "label") -> DataFrame:
    """The way back: ``df`` plus the label of its index; an index that is null or not in the dictionary is left out."""
    names = dictionary.select(F.col("idx").alias("_idx"), F.col("label").alias(out))
    rows = df.withColumn("_idx", F.col(idx_col).cast("double"))
    return join_by_key(rows, names, "_idx", hot_keys(rows, "_idx")).select(*df.columns, out)


def index_to_string(df: DataFrame, idx_col: str, labels: list[str], out: str = "label") -> DataFrame:
    return IndexToString(inputCol=idx_col, outputCol=out, labels=labels).transform(df)


def vector_index(df: DataFrame, vec_col: str, max_categories: int = 4, out: str = "indexed"):
    """Features with at most ``max_categories`` distinct values become category
    indices (sorted values -> 0, 1, ...); others pass through."""
    model = VectorIndexer(inputCol=vec_col, outputCol=out, maxCategories=max_categories).fit(df)
    return model.transform(df), model


def tokenize(df: DataFrame, text_col: str, out: str = "tokens") -> DataFrame:
    """Lower-case, split at every whitespace character (trailing empties dropped)."""
    return Tokenizer(inputCol=text_col, outputCol=out).transform(df)


def term_counts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, term, n)``: Tokenizer tokens counted per row id. The tokens come from
    the same rule written as built-in expressions (``tokens_of``), which stay in
    generated code instead of a per-row transformer function."""
    return (spread(df.select(id_col, text_col)).select(id_col, F.explode(tokens_of(text_col)).alias("term"))
            .groupBy(id_col, "term").agg(F.count(F.lit(1)).alias("n")))


def hashing_tf(df: DataFrame, tokens_col: str, num_features: int = 1 << 18, out: str = "tf") -> DataFrame:
    """Hashed term-frequency vectors (MurmurHash3 of each token mod ``num_features``)."""
    return HashingTF(inputCol=tokens_col, outputCol=out, numFeatures=num_features).transform(df)

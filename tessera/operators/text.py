"""Text operators: lines, word count, top words, search, longest line, first line.

Word counting is ``explode`` + a two-phase hash aggregate: every task combines its
own words before the shuffle, so a very frequent word (one third of all tokens)
costs one row per task, not one row per occurrence.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import LINE_SEP, text_words, word_count_rtrimmed, words_of
from tessera.session import spread


def lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, line_no, line)``: one row per line of every text, ``line_no`` from 0."""
    return spread(docs).select(id_col, F.posexplode(F.split(F.col(text_col), LINE_SEP, -1)).alias("line_no", "line"))


def words(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``(word)``: every one-space word of every line, blanks kept."""
    return spread(docs.select(text_col)).select(F.explode(text_words(text_col)).alias("word"))


def wordcount(docs: DataFrame, text_col: str = "text", drop_blank: bool = False) -> DataFrame:
    """``(word, n)`` over whole texts. Blank words are kept unless ``drop_blank``."""
    w = words(docs, text_col)
    if drop_blank:
        w = w.filter(F.col("word") != "")
    return w.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def wordcount_sorted(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Word counts ordered by count descending, ties by word (range-partitioned sort)."""
    return wordcount(docs, text_col).orderBy(F.desc("n"), F.asc("word"))


def top_words(docs: DataFrame, k: int = 5, text_col: str = "text") -> DataFrame:
    """The ``k`` most frequent non-blank words; ties broken by the word.

    Planned as partial/final aggregate then ``TakeOrderedAndProject``: each task
    keeps only its own k best rows, no global sort."""
    return wordcount(docs, text_col, drop_blank=True).orderBy(F.desc("n"), F.asc("word")).limit(k)


def search_like(line_df: DataFrame, keyword: str, col: str = "line") -> DataFrame:
    """Rows whose ``col`` is ``LIKE '%keyword%'`` with the keyword *unescaped*:
    ``_`` and ``%`` inside it stay wildcards."""
    return line_df.filter(F.col(col).like(f"%{keyword}%"))


def search_contains(line_df: DataFrame, needle: str, col: str = "line") -> DataFrame:
    """Rows whose ``col`` contains ``needle`` literally (pushed to parquet as StringContains)."""
    return line_df.filter(F.col(col).contains(needle))


def search_lines(docs: DataFrame, keyword: str, like: bool = False, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Lines of ``docs`` that contain ``keyword`` (literally, or as an unescaped
    LIKE pattern). A line can only match if its whole text does, so texts are
    first filtered on the text column (a literal keyword reaches the parquet scan as
    ``StringContains``, a LIKE pattern with wildcards is applied right after it) and only
    surviving texts are split into lines."""
    if "\n" in keyword:
        raise ValueError("a line never contains a line break")
    pre = F.col(text_col).like(f"%{keyword}%") if like else F.col(text_col).contains(keyword)
    candidates = lines(docs.filter(pre), id_col, text_col)
    return search_like(candidates, keyword) if like else search_contains(candidates, keyword)


def max_words(line_df: DataFrame, col: str = "line") -> DataFrame:
    """``(max_words)``: the most words on any line, counted as a JVM ``split(" ")`` does."""
    return line_df.agg(F.max(word_count_rtrimmed(col)).cast("bigint").alias("max_words"))


def first_line(line_df: DataFrame, order_cols=("doc_id", "line_no"), col: str = "line") -> DataFrame:
    """The first line in an explicit order, as one global ``min_by`` aggregate
    (partial per task, no sort)."""
    key = F.struct(*[F.col(c) for c in order_cols])
    return line_df.agg(*[F.min_by(F.col(c), key).alias(c) for c in order_cols],
                       F.min_by(F.col(col), key).alias(col))


def count_rows(df: DataFrame) -> DataFrame:
    """``(n)``: number of rows."""
    return df.agg(F.count(F.lit(1)).alias("n"))


__all__ = ["lines", "words", "words_of", "wordcount", "wordcount_sorted", "top_words", "search_like",
           "search_contains", "search_lines", "max_words", "first_line", "count_rows"]

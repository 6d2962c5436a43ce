"""Text keys over ``documents``: a "line" is one row of ``split(text, '\\n')``."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import text as T
from tessera.plans.registry import register
from tessera.plans.relational import sorted_rows
from tessera.sources.tables import table

# Search terms. The LIKE keyword holds a '_' wildcard on purpose.
LIKE_KEYWORD = "an_e"
CONTAINS_NEEDLE = "die"
TOP_K = 5

# DuckDB pieces shared by the oracles below.
LINES_SQL = """
  SELECT doc_id,
         UNNEST(generate_series(0, len(string_split(text, chr(10))) - 1)) AS line_no,
         UNNEST(string_split(text, chr(10))) AS line
  FROM documents"""
WORDS_SQL = "SELECT UNNEST(string_split_regex(text, '[ \\n]')) AS word FROM documents"


def _lines(spark, sf):
    return T.lines(table(spark, sf, "documents", "doc_id", "text"))


@register("top_words", sql=f"""
  SELECT word, CAST(count(*) AS BIGINT) AS n FROM ({WORDS_SQL}) w
  WHERE word <> '' GROUP BY word ORDER BY n DESC, word LIMIT {TOP_K}""")
def top_words(spark, sf):
    return T.top_words(table(spark, sf, "documents", "text"), k=TOP_K)


@register("wordcount", sql=f"""
  SELECT word, CAST(count(*) AS BIGINT) AS n FROM ({WORDS_SQL}) w GROUP BY word""")
def wordcount(spark, sf):
    return T.wordcount(table(spark, sf, "documents", "text"))


@register("wordcount_sorted", sql=f"""
  SELECT CAST(row_number() OVER (ORDER BY n DESC, word) AS BIGINT) AS pos, word, n
  FROM (SELECT word, CAST(count(*) AS BIGINT) AS n FROM ({WORDS_SQL}) w GROUP BY word) c""")
def wordcount_sorted(spark, sf):
    counts = T.wordcount(table(spark, sf, "documents", "text"))
    return sorted_rows(counts, "-n", "word").select("pos", "word", "n")


@register("count_rows", sql=f"SELECT CAST(count(*) AS BIGINT) AS n FROM ({LINES_SQL}) l")
def count_rows(spark, sf):
    return T.count_rows(_lines(spark, sf))


@register("first_line", sql=f"""
  SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, line FROM ({LINES_SQL}) l
  ORDER BY doc_id, line_no LIMIT 1""")
def first_line(spark, sf):
    return T.first_line(_lines(spark, sf))


@register("text_search_like", sql=f"""
  SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, line FROM ({LINES_SQL}) l
  WHERE line LIKE '%{LIKE_KEYWORD}%'""")
def text_search_like(spark, sf):
    return T.search_lines(table(spark, sf, "documents", "doc_id", "text"), LIKE_KEYWORD, like=True)


@register("text_search_contains", sql=f"""
  SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, line FROM ({LINES_SQL}) l
  WHERE contains(line, '{CONTAINS_NEEDLE}')""")
def text_search_contains(spark, sf):
    return T.search_lines(table(spark, sf, "documents", "doc_id", "text"), CONTAINS_NEEDLE)


@register("max_words", sql=f"""
  SELECT CAST(max(CASE WHEN rtrim(line, ' ') = '' AND line <> '' THEN 0
                       ELSE len(string_split(rtrim(line, ' '), ' ')) END) AS BIGINT) AS max_words
  FROM ({LINES_SQL}) l""")
def max_words(spark, sf):
    return T.max_words(_lines(spark, sf))

from tessera.operators import text as T
from tests.conftest import rows


def docs(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")


def test_wordcount_keeps_blank_words(spark):
    d = docs(spark, ["a  b ", "b\n\nc"])
    got = dict(rows(T.wordcount(d), "word", "n"))
    # 'a  b ' -> a, '', b, ''   and  'b\n\nc' -> lines b, '', c
    assert got == {"a": 1, "": 3, "b": 2, "c": 1}


def test_top_words_drops_blanks_and_breaks_ties_by_word(spark):
    d = docs(spark, ["x y z  y z", "w x"])
    got = rows(T.top_words(d, k=3), "word", "n")
    assert got == [("x", 2), ("y", 2), ("z", 2)]


def test_sum_by_key_word_pairs(spark):
    from tessera.operators.relational import sum_by_key
    df = spark.createDataFrame([("This", 2), ("is", 3), ("Spark", 5), ("is", 3)], "word string, n int")
    assert dict(rows(sum_by_key(df, "word", "n"), "word", "total")) == {"This": 2, "is": 6, "Spark": 5}


def test_max_words_counts_like_a_jvm_split(spark):
    lines = spark.createDataFrame([("a b c   ",), ("   ",), ("",), (" a",)], "line string")
    assert T.max_words(lines).first()[0] == 3
    from tessera.functions.text import word_count_rtrimmed
    got = [r[0] for r in lines.select(word_count_rtrimmed("line")).collect()]
    assert got == [3, 0, 1, 2]


def test_like_keeps_wildcards_contains_is_literal(spark):
    lines = spark.createDataFrame([("axb",), ("a_b",), ("ab",)], "line string")
    assert sorted(rows(T.search_like(lines, "a_b"), "line")) == [("a_b",), ("axb",)]
    assert rows(T.search_contains(lines, "a_b"), "line") == [("a_b",)]


def test_first_line_is_in_explicit_order(spark):
    d = docs(spark, ["zeta\nsecond", "alpha"])
    got = T.first_line(T.lines(d)).first()
    assert (got["doc_id"], got["line_no"], got["line"]) == (0, 0, "zeta")


def test_lines_positions(spark):
    d = docs(spark, ["a\nb\n"])
    assert rows(T.lines(d).orderBy("line_no"), "line_no", "line") == [(0, "a"), (1, "b"), (2, "")]

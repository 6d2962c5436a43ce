"""Column expressions for text: lines, one-space words, Tokenizer-style tokens.

All are built-in Spark SQL expressions (JVM side, inside whole-stage codegen).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Separators that define a line and a word.
LINE_SEP = "\n"
WORD_SEP = " "
# A word is what lies between single spaces *or* line breaks: splitting a text into
# lines and each line at every space gives exactly the pieces of one split on either.
WORD_OR_LINE_SEP = "[ \n]"


def words_of(text: Column | str) -> Column:
    """Array of one-space words, blanks kept (Python ``str.split(' ')`` semantics)."""
    return F.split(F.col(text) if isinstance(text, str) else text, WORD_SEP, -1)


def text_words(text: Column | str) -> Column:
    """All words of a multi-line text, line by line, blanks kept."""
    return F.split(F.col(text) if isinstance(text, str) else text, WORD_OR_LINE_SEP, -1)


def word_count_rtrimmed(line: Column | str) -> Column:
    """Words on a line the way a JVM ``split(" ")`` counts them: trailing blanks are
    dropped, a line of only spaces has 0 words, an empty line has 1."""
    c = F.col(line) if isinstance(line, str) else line
    trimmed = F.rtrim(c)
    return F.when((trimmed == "") & (c != ""), F.lit(0)).otherwise(F.size(F.split(trimmed, WORD_SEP, -1)))


def letter_shares(lowered: str, length: str, letters: list[str]) -> list[Column]:
    """Share of each letter among the characters of an already lower-cased text
    column ``lowered`` of length ``length`` (lower-case once, then count each
    letter as the length lost by deleting it)."""
    n = F.greatest(F.col(length), F.lit(1))
    return [((F.col(length) - F.length(F.replace(F.col(lowered), F.lit(ch), F.lit("")))) / n).alias(f"f{i}")
            for i, ch in enumerate(letters)]


def tokens_of(text: Column | str) -> Column:
    """Tokenizer semantics as built-in expressions: lower-case, split at every
    whitespace character, trailing empty tokens dropped (a JVM ``split("\\\\s")``:
    an empty text gives one empty token, a text of only whitespace none)."""
    low = F.lower(F.col(text) if isinstance(text, str) else text)
    trimmed = F.regexp_replace(low, r"\s+$", "")
    return (F.when(low == "", F.array(F.lit("")))
            .when(trimmed == "", F.array().cast("array<string>"))
            .otherwise(F.split(trimmed, r"\s", -1)))

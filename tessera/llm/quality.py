"""Quality rules whose cutoffs come with a guarantee.

A rule rejects a document when a feature lies beyond a cutoff. Cutoffs are chosen per
stratum on labelled rows: among the candidates of a fixed grid, the strictest whose
false-rejection rate (good rows rejected) is shown by an exact one-sided binomial
(Clopper-Pearson) bound to be at most ``max_false`` -- at a confidence that is
corrected (Bonferroni) for every test made: strata x rules x candidates. With
probability ``confidence`` no chosen cutoff, in any stratum, rejects more than
``max_false`` of the good documents there.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import exp, inf, lgamma, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialise

# Fixed values of the contract.
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 50, 50, 3
SYMBOLS, SPACES = "#*$%&|<>", " \t\n\v\f\r"
#: Per rule and stratum; with five rules a stratum loses at most 7.5 % of its good documents.
MAX_FALSE, CONFIDENCE = 0.015, 0.95
FEATURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


@dataclass(frozen=True)
class Rule:
    """Reject when ``expr`` (SQL over the base columns) exceeds the cutoff; ``grid`` holds
    the candidate cutoffs, fixed in advance, strictest first."""

    name: str
    expr: str
    grid: tuple[float, ...]


RULES = (
    Rule("repeat_share", "n_repeat_words / nullif(n_words, 0)", (0.02, 0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.45)),
    Rule("symbols_per_word", "n_symbols / nullif(n_words, 0)", (0.01, 0.02, 0.05, 0.1, 0.15, 0.2, 0.3, 0.5, 0.75, 1.0)),
    Rule("dup_lines_per_100_words", "100 * n_dup_lines / nullif(n_words, 0)", (0.1, 0.2, 0.5, 1, 1.5, 2, 3, 5, 7.5, 10)),
    Rule("long_words", "word_chars / nullif(n_words, 0)", (6, 6.5, 7, 7.5, 8, 9, 10, 12, 15, 20)),
    Rule("short_words", "- word_chars / nullif(n_words, 0)", (-5, -4.5, -4, -3.5, -3, -2.5, -2, -1.75, -1.5, -1.25)),
)


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of a whole text."""
    if not text:
        return 0, 0, 0, 0, 0
    words = text.encode().split()  # bytes: ASCII white space only
    n = len(words)
    chars = len(text) - sum(map(text.count, SPACES))
    symbols = sum(map(text.count, SYMBOLS))
    seen, dup = set(), 0
    for line in text.split("\n"):
        if line in seen:
            dup += 1
        elif line.strip(SPACES):
            seen.add(line)
    if n < WINDOW:
        return n, chars, symbols, dup, 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    pairs = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)[1]
    _, at, times = np.unique(pairs[:-1] * len(number) + ids[2:], return_inverse=True, return_counts=True)
    again = times[at] > 1
    covered = np.zeros(n, bool)
    for k in range(WINDOW):
        covered[k:n - WINDOW + 1 + k] |= again
    return n, chars, symbols, dup, int(covered.sum())


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """(doc_id, stratum, text_hash, base counts) per row."""
    rows = docs.select(docs[id_col].alias("doc_id"), docs[stratum_col].cast("string").alias("stratum"),
                       docs[text_col].alias("text"), F.xxhash64(docs[text_col]).alias("text_hash"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [base_counts(x.as_py()) for x in b.column(2)]
            cols = [pa.array(c, pa.int64()) for c in (zip(*got) if got else [[]] * 5)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(3), *cols],
                                             names=["doc_id", "stratum", "text_hash", *FEATURES])

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {id_type}, stratum string, text_hash bigint, " + ", ".join(f"{f} bigint" for f in FEATURES))


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) of Binomial(n, p), exact up to rounding."""
    if k >= n:
        return 1.0
    base = lgamma(n + 1)
    return min(1.0, sum(exp(base - lgamma(i + 1) - lgamma(n - i + 1) + i * log(p) + (n - i) * log(1 - p))
                        for i in range(k + 1)))


def shown(k: int, n: int, max_false: float, alpha: float) -> bool:
    """The exact upper bound at level ``alpha`` on the rate behind k of n is at most
    ``max_false``: that many or fewer would be seen with probability <= alpha if the rate
    were ``max_false``."""
    return 0 < n and k <= n * max_false and binomial_tail(k, n, max_false) <= alpha


def thresholds(labelled: DataFrame, rules=RULES, max_false: float = MAX_FALSE,
               confidence: float = CONFIDENCE) -> dict[str | None, dict[str, float]]:
    """stratum -> rule -> cutoff, from (stratum, base counts, good) rows: one aggregate of
    one row per stratum, over all labelled rows.

    The error is shared by strata and rules (Bonferroni). The cutoffs of one rule are tested in a
    fixed order, from the mildest on, each at the full level of the rule, until one is not shown
    safe: a milder cutoff rejects part of what a stricter one does, so the first true
    violation must be rejected falsely before any other can be (fixed-sequence testing)."""
    value = {r.name: F.expr(f"CAST({r.expr} AS DOUBLE)") for r in rules}
    hits = [F.sum((value[r.name] > F.lit(float(c))).cast("bigint")).alias(f"{r.name}_{i}")
            for r in rules for i, c in enumerate(r.grid)]
    good = labelled.filter("good AND n_words > 0")
    rows = good.groupBy("stratum").agg(F.count(F.lit(1)).alias("n"), *hits).collect()
    alpha = (1 - confidence) / max(1, len(rows) * len(rules))
    out: dict[str | None, dict[str, float]] = {}
    for row in rows:
        cut = {}
        for r in rules:
            cut[r.name] = inf
            for i, c in sorted(enumerate(r.grid), key=lambda x: -x[1]):
                if not shown(row[f"{r.name}_{i}"] or 0, row["n"], max_false, alpha):
                    break
                cut[r.name] = c
        out[row["stratum"]] = cut
    return out


def _base_failed():
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def quality_report(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   stratum_col: str = "lang", rules=RULES, max_false: float = MAX_FALSE,
                   confidence: float = CONFIDENCE) -> DataFrame:
    """One row per document: doc_id, base counts, base_failed, kept, stratum, failed_rules.

    ``labels`` (id, quality) are the holdout; rows that fail the base rule take no part
    in choosing cutoffs, as the rules never decide them. Null text: counts 0, base
    failed. A null stratum is a stratum of its own; a stratum without enough labelled
    good texts has no cutoffs and keeps all that the base rule keeps. Copies of a text are one trial;
    a value equal to a cutoff passes; a very long text is counted whole. The verdict is one
    expression per stratum and rule: use a column of few values (languages). Labels of unknown
    ids, null ids and null labels are ignored; a document labelled twice counts once,
    good only if all its labels are. Empty tables: empty result, or no cutoffs."""
    rows = materialise(features(docs, id_col, text_col, stratum_col).withColumn("base_failed", _base_failed()), "features")
    marks = (labels.select(labels[id_col].alias("doc_id"), labels["quality"].alias("quality")).dropna()
             .groupBy("doc_id").agg((F.min("quality") > 0).alias("good")))
    # copies are one trial: a text counts once in its stratum, good only if all its labels are
    trials = (rows.filter("NOT base_failed").join(marks, "doc_id").groupBy("stratum", "text_hash")
              .agg(F.min("good").alias("good"), *[F.max(c).alias(c) for c in FEATURES]))
    cuts = thresholds(trials, rules, max_false, confidence)
    failed = F.array().cast("array<string>")
    for rule in rules:
        # one branch per stratum that has a cutoff for this rule
        over = F.lit(False)
        for stratum, cut in cuts.items():
            if cut[rule.name] < inf:
                over = over | (F.col("stratum").eqNullSafe(F.lit(stratum)) &
                               (F.expr(f"CAST({rule.expr} AS DOUBLE)") > F.lit(float(cut[rule.name]))))
        over = ~F.col("base_failed") & F.coalesce(over, F.lit(False))
        failed = F.concat(failed, F.when(over, F.array(F.lit(rule.name))).otherwise(F.array().cast("array<string>")))
    return (rows.withColumn("failed_rules", failed)
            .withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
            .select("doc_id", *FEATURES, "base_failed", "kept", "stratum", "failed_rules"))

"""Mixing sources to target weights by repetition, in DataFrame functions only.

Tokens are summed per source, each source's target comes from its weight, and the
ratio is its repetition rate: a document is emitted floor(rate) times, plus once more
with probability rate - floor(rate), drawn from a hash of seed and document id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import attach_group, materialise, word_count
from tessera.operators.sorting import with_position

#: Fixed values of the contract: weights by rank of the source, and the largest rate.
WEIGHTS, MAX_RATE = (5, 2, 1), 3
#: Most sources whose table (a key and four numbers each) is broadcast; beyond it the
#: table is joined by ``attach_group``.
MAX_BROADCAST_SOURCES = 10_000


def hash_unit(seed: int, key: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of MD5('<seed>:<key>'). A null key draws
    like the text 'null'."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def fill_targets(sources: DataFrame, max_rate: float) -> DataFrame:
    """``sources`` (source_size, weight) plus ``target``: all sizes shared by weight, no
    target above ``max_rate`` times its source, the excess reshared by weight. Each round
    is one aggregate of one row; a source that is capped stays capped."""
    total = sources.agg(F.sum("source_size").alias("t")).first()["t"] or 0
    share, capped = 0.0, -1
    cap = F.col("source_size") * F.lit(float(max_rate))
    while True:
        over = F.col("weight") * F.lit(float(share)) > cap
        got = sources.agg(F.sum(F.when(over, cap).otherwise(0.0)).alias("held"),
                          F.sum(F.when(over, 0).otherwise(F.col("weight"))).alias("w"),
                          F.sum(over.cast("bigint")).alias("n")).first()
        if got["n"] is None or got["n"] == capped or not got["w"]:
            break
        capped, share = got["n"], (total - got["held"]) / got["w"]
    return sources.withColumn("target", F.least(cap, F.col("weight") * F.lit(float(share))))


def source_rates(rows: DataFrame, weights=WEIGHTS, max_rate: float = MAX_RATE) -> DataFrame:
    """(source_key, source_size, n_rows, weight, target, rate) from rows (source_key,
    size); the key is the array [source], [] for a null source, which sorts last."""
    sums = rows.groupBy("source_key").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_rows"))
    ranked = with_position(sums, [F.size("source_key").desc(), "source_key"], "rank")
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]),
                          (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    sources = materialise(ranked.withColumn("weight", weight).drop("rank"), "sources")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return fill_targets(sources, max_rate).withColumn("rate", rate)


def _key(source: Column) -> Column:
    return F.when(source.isNull(), F.array().cast("array<string>")).otherwise(F.array(source.cast("string")))


def _copies(seed: int) -> Column:
    whole = F.floor(F.col("rate"))
    return (whole + (hash_unit(seed, F.col("doc_id")) < F.col("rate") - whole).cast("bigint")).cast("bigint")


def _attach(rows: DataFrame, sources: DataFrame, total: int) -> DataFrame:
    if sources.count() <= MAX_BROADCAST_SOURCES:
        return rows.join(F.broadcast(sources), "source_key")
    return attach_group(rows, sources, "source_key", "n_rows", total)


def mix_report(docs: DataFrame, seed: int = 0, id_col: str = "doc_id", text_col: str = "text",
               source_col: str = "source", weights=WEIGHTS, max_rate: float = MAX_RATE) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken (words the mix takes,
    repeats counted), copies, rate.

    Null text: size 0. A null source is a source of its own, last in rank. A source of
    size 0 has target 0 and rate 0. Repeated rows with one id draw alike. Empty table:
    empty result. Only the three named columns are read."""
    rows = materialise(docs.select(docs[id_col].alias("doc_id"), word_count(docs[text_col]).alias("size"),
                                   _key(docs[source_col]).alias("source_key")), "mix")
    sources = materialise(source_rates(rows, weights, max_rate), "rates")
    out = _attach(rows, sources, rows.count()).withColumn("copies", _copies(seed))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"),
                      "copies", "rate")


def mix_documents(docs: DataFrame, seed: int = 0, id_col: str = "doc_id", text_col: str = "text",
                  source_col: str = "source", weights=WEIGHTS, max_rate: float = MAX_RATE) -> DataFrame:
    """The mix itself: each document as many times as it is taken, all its columns."""
    rows = materialise(docs.select(word_count(docs[text_col]).alias("size"),
                                   _key(docs[source_col]).alias("source_key")), "mix")
    sources = materialise(source_rates(rows, weights, max_rate), "rates")
    packed = docs.select(docs[id_col].alias("doc_id"), _key(docs[source_col]).alias("source_key"),
                         F.struct(*[docs[c] for c in docs.columns]).alias("doc"))
    taken = _attach(packed, sources, rows.count()).withColumn("copies", _copies(seed)).filter("copies > 0")
    return taken.select(F.explode(F.array_repeat("doc", F.col("copies").cast("int"))).alias("doc")).select("doc.*")

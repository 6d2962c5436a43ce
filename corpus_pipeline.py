"""From raw documents to packed training sequences.

``STAGES`` are (name, function) pairs; each function takes (spark, docs, sf_dir) and its
result is written as Parquet and read back as the next one's ``docs``. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tessera.llm import exact_dedup, mixing, packing, simhash, toxicity
from tessera.llm.common import materialise, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the severity model does not reject; it is fitted on those of ``docs``
    that are labelled."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for the case of A-Z (null as empty) the document with the largest id; of rows equal in
    id and text one."""
    return exact_dedup.drop_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by fingerprints at most three bits apart, directly or over others, the one with the
    smallest id; shingles of three words."""
    return simhash.keep_one_per_group(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's weight asks for: none to three times."""
    return mixing.mix_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's tokens in sequences of 4096; a row per piece."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_exact_copies), ("near_dedup", drop_near_copies),
          ("mixing", mix_sources), ("packing", pack_sequences)]

# The model, the tokenizer and the packing are not SQL; tests/llm holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs

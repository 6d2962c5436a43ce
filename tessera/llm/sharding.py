"""Weighted rendezvous hashing of stable record keys.

Every (key, shard) pair has a pseudo-random score and a key lives on the shard with
its highest score. A new shard can only win keys, so growing from n to n+1 shards
moves nothing between the old ones and about 1/(n+1) of all keys in total.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import gapless, materialise, text_or_empty


def rendezvous(key: Column, weights: list[float]) -> Column:
    """Shard number 0..len(weights)-1 of ``key``: argmax over shards of ``w / -ln u``,
    where ``u`` in (0, 1) is a hash of key and shard. A shard's share of all keys is its
    weight's share of all weights. A null key hashes like any other value (its own)."""
    if not weights or min(weights) <= 0:
        raise ValueError("weights: one positive number per shard")
    known = F.coalesce(key.cast("string"), F.lit("\x00null"))

    def score(s: Column) -> Column:
        # the upper 53 bits of the hash, centred in their cell: never 0 or 1
        u = (F.shiftrightunsigned(F.xxhash64(known, s["id"]), 11).cast("double") + 0.5) / F.lit(float(1 << 53))
        return F.struct((s["w"] / -F.log(u)).alias("score"), s["id"].alias("id"))

    shards = F.array(*[F.struct(F.lit(i).alias("id"), F.lit(float(w)).alias("w")) for i, w in enumerate(weights)])
    return F.array_max(F.transform(shards, score))["id"]


def shard_rows(df: DataFrame, key: str, weights: list[float], grown: list[float] | None = None) -> DataFrame:
    """``df`` plus ``shard`` and, for the weights after growth, ``grown_shard`` (else
    null). Rows with equal keys share a shard. No shuffle."""
    out = df.withColumn("shard", rendezvous(df[key], weights))
    return out.withColumn("grown_shard", rendezvous(df[key], grown) if grown else F.lit(None).cast("int"))


def shard_documents(docs: DataFrame, weights: list[float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its size (UTF-8 bytes plus 1; null text: 1), CRC-32 of the
    text (null: of nothing, 0), shard, slot (gapless from 0 in its shard) and the shard
    after one more shard of the mean weight is added.

    Null ids share one shard; repeated rows share a shard and get different slots; an
    empty table gives an empty result; other columns are not read."""
    grown = [*weights, sum(weights) / len(weights)]
    text = text_or_empty(docs[text_col])
    rows = docs.select(docs[id_col].alias("doc_id"), (F.octet_length(text) + F.lit(1)).cast("bigint").alias("size"),
                       F.crc32(text).alias("text_crc32"))
    rows = shard_rows(rows, "doc_id", weights, grown).withColumn("row", F.monotonically_increasing_id())
    rows = materialise(rows, "shards")
    slotted = gapless(rows, "shard", ["doc_id", "size", "text_crc32", "row"], len(weights), rows.count(), "slot")
    return slotted.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")

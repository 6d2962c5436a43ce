"""Streaming keys: the rows of a table are replayed as a queue of five
micro-batches (chunk ``i`` = rows with ``pmod(id, 5) = i``), each written into the
watched folder before the trigger that consumes it; each batch is counted on its
own (no state across batches)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.plans.registry import register
from tessera.session import scratch_path
from tessera.sources.tables import table
from tessera.streaming import batch_counts as BC

# Number of queued chunks (= micro-batches) and the key modulus.
CHUNKS = 5
KEY_MOD = 10


def _run(spark, chunks_df, fmt, schema, to_keyed, keys, out_schema, name):
    folder = scratch_path(spark, f"{name}-in")
    sink = scratch_path(spark, f"{name}-batches")
    ckpt = scratch_path(spark, f"{name}-ckpt")

    def trigger():
        stream = BC.file_stream(spark, folder, schema, fmt=fmt)
        BC.per_batch_counts(to_keyed(stream), keys, sink, ckpt)

    BC.replay_queue(chunks_df, "chunk", CHUNKS, folder, fmt, trigger)
    return BC.read_batches(spark, sink, out_schema)


@register("stream_wordcount", sql=f"""
  SELECT CAST(doc_id % {CHUNKS} AS INTEGER) AS chunk, word, CAST(count(*) AS BIGINT) AS n
  FROM (SELECT doc_id, UNNEST(string_split_regex(text, '[ \\n]')) AS word FROM documents) w
  GROUP BY 1, 2""")
def stream_wordcount(spark, sf):
    docs = table(spark, sf, "documents", "doc_id", "text") \
        .select(F.pmod("doc_id", F.lit(CHUNKS)).cast("int").alias("chunk"), F.col("text").alias("value"))
    out = _run(spark, docs, "text", "value string, chunk int",
               lambda s: BC.words_stream(s, "value", keep=("chunk",)), ["chunk", "word"],
               "chunk int, word string, n bigint, batch_id int", "docs-stream")
    return out.select("chunk", "word", "n")


@register("stream_queue_counts", sql=f"""
  SELECT CAST(event_id % {CHUNKS} AS INTEGER) AS chunk, CAST(user_id % {KEY_MOD} AS BIGINT) AS key,
         CAST(count(*) AS BIGINT) AS n
  FROM events GROUP BY 1, 2""")
def stream_queue_counts(spark, sf):
    ev = table(spark, sf, "events", "event_id", "user_id") \
        .select(F.pmod("event_id", F.lit(CHUNKS)).cast("int").alias("chunk"), "user_id")
    out = _run(spark, ev, "parquet", "user_id bigint, chunk int",
               lambda s: s.select("chunk", F.pmod("user_id", F.lit(KEY_MOD)).alias("key")), ["chunk", "key"],
               "chunk int, key bigint, n bigint, batch_id int", "events-stream")
    return out.select("chunk", "key", "n")

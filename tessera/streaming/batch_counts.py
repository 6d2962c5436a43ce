"""Per-micro-batch keyed counts (the DStream ``reduceByKey`` per batch).

A Structured Streaming ``groupBy().count()`` keeps running totals across batches
(state); the DStream jobs count *each batch on its own*. So the count runs inside
``foreachBatch`` as an ordinary batch aggregate, and each batch's result is
written to ``<sink>/batch_id=<n>`` with overwrite: a batch replayed after a
failure rewrites the same folder (idempotent), and the stream checkpoint records
which files every batch consumed.

A finished batch is entered in a commit log next to the sink, ``<sink>/_commits/<n>``. Readers see
the batches of the log only, so a folder that a lost batch left half written is never read,
and a batch that is in the log is not written again when the stream replays it.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import text_words
from tessera.session import spread


def file_stream(spark: SparkSession, path: str, schema: str, fmt: str = "parquet",
                files_per_batch: int | None = None) -> DataFrame:
    """Stream of files newly added to ``path``; ``files_per_batch`` caps a batch."""
    r = spark.readStream.format(fmt).schema(schema)
    if files_per_batch:
        r = r.option("maxFilesPerTrigger", files_per_batch)
    return r.load(path)


def per_batch_counts(stream: DataFrame, keys: list, sink: str, checkpoint: str,
                     available_now: bool = True, interval: str = "1 second",
                     timeout_s: float | None = None):
    """Start the stream: every micro-batch is counted by ``keys`` and written to
    ``sink/batch_id=<id>``. With ``available_now`` the query processes what is
    there (in capped batches) and stops; otherwise it triggers every
    ``interval`` until ``timeout_s`` passes, then finishes what has arrived and stops:
    an interrupted batch is counted again from its start and overwrites its folder."""

    def count_batch(batch: DataFrame, batch_id: int) -> None:
        if batch_id not in committed_batches(batch.sparkSession, sink):
            write_batch(batch.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")), sink, batch_id)
            commit_batch(batch.sparkSession, sink, batch_id)

    w = stream.writeStream.foreachBatch(count_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    q = w.start()
    finished = q.awaitTermination(timeout_s) if timeout_s is not None else q.awaitTermination()
    if not finished and q.isActive:
        # stop() would cut the batch in progress; whatever it leaves, and what has arrived
        # by now, is finished by one last run over the same checkpoint
        q.stop()
        q = (stream.writeStream.foreachBatch(count_batch).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
        q.awaitTermination()
    return q


def replay_queue(batches: DataFrame, batch_col: str, n_batches: int, folder: str, fmt: str, start_stream,
                 partition_by_batch: bool = True) -> None:
    """Replay ``batches`` as a queue of micro-batches: batch ``i`` is the rows with
    ``batch_col == i``. Each is appended to the watched ``folder`` (a parallel
    write, many files) right before ``start_stream()`` runs an ``availableNow``
    trigger that consumes exactly the new files as one micro-batch.

    The input is read once (persisted projection), not once per batch. Rows with any
    other batch number, or none, would be lost: they are an error."""
    staged = spread(batches).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        known = F.coalesce(F.col(batch_col).between(0, n_batches - 1), F.lit(False))
        stray = staged.filter(~known).count()
        if stray:
            raise ValueError(f"{stray} rows have a {batch_col} outside 0..{n_batches - 1}")
        for i in range(n_batches):
            w = staged.filter(F.col(batch_col) == i).write.mode("append").format(fmt)
            (w.partitionBy(batch_col) if partition_by_batch else w).save(folder)
            start_stream()
    finally:
        staged.unpersist()


def write_batch(counts: DataFrame, sink: str, batch_id: int) -> None:
    counts.write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")


def _log(spark: SparkSession, sink: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{sink}/_commits")
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def commit_batch(spark: SparkSession, sink: str, batch_id: int) -> None:
    """Enter a batch in the log: an empty file, made at once."""
    folder, store = _log(spark, sink)
    store.create(spark._jvm.org.apache.hadoop.fs.Path(folder, str(batch_id)), True).close()


def committed_batches(spark: SparkSession, sink: str) -> set[int]:
    folder, store = _log(spark, sink)
    return {int(f.getPath().getName()) for f in store.listStatus(folder)} if store.exists(folder) else set()


def read_batches(spark: SparkSession, sink: str, schema: str) -> DataFrame:
    """The results of all committed batches, with their ``batch_id``; no rows if no batch ever was."""
    done = committed_batches(spark, sink)
    if not done:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(sink).filter(F.col("batch_id").isin(sorted(done)))  # folders are pruned


def words_stream(stream: DataFrame, text_col: str = "text", keep: tuple = ()) -> DataFrame:
    """``(keep..., word)``: one-space words of every streamed text, line by line,
    blank words kept."""
    return stream.select(*keep, F.explode(text_words(text_col)).alias("word"))

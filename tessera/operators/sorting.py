"""Global sorts and positions in a global order, computed without a single-task window.

``ORDER BY`` is a range-partitioned sort: partition *i* holds the *i*-th key range,
sorted. A running sum in that order (a position, or a cumulative count for ranks)
then needs only (1) the total of every partition -- one small row per partition --
and (2) a per-partition index or running sum started at the total of all earlier
partitions. A ``row_number() OVER (ORDER BY ...)`` without ``PARTITION BY`` would
instead pull every row into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import checkpoint


def ordered_cumsum(df: DataFrame, order: list, weight: str | None = None, out: str = "cum") -> DataFrame:
    """``df`` sorted by ``order`` plus ``out`` = inclusive running sum of ``weight``
    (1 per row when ``weight`` is None) in that order."""
    w = weight or "_w"
    sorted_df = df.orderBy(*order)
    if weight is None:
        sorted_df = sorted_df.withColumn(w, F.lit(1).cast("bigint"))
    # Materialise once in the shared folder: both passes below must see the same
    # partitions in the same order, and a lost executor re-reads instead of re-sorting.
    staged = checkpoint(sorted_df)
    wtype = staged.schema[w].dataType
    totals = (staged.groupBy(F.spark_partition_id().alias("pid"))
              .agg(F.sum(w).alias("t")).collect())  # one row per partition
    offsets, run = {}, 0
    for row in sorted(totals, key=lambda r: r["pid"]):
        offsets[row["pid"]] = run
        run += row["t"]
    out_type = T.LongType() if isinstance(wtype, (T.LongType, T.IntegerType)) else T.DoubleType()
    schema = T.StructType(list(staged.schema.fields) + [T.StructField(out, out_type, False)])
    # one number per partition, sent once per executor rather than inside every task
    start = df.sparkSession.sparkContext.broadcast(offsets)

    def running(batches):
        from pyspark import TaskContext

        acc = start.value.get(TaskContext.get().partitionId(), 0)
        for pdf in batches:
            if len(pdf):
                c = pdf[w].cumsum() + acc
                acc = c.iloc[-1]
                pdf[out] = c
            else:
                pdf[out] = pdf[w]
            yield pdf

    result = staged.mapInPandas(running, schema)
    return result.drop("_w") if weight is None else result


def with_position(df: DataFrame, order: list, name: str = "pos") -> DataFrame:
    """``df`` in the global ``order`` with a 1-based position column, JVM side only.

    After the sorted rows are checkpointed, ``monotonically_increasing_id`` holds
    the partition index in its upper bits and the row's index within the
    partition in its lower 33 bits; the position is the partition's offset (the
    row count of all earlier partitions: a table of one row per partition,
    broadcast) plus that index plus one."""
    spark = df.sparkSession
    staged = checkpoint(df.orderBy(*order).withColumn("_mid", F.monotonically_increasing_id()))
    totals = (staged.groupBy(F.spark_partition_id().alias("_pid"))
              .agg(F.count(F.lit(1)).alias("_t")).collect())  # one row per partition
    rows, run = [], 0
    for r in sorted(totals, key=lambda r: r["_pid"]):
        rows.append((r["_pid"], run))
        run += r["_t"]
    offsets = spark.createDataFrame(rows, "_pid int, _off bigint")
    low_bits = F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))
    pid = F.shiftright(F.col("_mid"), 33).cast("int")
    return (staged.join(F.broadcast(offsets), pid == F.col("_pid"))
            .withColumn(name, F.col("_off") + low_bits + 1)
            .drop("_mid", "_pid", "_off"))

"""Relational operators: projection, filters, maps, aggregates, key/value tables,
grouped lists, set operations.

Each is a thin, declarative DataFrame expression so Catalyst can prune columns,
push filters into the scan and plan two-phase aggregates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.sorted_store import order_by, write_sorted
from tessera.session import checkpoint


def select_cols(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*cols)


def computed_col(df: DataFrame, col: str, delta, name: str) -> DataFrame:
    """Add ``col + delta`` as ``name``; a null input stays null."""
    return df.withColumn(name, F.col(col) + F.lit(delta))


def filter_gt(df: DataFrame, col: str, bound) -> DataFrame:
    return df.filter(F.col(col) > F.lit(bound))


def filter_range(df: DataFrame, col: str, lo, hi) -> DataFrame:
    """Inclusive range ``lo <= col <= hi``."""
    return df.filter(F.col(col).between(lo, hi))


def filter_odd(df: DataFrame, col: str) -> DataFrame:
    """Odd values with floor-mod semantics (``-3`` is odd): ``pmod(col, 2) = 1``."""
    return df.filter(F.pmod(F.col(col), F.lit(2)) == 1)


def map_square(df: DataFrame, col: str, name: str = "sq") -> DataFrame:
    """``x -> (x, x*x)`` in integer arithmetic (``pow`` would give a double)."""
    x = F.col(col).cast("bigint")
    return df.withColumn(name, x * x)


def flatmap_triple(df: DataFrame, col: str, keep: tuple = (), name: str = "v") -> DataFrame:
    """``x -> x, 100*x, x*x``: three rows per input row, in that order (``k`` = 0, 1, 2)."""
    x = F.col(col).cast("bigint")
    return df.select(*keep, F.posexplode(F.array(x, x * 100, x * x)).alias("k", name))


def distinct_vals(df: DataFrame, col: str) -> DataFrame:
    """Distinct values (partial aggregate per task, then one shuffle)."""
    return df.select(col).distinct()


def min_max(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.min(col).alias("min_v"), F.max(col).alias("max_v"))


def union_bag(a: DataFrame, b: DataFrame) -> DataFrame:
    """Bag union by column name; duplicates kept, no shuffle."""
    return a.unionByName(b)


def group_count(df: DataFrame, key: str) -> DataFrame:
    """Rows per key; null is a group of its own."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def sum_by_key(df: DataFrame, key: str, value: str, name: str = "total") -> DataFrame:
    """``reduceByKey(+)``: partial sums per task, one shuffle of (key, partial sum)."""
    return df.groupBy(key).agg(F.sum(value).alias(name))


def kv_filter(df: DataFrame, key: str, bound) -> DataFrame:
    return df.filter(F.col(key) > F.lit(bound))


def group_value_counts(df: DataFrame, key: str, value: str, name: str = "n") -> DataFrame:
    """The long form of a grouped list: ``(key, value, n)``, one row per distinct
    pair (partial aggregate, then one shuffle). Use it directly when a key's
    distinct values are not bounded."""
    return df.groupBy(key, value).agg(F.count(F.lit(1)).alias(name))


def group_lists(df: DataFrame, key: str, value: str, name: str = "items") -> DataFrame:
    """Per key, the sorted list of its values as ``array<struct<value, n>>`` in ``values``
    and rendered as ``"v x count, ..."`` in ``name``.

    Values are first counted per ``(key, value)`` -- a partial aggregate -- so a key
    holds one entry per *distinct* value, never one per row: a hot key with
    millions of repeats of a few values stays a few entries. Meant for values from
    a bounded domain (quantities, flags, categories); otherwise keep the long form
    of ``group_value_counts``.
    """
    pairs = group_value_counts(df, key, value, "_c")
    entry = F.format_string("%sx%d", F.col(value).cast("string"), F.col("_c"))
    return (pairs.groupBy(key)
            .agg(F.array_sort(F.collect_list(F.struct(F.col(value).alias("v"), F.col("_c").alias("c"), entry.alias("e")))).alias("_l"))
            .select(key, F.transform("_l", lambda s: F.struct(s["v"].alias("value"), s["c"].alias("n"))).alias("values"),
                    F.concat_ws(",", F.transform("_l", lambda s: s["e"])).alias(name)))


def group_list_chunks(df: DataFrame, key: str, value: str, size: int, path: str) -> DataFrame:
    """``(key, chunk, values, counts)``: the sorted distinct values of each key with their number, in lists of at
    most ``size``, chunks from 0. No key is one row or one task, however many values it has.

    The counted pairs are sorted into a table at ``path`` (``sorted_store``); a row's place in it divided
    by ``size`` is its block, so a list is one key's rows of one block."""
    pairs = group_value_counts(df, key, value, "_n")
    placed = write_sorted(pairs, order_by(key, value), path).read("_pos")
    block = F.floor((F.col("_pos") - 1) / size).cast("bigint")
    entry = F.array_sort(F.collect_list(F.struct(F.col(value).alias("v"), F.col("_n").alias("c"))))
    lists = checkpoint(placed.groupBy(F.col(key), block.alias("_block")).agg(entry.alias("_l")))
    starts = lists.groupBy(F.col(key).alias("_key")).agg(F.min("_block").alias("_first"), F.count(F.lit(1)).alias("_m"))
    first = F.col("_key").eqNullSafe(F.col(key))  # a null key is a key
    return lists.join(starts, first).select(key, (F.col("_block") - F.col("_first")).alias("chunk"),
                                            F.transform("_l", lambda s: s["v"]).alias("values"),
                                            F.transform("_l", lambda s: s["c"]).alias("counts"))


def group_struct_list(df: DataFrame, key: str, sub_key: str, value: str, name: str = "summary") -> DataFrame:
    """Per key, an ``array<struct<sub_key, n, total>>`` summary (one struct per
    distinct ``sub_key``, sorted), built from a partial aggregate; also rendered
    as a string column ``name`` for comparison."""
    per = df.groupBy(key, sub_key).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))
    arr = F.array_sort(F.collect_list(F.struct(F.col(sub_key).alias("k"), "n", "total")))
    rendered = F.concat_ws(";", F.transform(
        "_a", lambda s: F.format_string("%s:%d:%s", s["k"], s["n"], F.round(s["total"], 6).cast("string"))))
    return per.groupBy(key).agg(arr.alias("_a")).select(key, F.col("_a").alias("structs"), rendered.alias(name))


def inline_lookup(df: DataFrame, rows: list[tuple], schema: str, on: str) -> DataFrame:
    """Join ``df`` with a small table given as inline rows. The inline side has
    ``len(rows)`` rows by construction, so broadcasting it is safe."""
    lookup = df.sparkSession.createDataFrame(rows, schema)
    return df.join(F.broadcast(lookup), on=on, how="inner")


def format_rows(df: DataFrame, fmt: str, *cols: str | Column, name: str = "text") -> DataFrame:
    """``printf``-style rendering of each row into one string column (JVM side)."""
    return df.select(F.format_string(fmt, *cols).alias(name))

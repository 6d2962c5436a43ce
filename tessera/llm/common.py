"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import math

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import scratch_path

# Fixed value: the characters that separate words in every contract of this subpackage.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and read it back, so that
    several passes see the same rows and a lost executor re-reads instead of
    recomputing."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def word_count(text: Column) -> Column:
    """Number of words (null: 0), as a long."""
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("bigint")


def attach_group(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int, share: int = 1000) -> DataFrame:
    """Inner join of ``rows`` with one-row-per-key ``groups`` that no hot key slows.

    ``size`` (a column of ``groups``) is the number of rows with that key, and the
    sizes add up to ``total`` at most. Hence fewer than ``share`` keys can have more
    than ``total / share`` rows: those few are broadcast, at any input size, and the
    rest, none of which is large, is an ordinary shuffle join. ``key`` must not be
    null. ``rows`` is read twice: pass a stored table."""
    limit = max(1, total // share)
    heavy = groups.filter(F.col(size) > limit)
    light = groups.filter(F.col(size) <= limit)
    hot = rows.join(F.broadcast(heavy), key)
    rest = rows.join(F.broadcast(heavy.select(key)), key, "left_anti").join(light, key)
    return hot.unionByName(rest)


#: Bits of one bitmap of ``bitmap_construct_agg``, and bytes of bitmaps broadcast at a time.
SEGMENT, MAX_MARK_BYTES = 8 * 4096, 64 << 20


def bit_is_set(bitmap: str, place: str) -> Column:
    """Whether bit ``place`` % SEGMENT of the binary column ``bitmap`` is set (null bitmap: no)."""
    byte = f"SUBSTRING({bitmap}, CAST(({place} % {SEGMENT}) DIV 8 AS INT) + 1, 1)"
    return F.coalesce(F.expr(f"(CAST(CONV(HEX({byte}), 16, 10) AS INT) >> CAST({place} % 8 AS INT)) & 1") == 1, F.lit(False))


def with_place(docs: DataFrame) -> tuple[DataFrame, Column, Column]:
    """(docs, file, row): two columns that name each row of ``docs`` in every reading of it, the
    file it lies in and its index there. A table that isn't read from Parquet is stored first."""
    try:
        meta = docs.metadataColumn("_metadata")
        docs.select(meta["file_path"], meta["row_index"])
    except AnalysisException:
        docs = materialise(docs, "docs")
        meta = docs.metadataColumn("_metadata")
    return docs, meta["file_path"], meta["row_index"]


def drop_marked(docs: DataFrame, gone: DataFrame, max_bytes: int = MAX_MARK_BYTES) -> DataFrame:
    """The rows of ``docs`` (as ``with_place`` returned it) except those of ``gone`` (file, row). No row of
    ``docs`` is shuffled: what goes is one bit per row of ``docs``, in bitmaps that are broadcast
    to its scan, ``max_bytes`` at a time; each part of the files meets its own bitmaps and the
    scan is pruned to it, so every file is read once."""
    marks = materialise(gone.groupBy("file", F.floor(F.col("row") / SEGMENT).cast("bigint").alias("segment"))
                        .agg(F.expr(f"bitmap_construct_agg(row % {SEGMENT})").alias("bitmap")), "marks")
    n = marks.count()
    parts = max(1, min(n, math.ceil(n * (SEGMENT // 8 + 200) / max_bytes)))
    docs, file, row = with_place(docs)
    out = None
    for part in range(parts):
        held = docs if parts == 1 else docs.filter(F.pmod(F.xxhash64(file), F.lit(parts)) == part)
        mine = marks if parts == 1 else marks.filter(F.pmod(F.xxhash64("file"), F.lit(parts)) == part)
        mine = mine.select(F.col("file").alias("__file"), F.col("segment").alias("__segment"), F.col("bitmap").alias("__bitmap"))
        packed = held.select(F.struct(*[held[c] for c in held.columns]).alias("doc"), file.alias("__at"), row.alias("__row"))
        same = (F.col("__at") == F.col("__file")) & (F.floor(F.col("__row") / SEGMENT).cast("bigint") == F.col("__segment"))
        kept = packed.join(F.broadcast(mine), same, "left").filter(~bit_is_set("__bitmap", "__row")).select("doc.*")
        out = kept if out is None else out.unionByName(kept)
    return out


def gapless(df: DataFrame, group: str, order: list[str], n_groups: int, n_rows: int, name: str,
            cell_rows: int = 20_000) -> DataFrame:
    """``name`` = 0, 1, 2, ... without gaps inside each value of ``group``.

    A group is cut into cells by a hash of the ``order`` columns, which end with a number of the
    stored row so that identical rows fall into all cells; rows are numbered inside
    their cell and start at the number of rows in the group's earlier cells.
    The table of cell sizes has at most ``n_groups * cells`` <= 65,536 + n_groups
    rows, so broadcasting it is bounded at any size. Read twice: pass a stored table."""
    from pyspark.sql import Window

    cells = min(max(8, math.ceil(n_rows / (n_groups * cell_rows))), max(1, 65_536 // n_groups))
    celled = df.withColumn("__cell", F.pmod(F.xxhash64(*order), F.lit(cells)))
    sizes = celled.groupBy(group, "__cell").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(group).orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(group, "__cell", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    inside = Window.partitionBy(group, "__cell").orderBy(*order)
    numbered = celled.withColumn("__i", F.row_number().over(inside))
    return (numbered.join(F.broadcast(starts), [group, "__cell"])
            .withColumn(name, (F.col("__start") + F.col("__i") - 1).cast("bigint"))
            .drop("__cell", "__start", "__i"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")

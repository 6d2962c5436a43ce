"""A plain global sort: a range-partitioned, sorted table on disk with a manifest of its files.

Writing is one range exchange and one sort; no numbering, no checkpoint, no second copy. The
manifest has one row per file: its rows, its first and its last key. From it alone the order of
the whole table follows, a range of keys is read from the few files that can hold it, and a row's
position is the rows of the earlier files plus its index in its own (which the file format
knows), without another pass.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: One order column: its name, and whether it falls. Nulls are the smallest, as in ORDER BY.
Order = list[tuple[str, bool]]


def _columns(order: Order):
    return [F.col(c).desc() if falling else F.col(c).asc() for c, falling in order]


def order_by(*names: str) -> Order:
    """``"-n"`` falls, ``"word"`` rises."""
    return [(n[1:], True) if n.startswith("-") else (n, False) for n in names]


@dataclass
class SortedStore:
    """``manifest`` (file, part, n, first, last): one row per file, in the order of the files."""

    spark: SparkSession
    path: str
    order: Order
    manifest: list

    def is_ordered(self) -> bool:
        """Every file's last key is at most the next file's first. (Inside a file the writer sorted;
        ``rows_in_order`` checks that too.)"""
        return all(self._at_most(a["last"], b["first"]) for a, b in zip(self.manifest, self.manifest[1:]))

    def _at_most(self, a, b) -> bool:
        for (c, falling), x, y in zip(self.order, a, b):
            if x == y:
                continue
            less = x is None or (y is not None and x < y)
            return less != falling
        return True

    def _offsets(self) -> DataFrame:
        start, rows = 0, []
        for f in self.manifest:
            rows.append((f["file"], start))
            start += f["n"]
        return self.spark.createDataFrame(rows, "__file string, __start bigint")

    def read(self, position: str | None = None, files: list[str] | None = None) -> DataFrame:
        """The rows, with their 1-based place in the whole order as ``position`` if asked for: a
        broadcast join with one row per file, no shuffle and no sort."""
        paths = [f"{self.path}/{f}" for f in files] if files is not None else [self.path]
        if not paths or not self.manifest:
            df = self.spark.read.parquet(self.path).limit(0)
            return df if position is None else df.withColumn(position, F.lit(0).cast("bigint"))
        df = self.spark.read.parquet(*paths)
        if position is None:
            return df
        placed = df.select("*", F.col("_metadata.file_name").alias("__file"), F.col("_metadata.row_index").alias("__row"))
        return (placed.join(F.broadcast(self._offsets()), "__file")
                .withColumn(position, F.col("__start") + F.col("__row") + 1).drop("__file", "__row", "__start"))

    def between(self, low, high) -> DataFrame:
        """The rows whose first order column is between ``low`` and ``high``, from the files whose
        range of keys overlaps it only."""
        c, falling = self.order[0]
        files = []
        for f in self.manifest:
            a, b = (f["last"][0], f["first"][0]) if falling else (f["first"][0], f["last"][0])
            if b is not None and b >= low and (a is None or a <= high):
                files.append(f["file"])
        return self.read(files=files).filter(F.col(c).between(low, high))

    def batches(self):
        """The files' rows as DataFrames, one after the other in the table's order, each sorted."""
        for f in self.manifest:
            yield self.read(files=[f["file"]])

    def rows_in_order(self) -> DataFrame:
        """(file, ordered): whether each row of a file is at most the next one, by its index there. A
        window per file, as large as the writer's task was."""
        from pyspark.sql import Window

        keys = F.struct(*[F.col(c) for c, _ in self.order])
        w = Window.partitionBy("__file").orderBy("__row")
        df = self.read().select(F.col("_metadata.file_name").alias("__file"), F.col("_metadata.row_index").alias("__row"),
                                keys.alias("k"))
        ok = F.lit(True)  # built from the last column: decided by the first one that differs
        for c, falling in reversed(self.order):
            a, b = F.col(f"was.{c}"), F.col(f"k.{c}")
            less = F.coalesce(a < b, a.isNull())
            ok = F.when(a.eqNullSafe(b), ok).otherwise(~less if falling else less)
        return (df.withColumn("was", F.lag("k").over(w)).filter("was IS NOT NULL").groupBy(F.col("__file").alias("file"))
                .agg(F.bool_and(ok).alias("ordered")))


def write_sorted(df: DataFrame, order: Order, path: str) -> SortedStore:
    """Sort ``df`` into a table at ``path``. Rows equal in all order columns lie together in one
    file, so end the order with columns that tell rows apart."""
    df.orderBy(*_columns(order)).write.parquet(path)
    return open_sorted(df.sparkSession, path, order)


def open_sorted(spark: SparkSession, path: str, order: Order) -> SortedStore:
    """A store written earlier; its manifest comes from the key columns (one row per file)."""
    keys = F.struct(*[F.col(c) for c, _ in order])
    name, row = F.col("_metadata.file_name"), F.col("_metadata.row_index")
    df = spark.read.parquet(path).select(name.alias("file"), row.alias("row"), keys.alias("k"))
    files = (df.groupBy("file").agg(F.count(F.lit(1)).alias("n"), F.min_by("k", "row").alias("first"),
                                    F.max_by("k", "row").alias("last"))
             # the number of the writer's task, then of its file
             .select("*", F.regexp_extract("file", r"^part-(\d+)", 1).cast("bigint").alias("part"),
                     F.regexp_extract("file", r"-c(\d+)\.", 1).try_cast("bigint").alias("piece")))
    return SortedStore(spark, path, order, files.orderBy("part", "piece").collect())

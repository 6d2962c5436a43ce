"""Exact deduplication by a two-pass Bloom filter, in DataFrame functions only.

Pass 1 sets ``hashes`` slots per text hash and keeps the slots that were hit twice or
more: the bitmap of repeated slots. Pass 2 probes each row against that broadcast
bitmap. A text that occurs twice hits all its slots twice, so it is always found; a
unique one is found only if each of its slots collides with some other text. Found
rows alone are shuffled, by their full SHA-256; all others pass straight through their
task. Texts never leave theirs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import (SEGMENT, ascii_lower, attach_group, bit_is_set, drop_marked, materialise, text_or_empty,
                                with_place)
from tessera.session import scratch_path

#: Slots per row (1.4 % of unique rows found in vain) and slots set per hash.
SLOTS_PER_ROW, HASHES = 16, 2
#: Largest bitmap sent to the executors; with more rows than it serves, the hashes are
#: dealt to several filters by range of their own, each of this size at most.
MAX_FILTER_BYTES = 64 << 20


def text_digest(text: Column) -> Column:
    """SHA-256 (lower-case hex) of the normalised text: A-Z lowered, null as empty."""
    return F.sha2(ascii_lower(text_or_empty(text)), 256)


def _slots(sha: Column, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(sha, F.lit(i)), F.lit(bits)) for i in range(HASHES)]


def _filter_plan(n_rows: int, max_bytes: int) -> tuple[int, int]:
    """(number of filters, slots of each): a power of two of slots, within ``max_bytes``."""
    bits = max(SEGMENT, 1 << (max(1, n_rows * SLOTS_PER_ROW) - 1).bit_length())
    most = max(SEGMENT, 1 << ((max_bytes * 8).bit_length() - 1))
    return (max(1, bits // most), min(bits, most))


def repeated_slots(hashes: DataFrame, bits: int) -> DataFrame:
    """(segment, bitmap of the slots hit at least twice): at most ``bits / 32768`` rows of
    4 KB. Counts are combined per task first, so a text with billions of copies is one
    count per task."""
    return (hashes.select(F.explode(F.array(*_slots(F.col("sha"), bits))).alias("slot"))
            .groupBy("slot").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
            .groupBy(F.floor(F.col("slot") / SEGMENT).cast("bigint").alias("segment"))
            .agg(F.expr(f"bitmap_construct_agg(slot % {SEGMENT})").alias("bitmap")))


def _probe(rows: DataFrame, slots: DataFrame, bits: int) -> DataFrame:
    """``rows`` (with ``sha``) plus ``maybe``: every slot of the row is set."""
    found = F.lit(True)
    for i, slot in enumerate(_slots(F.col("sha"), bits)):
        side = slots.select(F.col("segment").alias(f"__seg{i}"), F.col("bitmap").alias(f"__map{i}"))
        rows = (rows.withColumn(f"__slot{i}", slot)
                .withColumn(f"__at{i}", F.floor(F.col(f"__slot{i}") / SEGMENT).cast("bigint")))
        rows = rows.join(F.broadcast(side), F.col(f"__at{i}") == F.col(f"__seg{i}"), "left")
        found = found & bit_is_set(f"__map{i}", f"__slot{i}")
    drop = [f"__{c}{i}" for i in range(HASHES) for c in ("slot", "at", "seg", "map")]
    return rows.withColumn("maybe", found).drop(*drop)


def probe_all(digests: DataFrame, max_filter_bytes: int = MAX_FILTER_BYTES) -> DataFrame:
    """``digests`` (a stored table with ``sha``) plus ``maybe``.

    Where one filter of ``max_filter_bytes`` serves, that is one pass. With more rows the digests
    (never the texts) are dealt by filter once, and each filter is built from its own part and
    probes its own part: every digest is read the same number of times however many filters
    there are."""
    filters, bits = _filter_plan(digests.count(), max_filter_bytes)
    if filters == 1:
        return _probe(digests, materialise(repeated_slots(digests, bits), "bloom"), bits)
    spark = digests.sparkSession
    dealt, probed = scratch_path(spark, "dealt"), scratch_path(spark, "probed")
    own = F.pmod(F.xxhash64(F.col("sha"), F.lit(-1)), F.lit(filters)).cast("int")
    digests.withColumn("__filter", own).repartition("__filter").write.partitionBy("__filter").parquet(dealt)
    for f in range(filters):
        mine = spark.read.schema(digests.schema).parquet(f"{dealt}/__filter={f}") if _exists(spark, f"{dealt}/__filter={f}") else None
        if mine is not None:
            bloom = materialise(repeated_slots(mine, bits), "bloom")
            _probe(mine, bloom, bits).write.mode("append").parquet(probed)
    return spark.read.parquet(probed)


def _exists(spark, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def duplicate_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     max_filter_bytes: int = MAX_FILTER_BYTES) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id (largest id with an equal text),
    group_size, kept, text_sha256.

    Null and empty texts are one group; a very long text is one digest like any other. Of rows that
    share id and text exactly one is kept. A null id is smaller than any other; where all ids
    of a group are null one row is kept and keep_id is null. Empty table: empty result. Other
    columns are not read, so their names cannot clash."""
    hashed = materialise(docs.select(docs[id_col].alias("doc_id"), text_digest(docs[text_col]).alias("sha"),
                                     F.monotonically_increasing_id().alias("row")), "hashes")
    probed = materialise(probe_all(hashed, max_filter_bytes), "probed")
    straight = probed.filter(~F.col("maybe")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"),
        F.lit(True).alias("kept"), F.col("sha").alias("text_sha256"))
    joined = _with_groups(probed, F.struct("doc_id", "row"))
    return straight.unionByName(joined.select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"), F.col("sha").alias("text_sha256")))


def _with_groups(probed: DataFrame, rank: Column) -> DataFrame:
    """The found rows with their group's ``best`` (largest ``rank``) and ``group_size``."""
    suspects = probed.filter("maybe").drop("maybe")
    groups = materialise(suspects.groupBy("sha").agg(F.max(rank).alias("best"), F.count(F.lit(1)).alias("group_size")), "groups")
    return attach_group(suspects, groups, "sha", "group_size", probed.count())


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    max_filter_bytes: int = MAX_FILTER_BYTES) -> DataFrame:
    """The rows of ``docs`` that stay, all columns: of equal texts the one with the largest id, of
    rows equal in id and text the one with the largest hash of all columns.

    Null and empty texts are one group, a null id is smaller than any other, and of rows equal in
    all columns one stays. Empty table: empty result. Texts are read twice and never shuffled: the
    found rows' digests decide, and what goes is marked by file and row."""
    docs, file, row = with_place(docs)
    digests = materialise(docs.select(text_digest(docs[text_col]).alias("sha"), docs[id_col].alias("id"),
                                      F.xxhash64(*[docs[c] for c in docs.columns]).alias("tie"),
                                      file.alias("file"), row.alias("row")), "hashes")
    probed = materialise(probe_all(digests, max_filter_bytes), "probed")
    joined = _with_groups(probed, F.struct("id", "tie", "file", "row"))
    gone = joined.filter((F.col("row") != F.col("best.row")) | (F.col("file") != F.col("best.file")))
    return drop_marked(docs, gone.select("file", "row"), max_filter_bytes)

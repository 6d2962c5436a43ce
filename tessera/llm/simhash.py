"""Near-duplicates by 64-bit SimHash fingerprints and pivot distance tables.

Hamming distance obeys the triangle inequality, so two fingerprints that differ in at
most r bits differ by at most r in their distance to *any* reference fingerprint. Every
distinct fingerprint gets a row of distances to ``PIVOTS`` references; a pair whose
largest coordinate difference exceeds r is discarded, and the survivors are verified
bit by bit.

Distances of whole random fingerprints all lie near 32, so on their own they cannot
lead a join. Distances are therefore also kept per block of bits (a whole distance is
the sum of its blocks'): with ``BLOCKS`` = r + 2 blocks, two fingerprints within r bits
agree in at least two whole blocks, where the largest coordinate difference is 0. The
join key is the vector of block distances of one of the ten pairs of blocks; filter and
verification run inside the join, which therefore emits links and no other pair.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import attach_group, drop_marked, materialise, with_place
from tessera.llm.components import connected_components

SHINGLE, MAX_BITS, SEED = 3, 3, 42
PIVOTS = 16
BLOCKS = MAX_BITS + 2
#: Cells (fingerprints with one join key) beyond this size are cut into finer cells, exactly.
CELL = 512
_CHUNK = 1 << 15


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _masks(bits: list[int], parts: int) -> list[int]:
    """The bit positions ``bits`` as ``parts`` masks of nearly equal size."""
    cut = [round(i * len(bits) / parts) for i in range(parts + 1)]
    return [sum(1 << b for b in bits[lo:hi]) for lo, hi in zip(cut, cut[1:])]


REFERENCES = [int.from_bytes(hashlib.md5(f"pivot {i}".encode()).digest()[:8], "little") for i in range(PIVOTS)]
BLOCK_MASKS = _masks(list(range(64)), BLOCKS)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of a text as a signed 64-bit integer; no word: 0."""
    words = (text or "").encode().lower().split()  # bytes: ASCII case and ASCII white space only
    if not words:
        return 0
    size = min(shingle, len(words))
    h = xxhash.xxh64_intdigest
    total, n = np.zeros(64, np.int64), len(words) - size + 1
    for lo in range(0, n, _CHUNK):
        part = words[lo:min(lo + _CHUNK, n) + size - 1]
        hashes = [h(b" ".join(w), SEED) for w in zip(*(part[i:] for i in range(size)))]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE,
                 carried: list[Column] | None = None) -> DataFrame:
    """(doc_id, text_hash, fp and the ``carried`` columns) per row, from whole texts."""
    rows = docs.select(docs[id_col].alias("doc_id"), F.xxhash64(docs[text_col]).alias("text_hash"),
                       docs[text_col].alias("text"), *(carried or []))
    names = ["doc_id", "text_hash", *rows.columns[3:], "fp"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [fingerprint(x.as_py(), shingle) for x in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *b.columns[3:], pa.array(fps, pa.int64())], names=names)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")
    return rows.mapInArrow(run, f"{schema}, fp bigint")


def _distance(fp: Column, reference: int, mask: int) -> Column:
    return F.bit_count((fp.bitwiseXOR(F.lit(_signed(reference)))).bitwiseAND(F.lit(_signed(mask)))).cast("bigint")


def _pack(values: list[Column], width: int) -> Column:
    out = F.lit(0).cast("bigint")
    for i, v in enumerate(values):
        out = out.bitwiseOR(F.shiftleft(v, i * width))
    return out


def pivot_table(fps: DataFrame) -> DataFrame:
    """``fps`` plus block0.. (block distances to every reference, 4 bits each) and far0,
    far1 (whole distances, 8 bits each)."""
    fp = F.col("fp")
    for b, mask in enumerate(BLOCK_MASKS):
        fps = fps.withColumn(f"block{b}", _pack([_distance(fp, r, mask) for r in REFERENCES], 4))
    for part in range(PIVOTS // 8):
        whole = [_distance(fp, r, (1 << 64) - 1) for r in REFERENCES[8 * part:8 * part + 8]]
        fps = fps.withColumn(f"far{part}", _pack(whole, 8))
    return fps


def _linked(a: str, b: str, max_bits: int) -> Column:
    """Largest coordinate difference at most ``max_bits``, then the exact distance."""
    ok = F.col(f"{a}.fp") < F.col(f"{b}.fp")
    for part in range(PIVOTS // 8):
        for i in range(8):
            x, y = (F.shiftright(F.col(f"{s}.far{part}"), 8 * i).bitwiseAND(F.lit(255)) for s in (a, b))
            ok = ok & (F.abs(x - y) <= max_bits)
    return ok & (F.bit_count(F.col(f"{a}.fp").bitwiseXOR(F.col(f"{b}.fp"))) <= max_bits)


def _join(cells: DataFrame, keys: list[str], max_bits: int) -> DataFrame:
    a, b = cells.alias("a"), cells.alias("b")
    same = F.lit(True)
    for k in keys:
        same = same & (F.col(f"a.{k}") == F.col(f"b.{k}"))
    return (a.join(b, same & _linked("a", "b", max_bits))
            .select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b")))


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b), a < b: all pairs of distinct fingerprints within ``max_bits`` (at most 3).

    A cell of more than ``CELL`` fingerprints is cut once more: its members agree on two
    blocks, so their up to three differing bits lie in the other 38; of six parts of
    those at least three agree, which gives 20 finer keys of 45 equal bits together. A
    finer cell holds at most 2^19 fingerprints whatever the input size."""
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"max_bits: 0 to {MAX_BITS}")
    pairs = list(combinations(range(BLOCKS), 2))
    keys = F.array(*[F.struct(F.lit(n).alias("pair"), F.col(f"block{i}").alias("u"), F.col(f"block{j}").alias("v"))
                     for n, (i, j) in enumerate(pairs)])
    far = [f"far{i}" for i in range(PIVOTS // 8)]
    cells = pivot_table(fps.select("fp")).select("fp", *far, F.explode(keys).alias("k")).select("fp", *far, "k.*")
    cells = materialise(cells, "cells").withColumn("key", F.struct("pair", "u", "v"))
    large = materialise(cells.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > CELL), "large")
    if large.isEmpty():
        return _join(cells, ["pair", "u", "v"], max_bits)
    small = cells.join(large, "key", "left_anti")
    dense = attach_group(cells, large, "key", "n", cells.count()).drop("n")
    fine = []
    for i, j in pairs:
        rest = [b for b in range(64) if not (BLOCK_MASKS[i] | BLOCK_MASKS[j]) >> b & 1]
        fine.append([a | b | c for a, b, c in combinations(_masks(rest, 6), 3)])
    masks = F.array(*[F.array(*[F.lit(_signed(m)) for m in ms]) for ms in fine])
    dense = (dense.select("*", F.posexplode(F.element_at(masks, F.col("pair") + 1)).alias("part", "mask"))
             .withColumn("bits", F.col("fp").bitwiseAND(F.col("mask"))))
    return (_join(small, ["pair", "u", "v"], max_bits)
            .unionByName(_join(dense, ["pair", "u", "v", "part", "bits"], max_bits)))


def _grouped(docs: DataFrame, id_col: str, text_col: str, shingle: int, max_bits: int, carried: list | None = None):
    """(rows, classes): rows (doc_id, text_hash, fp and the ``carried`` columns), and per distinct fingerprint (fp, n,
    best of its component: the smallest doc_id with its text_hash)."""
    rows = materialise(fingerprints(docs, id_col, text_col, shingle, carried), "fingerprints")
    known = F.col("doc_id").isNull()
    classes = materialise(rows.groupBy("fp").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct(known.alias("none"), "doc_id", "text_hash")).alias("best")), "classes")
    found = connected_components(links(classes.select("fp"), max_bits))
    linked = materialise(classes.join(found.withColumnRenamed("node", "fp"), "fp"), "linked")
    tops = linked.groupBy("label").agg(F.min("best").alias("top"), F.count(F.lit(1)).alias("members"))
    tops = materialise(tops, "tops")
    joined = attach_group(linked, tops, "label", "members", linked.count()).select("fp", "n", F.col("top").alias("best"))
    alone = classes.join(found.select(F.col("node").alias("fp")), "fp", "left_anti")
    return rows, materialise(alone.unionByName(joined), "classes")


def near_duplicate_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id (the
    smallest doc_id reachable over links, itself included).

    Null, empty and blank texts have fingerprint zero and link like any other. Repeated
    rows share a fingerprint. Null ids never name a component unless all its ids are
    null. Empty table: empty result. Only the two named columns are read."""
    rows, classes = _grouped(docs, id_col, text_col, shingle, max_bits)
    out = attach_group(rows, classes, "fp", "n", rows.count())
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                      F.col("best.doc_id").alias("component_id"))


def keep_one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` that stay, all columns: of each component the document with
    the smallest doc_id, null ids last, of equal ids the smallest hash of its text. Rows equal in
    id and text count as one document and stay or go together. Null, empty and very long texts
    are compared like any other. Empty table: empty result. No text is shuffled: what goes is marked
    by file and row."""
    docs, file, row = with_place(docs)
    rows, classes = _grouped(docs, id_col, text_col, shingle, max_bits, [file.alias("file"), row.alias("row")])
    placed = attach_group(rows, classes, "fp", "n", rows.count())
    stays = F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("text_hash") == F.col("best.text_hash"))
    return drop_marked(docs, placed.filter(~stays).select("file", "row"))

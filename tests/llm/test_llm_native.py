"""Sharding, exact deduplication and mixing against plain Python."""

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tessera.llm import exact_dedup, mixing, sharding
from tessera.llm.common import drop_marked, with_place
from tessera.llm.exact_dedup import _filter_plan


def lowered(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def n_words(t):
    return len((t or "").encode().split())


def test_sharding_values_and_gapless_slots(odd_docs, odd_rows):
    got = sharding.shard_documents(odd_docs, [1.0] * 8).collect()
    assert len(got) == len(odd_rows)
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in odd_rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
        assert 0 <= r["shard"] < 8 and r["grown_shard"] in (r["shard"], 8) and r["law"] == "key"
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    by_id = defaultdict(set)
    for r in got:
        by_id[r["doc_id"]].add((r["shard"], r["grown_shard"]))
    assert all(len(s) == 1 for s in by_id.values())


def test_rendezvous_shares_and_movement(spark):
    keys = spark.range(40_000)
    weights = [1.0, 2.0, 1.0]
    rows = sharding.shard_rows(keys, "id", weights, [*weights, 4.0]).collect()
    share = Counter(r["shard"] for r in rows)
    assert abs(share[1] / 40_000 - 0.5) < 0.02 and abs(share[0] / 40_000 - 0.25) < 0.02
    moved = [r for r in rows if r["shard"] != r["grown_shard"]]
    assert {r["grown_shard"] for r in moved} == {3} and abs(len(moved) / 40_000 - 0.5) < 0.02
    with pytest.raises(ValueError):
        sharding.rendezvous(keys["id"], [])


def dedup_brute(rows):
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[hashlib.sha256(lowered(t).encode()).hexdigest()].append(i)
    out = Counter()
    for sha, ids in groups.items():
        known = [i for i in ids if i is not None]
        best, kept = (max(known) if known else None), False
        for i in ids:
            keep = i == best and not kept
            kept = kept or keep
            out[(i, best, len(ids), keep, sha)] += 1
    return out


@pytest.mark.parametrize("max_bytes", [64 << 20, 4096])
def test_exact_dedup_matches_brute_force(odd_docs, odd_rows, max_bytes):
    got = Counter(tuple(r) for r in exact_dedup.duplicate_report(odd_docs, max_filter_bytes=max_bytes).collect())
    assert got == dedup_brute(odd_rows)


def test_exact_dedup_filter_is_split_beyond_its_bound():
    assert _filter_plan(10, 64 << 20) == (1, 32768)
    filters, bits = _filter_plan(1 << 20, 1 << 16)
    assert bits == 1 << 19 and filters * bits >= 16 << 20


def test_exact_dedup_split_filters_find_every_copy(spark, monkeypatch):
    rows = [(i, f"text {i % 700}") for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    assert _filter_plan(6000, 4096)[0] > 1
    got = exact_dedup.duplicate_report(docs, max_filter_bytes=4096).collect()
    assert len(got) == 6000 and sum(r["kept"] for r in got) == 700
    assert all(r["keep_id"] % 700 == r["doc_id"] % 700 and r["keep_id"] >= 5300 for r in got)


def test_unique_rows_are_not_shuffled(odd_docs):
    plan = exact_dedup.drop_duplicates(odd_docs)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "hashpartitioning" not in plan and "SinglePartition" not in plan


@pytest.mark.parametrize("max_bytes", [64 << 20, 4096])
def test_scans_of_the_documents_do_not_grow_with_the_filters(spark, tmp_path, monkeypatch, max_bytes):
    """Every file of the documents is read once for the digests and once for the result."""
    rows = [(i, f"text {i % 2500}", i) for i in range(9000)]
    spark.createDataFrame(rows, "doc_id bigint, text string, x int").repartition(40).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    read, first = [], exact_dedup.materialise

    def watched(df, name):
        read.append(len([f for f in df.inputFiles() if str(tmp_path / "d") in f]))
        return first(df, name)

    monkeypatch.setattr(exact_dedup, "materialise", watched)
    assert (exact_dedup._filter_plan(9000, max_bytes)[0] > 1) == (max_bytes == 4096)
    kept = exact_dedup.drop_duplicates(docs, max_filter_bytes=max_bytes)
    assert sum(n > 0 for n in read) == 1  # of all stored steps, the digests alone read the documents
    got = kept.collect()
    assert sorted(r["doc_id"] for r in got) == list(range(6500, 9000)) and kept.columns == ["doc_id", "text", "x"]
    assert "hashpartitioning" not in kept._jdf.queryExecution().executedPlan().toString()


def test_identical_rows_are_numbered_in_all_cells(spark):
    from tessera.llm.common import gapless, materialise

    rows = [(None, "same")] * 10_000 + [(i, "other") for i in range(20_000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    out = sharding.shard_documents(df, [1.0] * 2).collect()
    for s in (0, 1):
        assert sorted(r["slot"] for r in out if r["shard"] == s) == list(range(sum(r["shard"] == s for r in out)))
    stored = materialise(df.select("doc_id", F.lit(0).alias("g"), F.monotonically_increasing_id().alias("row")), "rows")
    cells = stored.groupBy(F.pmod(F.xxhash64("doc_id", "row"), F.lit(300)).alias("c")).count()
    assert cells.agg(F.max("count")).first()[0] < 200  # a third of all rows are identical
    got = gapless(stored, "g", ["doc_id", "row"], 1, 30_000, "slot", cell_rows=100)
    assert sorted(r["slot"] for r in got.collect()) == list(range(30_000))


def test_marked_rows_are_dropped_in_parts(spark, tmp_path):
    rows = [(i, i % 3) for i in range(5000)]
    spark.createDataFrame(rows, "doc_id bigint, __row int").repartition(17).write.parquet(str(tmp_path / "d"))
    docs, file, row = with_place(spark.read.parquet(str(tmp_path / "d")))
    gone = docs.filter("doc_id % 7 = 3").select(file.alias("file"), row.alias("row"))
    for max_bytes in (64 << 20, 3 * 4296):
        kept = drop_marked(docs, gone, max_bytes)
        assert kept.columns == ["doc_id", "__row"]
        assert sorted(r["doc_id"] for r in kept.collect()) == [i for i in range(5000) if i % 7 != 3]
    assert drop_marked(docs, gone.limit(0)).count() == 5000
    inline, file, row = with_place(spark.createDataFrame(rows, "doc_id bigint, x int"))  # not read from files: stored first
    assert drop_marked(inline, inline.filter("doc_id < 9").select(file.alias("file"), row.alias("row"))).count() == 4991


def test_drop_duplicates_keeps_columns_and_one_row_each(clashing_docs, odd_rows):
    kept = exact_dedup.drop_duplicates(clashing_docs)
    assert kept.columns == clashing_docs.columns
    rows = kept.collect()
    want = {(i, s) for (i, _, _, k, s) in dedup_brute(odd_rows) if k}
    assert {(r["doc_id"], hashlib.sha256(lowered(r["text"]).encode()).hexdigest()) for r in rows} == want and len(rows) == len(want)


def targets_brute(sizes):
    order = sorted(k for k in sizes if k is not None) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    capped, total = {}, sum(sizes.values())
    while True:
        free = [s for s in order if s not in capped]
        share = (total - sum(capped.values())) / (sum(weight[s] for s in free) or 1)
        over = [s for s in free if weight[s] * share > 3 * sizes[s]]
        if not over:
            return {s: capped.get(s, weight[s] * share) for s in order}
        capped |= {s: 3.0 * sizes[s] for s in over}


def mix_brute(rows, seed=0):
    sizes = Counter()
    for _, t, _, s, _ in rows:
        sizes[s] += n_words(t)
    target = targets_brute(sizes)
    out = Counter()
    for i, t, _, s, _ in rows:
        rate = target[s] / sizes[s] if sizes[s] else 0.0
        name = "null" if i is None else str(i)
        u = int(hashlib.md5(f"{seed}:{name}".encode()).hexdigest()[:13], 16) / 2 ** 52
        copies = int(rate) + (u < rate - int(rate))
        out[(i, n_words(t), sizes[s], round(target[s], 6), n_words(t) * copies, copies)] += 1
    return out


@pytest.mark.parametrize("broadcast", [10_000, 0])
def test_mixing_matches_brute_force(odd_docs, odd_rows, monkeypatch, broadcast):
    monkeypatch.setattr(mixing, "MAX_BROADCAST_SOURCES", broadcast)
    got = Counter((r["doc_id"], r["size"], r["source_size"], round(r["target"], 6), r["taken"], r["copies"])
                  for r in mixing.mix_report(odd_docs).collect())
    assert got == mix_brute(odd_rows)


def test_mixing_excess_is_reshared_until_none_is_above(spark):
    rows = [(i, "w " * n, "en", s, 0) for i, (s, n) in enumerate([("a", 2), ("b", 50), ("c", 3), ("d", 4), ("e", 900)])]
    got = {r["source_size"]: r["target"] for r in mixing.mix_report(
        spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")).collect()}
    want = targets_brute({s: n for s, n in [("a", 2), ("b", 50), ("c", 3), ("d", 4), ("e", 900)]})
    assert got == pytest.approx({2: want["a"], 50: want["b"], 3: want["c"], 4: want["d"], 900: want["e"]})
    assert sum(got.values()) == pytest.approx(959)


def test_mix_documents_emits_the_reported_copies(clashing_docs, odd_rows):
    mixed = mixing.mix_documents(clashing_docs)
    assert mixed.columns == clashing_docs.columns
    want = Counter()
    for (i, _, _, _, _, copies), n in mix_brute(odd_rows).items():
        want[i] += copies * n
    got = Counter(r["doc_id"] for r in mixed.select("doc_id").collect())
    assert got == +want


def test_empty_tables(empty_docs):
    assert sharding.shard_documents(empty_docs, [1.0] * 8).count() == 0
    assert exact_dedup.duplicate_report(empty_docs).count() == 0
    assert exact_dedup.drop_duplicates(empty_docs).count() == 0
    assert mixing.mix_report(empty_docs).count() == 0
    assert mixing.mix_documents(empty_docs).count() == 0

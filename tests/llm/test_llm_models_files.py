"""Severity model, packing and archives: held-out accuracy, brute force and round trips."""

import hashlib
import io
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm import packing, toxicity, warc
from tessera.llm.common import table

SF = "/root/testdata/sf0.01"
PATH = public_tokenizers.path("word_bpe_49k.json")


# ---- toxicity ------------------------------------------------------------------------

def test_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    held = F.pmod(F.xxhash64("doc_id", F.lit("held out")), F.lit(3)) == 0
    report = toxicity.toxicity_report(docs, labels.filter(~held))
    rows = report.withColumnRenamed("toxic", "found").join(labels.filter(held), "doc_id").collect()
    bad = [r for r in rows if r["toxic"] == 1]
    assert len(bad) >= 50 and sum(r["found"] for r in bad) >= 0.9 * len(bad)
    assert sum(r["found"] for r in rows if r["toxic"] == 0) <= 0.005 * len(rows)
    assert all(0 <= r["severity"] <= toxicity.GRADES and 0 <= r["p_toxic"] <= 1 for r in rows)


def test_gradient_fit_recovers_an_ordinal_model():
    rng = np.random.default_rng(0)
    weights, cuts = np.array([3.0, -2.0, 1.0]), np.array([0.5, 2.0])
    rows = [list(np.flatnonzero(rng.random(3) < 0.5)) for _ in range(6000)]
    score = np.array([weights[r].sum() for r in rows])
    grades = (score[:, None] + rng.logistic(size=(6000, 1)) > cuts).sum(axis=1)
    w, t = toxicity.fit_thresholds(rows, grades, 3, 2)
    assert np.abs(w - weights).max() < 0.35 and np.abs(t - cuts).max() < 0.35


def test_severity_grows_with_the_number_of_insults(spark):
    rng = random.Random(3)
    plain = lambda: [f"w{rng.randint(0, 60)}" for _ in range(60)]
    insults = [f"insult{c}" for c in "abcdef"]
    rows, marks = [], []
    for i in range(400):
        n = rng.randint(1, 6) if i % 5 == 0 else 0
        rows.append((i, " ".join(plain() + rng.sample(insults, n))))
        marks.append((i, int(n > 0)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    model = toxicity.fit_severity(docs, spark.createDataFrame(marks, "doc_id bigint, toxic int"))
    assert list(model.thresholds) == sorted(model.thresholds)
    got = [model.predict(" ".join(plain() + insults[:n]))[0] for n in (0, 1, 3, 6)]
    assert got == sorted(got) and got[0] < 0.2 and got[1] > 0.5 and got[3] > 2


def test_toxicity_of_odd_rows(spark, clashing_docs, odd_rows, empty_docs):
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    one = spark.createDataFrame([(100, 0), (None, 1), (101, None)], "doc_id bigint, toxic int")
    for labels in (none, one):  # nothing to learn from: nothing is rejected
        assert Counter(r["doc_id"] for r in toxicity.toxicity_report(clashing_docs, labels).collect()) == Counter(r[0] for r in odd_rows)
        kept = toxicity.keep_clean(clashing_docs, labels)
        assert kept.columns == clashing_docs.columns and kept.count() == len(odd_rows)
    assert toxicity.toxicity_report(empty_docs, one).count() == 0


# ---- packing -------------------------------------------------------------------------

def test_ids_are_those_of_the_tokenizer():
    rng = random.Random(1)
    alphabet = "abcXYZ éÉßßΣσς İı ǅ 'sd'll 12 .,;:!? \t\n\x0b\x0c\x1c\x85\xa0 漢字 é <|endoftext|> -"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 80))) for _ in range(1500)]
    texts += [" ".join(rng.choice(["Hello", "world.", "it's", "We'LL", "x,", "École", "a..", "ΣΑΣ", "12a"]) for _ in range(50)) for _ in range(50)]
    encoder, tokenizer = packing.Encoder(PATH), Tokenizer.from_file(PATH)
    for lo in range(0, len(texts), 100):
        for text, ids in zip(texts[lo:lo + 100], encoder.encode(texts[lo:lo + 100])):
            assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_a_small_cache_forgets_rare_words_only_and_changes_no_id(spark):
    encoder, plain = packing.Encoder(PATH, cache_words=40), packing.Encoder(PATH)
    rng = random.Random(4)
    for lo in range(300):
        texts = [" ".join(["common", "Words,", *(rng.choice("abcdefgh") * rng.randint(1, 9) + str(lo) for _ in range(12))])]
        assert encoder.encode(texts) == plain.encode(texts)
        assert b"common" in encoder and len(encoder) + len(encoder.older) <= 40 + 2 * 40


def test_a_third_of_identical_rows_is_dealt_to_all_batches(spark, monkeypatch):
    monkeypatch.setattr(packing, "LEAST_SEQUENCES", 1)
    rng = random.Random(3)
    rows = [(None, "the same text " * 40)] * 1000 + [(i, " ".join(rng.choice(["a", "bc", "def"]) for _ in range(150))) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    out = packing.pack_documents(docs, PATH).collect()
    check_packing(out, 4096)
    batches = Counter(r["sequence_id"] >> 32 for r in out)
    assert len(out) == 3000 and len(batches) == 48 and max(batches.values()) < 2 * 3000 / 48


def squares_brute(lengths, capacity):
    """Sum of squares over gaps of partly filled bins, every choice tried."""
    bins, out = [], {}
    for item in np.argsort(-lengths, kind="stable"):
        s, options = int(lengths[item]), []
        for b in [*[b for b, gap in enumerate(bins) if gap >= s], None]:
            after = Counter(g for j, g in enumerate(bins) if j != b)
            after[(capacity if b is None else bins[b]) - s] += 1
            options.append((sum(n * n for g, n in after.items() if 0 < g < capacity), capacity if b is None else bins[b]))
        out[item] = min(options)
        target = out[item][1]
        if target == capacity:
            bins.append(capacity - s)
        else:
            bins[bins.index(target)] -= s
    return len(bins), [out[i][1] for i in range(len(lengths))]


def test_every_placement_minimises_the_sum_of_squares():
    rng = np.random.default_rng(5)
    for _ in range(60):
        lengths = rng.integers(1, 13, rng.integers(1, 40))
        bins, offsets = packing.sum_of_squares(lengths, 12)
        n, gaps = squares_brute(lengths, 12)
        assert bins.max() + 1 == n and [12 - o for o in offsets] == gaps


def check_packing(rows, capacity):
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_documents_are_packed_whole(odd_docs, odd_rows):
    rows = packing.pack_documents(odd_docs, PATH, with_ids=True).collect()
    tokenizer, want = Tokenizer.from_file(PATH), Counter()
    for i, t, *_ in odd_rows:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        for k, lo in enumerate(range(0, len(ids), 4096)):
            part = ids[lo:lo + 4096].tobytes()
            want[(i, k, lo, len(part) // 4, zlib.crc32(part), part)] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"], bytes(r["ids"])) for r in rows) == want
    total = sum(r["length"] for r in rows)
    assert check_packing(rows, 4096) <= -(-total // 4096) + 1


def test_packing_in_several_batches_wastes_little(spark, monkeypatch):
    monkeypatch.setattr(packing, "LEAST_SEQUENCES", 8)
    rows = packing.pack_documents(table(spark, SF, "documents"), PATH).collect()
    assert len({r["sequence_id"] >> 32 for r in rows}) > 5
    total = sum(r["length"] for r in rows)
    assert check_packing(rows, 4096) <= 1.1 * total / 4096


def test_packing_of_empty_and_clashing_tables(empty_docs, clashing_docs, odd_rows):
    assert packing.pack_documents(empty_docs, PATH).count() == 0
    assert packing.pack_documents(clashing_docs, PATH).select("doc_id").distinct().count() == len({r[0] for r in odd_rows})


# ---- archives ------------------------------------------------------------------------

def page_rows():
    rng = random.Random(2)
    text = lambda n: "".join(rng.choice("abcdefgh <>p/é") for _ in range(n))
    big, edge = text(5000), "x" * 999
    rows = [(i, f"http://h.example.com/{i}", f"<html><head><title>Page {i}</title></head><body><nav>Home About</nav><p>{text(rng.randint(0, 3000))}</p></body></html>") for i in range(120)]
    rows += [(200 + i, "http://h.example.com/copy", big) for i in range(40)] + [(300 + i, None, edge) for i in range(3)]
    rows += [(310, "http://x.y/1", edge + "y"), (311, "http://x.y/2", edge + "y"), (400, "http://x y\r\nWARC-Type: z/\x00", "h"),
             (401, "", ""), (402, "u", None), (None, "n", "no id"), (403, "l", "é" * 300_000), (403, "l", "é" * 300_000)]
    return rows


def round_trip_brute(rows):
    best = defaultdict(list)
    for i, _, h in rows:
        best[(h or "").encode()].append(i)
    out = Counter()
    for i, _, h in rows:
        b = (h or "").encode()
        top = max((x for x in best[b] if x is not None), default=None)
        revisit = len(b) >= 1000 and top is not None and i != top
        out[(i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if revisit else "response", top if revisit else None, None)] += 1
    return out


def test_archive_round_trip(spark):
    rows = page_rows()
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(4)
    extra = pages.select("*", *[F.lit(1).alias(c) for c in ("digest", "best", "n", "refers_to", "path", "error")])
    for p in (pages, extra):
        assert Counter(tuple(r) for r in warc.archive_round_trip(spark, p).collect()) == round_trip_brute(rows)


def test_archives_roll_and_hold_the_payloads(spark, tmp_path):
    rows = page_rows()
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(2)
    archives = warc.write_archives(pages, f"file://{tmp_path}", archive_bytes=20_000)
    assert archives.count() > 3
    got = warc.read_archives(archives).filter("record_type = 'response'").collect()
    want = Counter((h or "").encode() for _, _, h in rows)
    assert {bytes(r["payload"]) for r in got} == set(want)
    with open(archives.first()["path"].removeprefix("file://"), "rb") as f:
        assert int.from_bytes(f.read(4), "little") == 0x184D2A5D  # the dictionary leads


def archive(records, dictionary=b"", compress_dictionary=False):
    out = b""
    if dictionary:
        content = zstandard.compress(dictionary) if compress_dictionary else dictionary
        out = (0x184D2A5D).to_bytes(4, "little") + len(content).to_bytes(4, "little") + content
    zstd = warc._compressor(dictionary)
    return out + b"".join(zstd.compress(r) for r in records)


def response(payload=b"hello world", digest=None):
    return warc.page_record(7, "http://a.b/c", payload, digest or hashlib.sha1(payload).hexdigest(), None)


@pytest.fixture(scope="module")
def trained():
    rng = random.Random(0)
    samples = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(80)).encode() for _ in range(200)]
    return zstandard.train_dictionary(2048, samples).as_bytes()


@pytest.mark.parametrize("compressed", [False, True])
def test_dictionary_frame_may_be_compressed(trained, compressed):
    data = archive([response(b"alpha beta gamma"), response()], trained, compressed)
    got = list(warc.read_archive(io.BytesIO(data)))
    assert [(r["payload"], r["error"]) for r in got] == [(b"alpha beta gamma", None), (b"hello world", None)]


def test_frame_ends_of_every_block_type():
    bodies = [b"", b"a" * 300_000, random.Random(1).randbytes(400_000), b"plain text " * 9]
    plain = [zstandard.ZstdCompressor(write_checksum=c, write_content_size=s).compress(b)
             for b in bodies for c in (False, True) for s in (False, True)]
    skipped = (0x184D2A53).to_bytes(4, "little") + (5).to_bytes(4, "little") + b"12345"
    got = [data for _, data in warc.frames(io.BytesIO(skipped.join(plain)))]
    assert got == plain


def test_damage_is_reported(trained):
    ok = response()
    cases = {"version": ok.replace(b"WARC/1.1", b"WARC/9.9"), "missing warc-date": ok.replace(b"WARC-Date", b"X-Date"),
             "Content-Length says": ok[:-4] + b"!\r\n\r\n", "digest": response(digest="0" * 40),
             "no SHA-1": ok.replace(b"sha1:", b"md5:"), "not a header": ok.replace(b"WARC-Date: ", b"WARC-Date ")}
    for message, record in cases.items():
        got = list(warc.read_archive(io.BytesIO(archive([ok, record, ok], trained))))
        assert [r["error"] is None for r in got] == [True, False, True] and message in got[1]["error"], (message, got[1])
    whole = archive([ok, ok], trained)
    for cut in (1, 5, len(whole) // 3):
        got = list(warc.read_archive(io.BytesIO(whole[:-cut])))
        assert "ends inside a frame" in got[-1]["error"]
    got = list(warc.read_archive(io.BytesIO(whole + b"garbage!")))
    assert len(got) == 3 and "no frame begins" in got[-1]["error"]
    flipped = bytearray(whole)
    flipped[-12] ^= 255
    assert list(warc.read_archive(io.BytesIO(bytes(flipped))))[-1]["error"]


def test_a_folder_without_scheme_is_in_the_default_store(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a.b/", "x" * 2000), (2, "http://a.b/2", "x" * 2000)], "page_id bigint, url string, html string")
    archives = warc.write_archives(pages, str(tmp_path / "plain")).collect()
    assert archives and all(r["path"].startswith(f"file:///{str(tmp_path)[1:]}/plain/") for r in archives)
    got = {r["page_id"]: r["refers_to"] for r in warc.archive_round_trip(spark, pages, str(tmp_path / "other")).collect()}
    assert got == {1: 2, 2: None}


def test_no_pages_no_archives(spark):
    assert warc.archive_round_trip(spark, spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0


def test_equal_small_payloads_do_not_meet_in_one_task(spark):
    rows = [(i, f"http://a.b/{i}", None if i % 2 else "") for i in range(1200)]
    rows += [(2000 + i, f"http://c.d/{i}", f"{i // 2:04d}" * 300) for i in range(2000)]  # pairs, joined by shuffle
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(6)
    changed = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.files.openCostInBytes": str(1 << 30)}  # a task per file
    before = {k: spark.conf.get(k) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    try:
        out = warc._with_response(pages, 1000)
        got = out.withColumn("task", F.spark_partition_id()).collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert "hashpartitioning" not in plan  # no html is shuffled, with Spark's own broadcasts off
    assert all((r["html"] is None) == (r["refers_to"] is not None) for r in got)
    assert {r["page_id"]: r["refers_to"] for r in got} == {i: i + 1 if i >= 2000 and i % 2 == 0 else None for i, *_ in rows}
    assert max(Counter(r["task"] for r in got if r["page_id"] < 2000).values()) < 400

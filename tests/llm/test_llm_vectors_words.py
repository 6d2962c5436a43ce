"""Language identification, whitening and spelling variants against plain Python."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import language_id, variants, whitening
from tessera.llm.common import table

SF = "/root/testdata/sf0.001"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ---- language identification -----------------------------------------------------------

def grams(text):
    t = " " + re.sub(r"[\W\d_]+", " ", text.lower()).strip() + " "
    return {t[i:i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)} - {" "}


def test_kernels_are_those_of_the_ngram_sets():
    rng = random.Random(2)
    texts = ["".join(rng.choice("abcdeÉñß ,.7") for _ in range(rng.randint(3, 400))) + "x" for _ in range(40)]
    model = language_id._landmark_model(["l"], [language_id.ngram_codes(t) for t in texts[:10]])
    got = model.kernels([language_id.ngram_codes(t) for t in texts])
    for row, t in zip(got, texts):
        for value, mark in zip(row, texts[:10]):
            a, b = grams(t), grams(mark)
            assert abs(value - len(a & b) / (len(a) * len(b)) ** 0.5) < 0.01  # hashed n-grams may meet


def test_scoring_equals_ridge_on_nystroem_features():
    rows = [(lang, " ".join(random.Random(i).choices(words, k=20)))
            for i in range(30) for lang, words in (("a", ["abc", "bcd", "xay"]), ("b", ["klm", "mno", "xlo"]))]
    model = language_id.fit_kernel(rows, landmarks=8)
    marks = [language_id.ngram_codes(t) for _, t in rows[:0]] or None
    assert marks is None and model.landmarks.shape[1] == 8 and model.languages == ["a", "b"]
    # brute force from kernel values alone: K_mm^(-1/2) by eigenvectors, weighted normal equations
    chosen = [t for lang in ("a", "b") for t in [t for at, t in rows if at == lang][:4]]
    k = lambda s, t: len(grams(s) & grams(t)) / (len(grams(s)) * len(grams(t))) ** 0.5
    mm = np.array([[k(s, t) for t in chosen] for s in chosen])
    values, vectors = np.linalg.eigh(mm)
    keep = values > language_id.LEAST_PART * values[-1]
    root = vectors[:, keep] / np.sqrt(values[keep])
    phi = np.array([[k(s, t) for t in chosen] for _, s in rows]) @ root
    y = np.array([[float(lang == x) for x in "ab"] for lang, _ in rows])
    w = np.linalg.solve(phi.T @ phi / 60 + language_id.RIDGE * np.eye(phi.shape[1]), phi.T @ y / 60)
    want = phi @ w
    got = model.kernels([language_id.ngram_codes(t) for _, t in rows]) @ model.weights
    assert np.abs(got - want).max() < 0.05
    assert model.predict([t for _, t in rows])[0] == [lang for lang, _ in rows]


def test_held_out_documents_are_recognised(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    out = {r["doc_id"]: r for r in language_id.identify_languages(docs).collect()}
    truth = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    assert out.keys() == truth.keys()
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2]
    assert held and all(out[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i in truth)
    assert sum(out[i]["lang_pred"] == truth[i] for i in held) / len(held) > 0.99
    assert all(0 <= r["score"] <= 1 for r in out.values())


def test_held_out_labels_are_never_read(spark):
    docs = table(spark, SF, "documents")
    wrong = docs.withColumn("lang", F.when(language_id.is_held_out(docs["doc_id"]), "xx").otherwise(F.col("lang")))
    a = language_id.identify_languages(docs).orderBy("doc_id").collect()
    assert a == language_id.identify_languages(wrong).orderBy("doc_id").collect()


def test_sample_is_bounded_and_even(spark):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choices("ab cd ef gh ij".split(), k=9)) + f" {i}x", "big" if i % 30 else "small") for i in range(3000)]
    rows += [(5000 + i, "the same text", "big") for i in range(1500)] + [(9000, "x" * 30_000, "small"), (9001, None, "big")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    sample = language_id.fit_sample(docs, "doc_id", "text", "lang", 120)
    by = Counter(lang for lang, _ in sample)
    assert by == {"big": 60, "small": 60} and len(set(sample)) == 120 and all(len(t) < 20_000 for _, t in sample)


def test_language_of_odd_documents(odd_docs, odd_rows, clashing_docs, empty_docs, spark):
    for docs in (odd_docs, clashing_docs):
        out = language_id.identify_languages(docs).collect()
        assert Counter(r["doc_id"] for r in out) == Counter(r[0] for r in odd_rows)
        seen = defaultdict(set)
        for r in out:
            seen[r["doc_id"]].add(r["lang_pred"])
        assert seen[1] == seen[2] == seen[3] == {"und"} and "und" not in seen[4] | seen[10]
    assert language_id.identify_languages(empty_docs).count() == 0
    unknown = spark.createDataFrame([(1, "some words", None), (2, "12 34", "en")], "doc_id bigint, text string, lang string")
    assert [tuple(r) for r in language_id.identify_languages(unknown).orderBy("doc_id").collect()] == [
        (1, False, "und", 0.0), (2, False, "und", 0.0)]


# ---- whitening ------------------------------------------------------------------------

def test_bit_sliced_scatter_is_exact():
    rng = np.random.default_rng(1)
    for lo, hi, dims, rows in [(-40, 40, 5, 300), (10**6 - 40, 10**6 + 38, 20, 5000), (-(2**61), 2**61, 3, 70), (7, 8, 4, 10),
                               (0, 2, 1, 1)]:
        x = rng.integers(lo, hi, (rows, dims))
        sums, cross = whitening.scatter(x)
        exact = x.astype(object)
        assert (sums == exact.sum(0)).all() and (cross == exact.T @ exact).all()


def whitened_brute(rows, components):
    kept = []
    for vec_id, v in rows:
        if v is not None and len(v) == 6 and all(c is not None and np.isfinite(c) for c in v):
            kept.append((vec_id, [int(np.floor(64.0 * c)) + 1_000_000 for c in v]))
    fit = np.array(sorted({tuple(x) for _, x in kept}), object)
    n, sums = len(fit), fit.sum(axis=0)
    centred = (fit * n - sums).astype(float) / n
    cov = centred.T @ centred / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    out = []
    for vec_id, x in kept:
        d = np.array(x, object) * n - sums
        w = (d.astype(float) / n) @ vectors / np.sqrt(values)
        for k in range(len(values)):
            out.append((vec_id, k + 1, n, int((d * d).sum()), w[k], values[k] / np.trace(cov)))
    return out


def vector_rows():
    rng = np.random.default_rng(3)
    rows = [(i, [float(np.float32(c)) for c in rng.normal(0, [3, 2, 1, .5, .2, .1])]) for i in range(400)]
    rows += [(1000 + i, rows[7][1]) for i in range(300)] + [(7, rows[7][1]), (None, rows[9][1]), (None, rows[9][1])]
    rows += [(2000, None), (2001, []), (2002, [1.0, 2.0]), (2003, [1.0, None, 1.0, 1.0, 1.0, 1.0]),
             (2004, [float("nan")] + [0.0] * 5), (2005, [float("inf")] + [0.0] * 5), (2006, [1e30] + [0.0] * 5)]
    return rows


def test_whitening_against_brute_force(spark):
    rows = vector_rows()
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(5)
    frame = frame.select("*", *[F.lit("clash").alias(c) for c in ("x", "size", "n", "component", "i", "j", "high")])
    got = whitening.whiten_vectors(frame, components=4).collect()
    want = whitened_brute([r for r in rows if r[0] != 2006], 4)
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [r[:4] for r in got] == [r[:4] for r in want]
    for k in range(1, 5):  # either sign, the same for all rows of a component
        a, b = (np.array([r[4] for r in rows_ if r[1] == k]) for rows_ in (got, want))
        assert np.allclose(a, b * np.sign((a * b).sum()), atol=1e-9)
    assert np.allclose([r[5] for r in got], [r[5] for r in want], rtol=1e-9)
    assert len({r[6] for r in got}) == 1 and got[0][6] < 1e-9


def test_whitening_without_variance_or_rows(spark):
    schema = "vec_id bigint, embedding array<double>"
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)], schema)
    assert whitening.whiten_vectors(same).count() == 0
    assert whitening.whiten_vectors(spark.createDataFrame([], schema)).count() == 0
    assert whitening.whiten_vectors(spark.createDataFrame([(1, None), (2, [])], schema)).count() == 0
    line = spark.createDataFrame([(i, [float(i), 2.0 * i]) for i in range(5)], schema)  # one direction only
    out = whitening.whiten_vectors(line).collect()
    assert len(out) == 5 and {r["component"] for r in out} == {1} and abs(out[0]["explained"] - 1) < 1e-12


def test_deviation_beyond_a_long_is_null(spark):
    rows = [(0, [2.0 ** 50]), (1, [-(2.0 ** 50)]), (2, [0.0])]
    out = whitening.whiten_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()
    assert {r["vec_id"]: r["deviation"] for r in out} == {0: None, 1: None, 2: 0}


# ---- spelling variants ----------------------------------------------------------------

def variants_brute(rows):
    count = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 5:
                count[run] += 1
    words = {w: n for w, n in count.items() if n >= 3}
    near = {w: [v for v in words if abs(len(v) - len(w)) < 2 and edit_brute(v, w)] for w in words}
    form = {}
    for w in words:
        if near[w]:
            best = min(near[w], key=lambda v: (-words[v], v))
            if words[best] >= 2 * words[w]:
                form[w] = best
    out = {}
    for w in words:
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, words[w], len(near[w]), words[form[w]] if w in form else None)
    return out


def edit_brute(a, b):
    if a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = max(a, b, key=len), min(a, b, key=len)
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1:] == b for i in range(len(a)))


def word_rows():
    rng = random.Random(11)
    letters = "abceinrtéüß"
    base = ["".join(rng.choice(letters) for _ in range(rng.randint(4, 9))) for _ in range(120)]
    base += ["".join(rng.choice(letters) for _ in range(n)) for n in (64, 65, 66, 200)]
    words = []
    for w in base:
        for _ in range(rng.randint(0, 6)):
            i = rng.randrange(len(w))
            edited = rng.choice([w[:i] + w[i + 1:], w[:i] + rng.choice(letters) + w[i:], w[:i] + rng.choice(letters) + w[i + 1:]])
            words += [edited] * rng.choice([2, 3, 5, 12])
        words += [w] * rng.choice([1, 3, 9, 40])
    rng.shuffle(words)
    words = [w.upper() if rng.random() < 0.1 and w.isascii() else w for w in words]
    rows = [(i, rng.choice([" ", ", ", "\n", "7"]).join(words[i::40])) for i in range(40)]
    return rows + [(None, None), (1, ""), (None, "aaaaab " * 40), (3, "aaaaaab"), (3, "aaaaaab aaaaaab"), (9, "ab×÷cd " * 3)]


@pytest.mark.parametrize("cell_words,cell_searches", [(50_000, 200_000), (3, 5), (1, 40)])
def test_variants_against_brute_force(spark, cell_words, cell_searches):
    rows = word_rows()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    docs = docs.select("*", *[F.lit("clash").alias(c) for c in ("word", "n", "id", "run", "cell", "state", "form", "root", "block")])
    out = variants.group_variants(docs, cell_words=cell_words, cell_searches=cell_searches).collect()
    got = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in out}
    assert len(got) == len(out) and got == variants_brute(rows)


def test_variants_of_odd_and_empty_tables(odd_docs, odd_rows, empty_docs):
    out = variants.group_variants(odd_docs).collect()
    got = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in out}
    assert got == variants_brute([(r[0], r[1]) for r in odd_rows])
    assert variants.group_variants(empty_docs).count() == 0


def test_large_cells_are_cut_to_size(spark):
    rng = random.Random(5)
    words = sorted({"".join(rng.choice("aei") for _ in range(8)) for _ in range(2500)})  # few letters: few cells
    frame = spark.createDataFrame([(w, 3) for w in words], "word string, n bigint")
    cells = variants.cells_of(frame, cell_words=100, cell_searches=300)
    sizes = cells.groupBy("cell", "block").agg(F.count(F.when(F.col("state") == -1, 1)).alias("f"),
                                               F.count(F.when(F.col("state") >= 0, 1)).alias("s")).collect()
    assert max(r["f"] for r in sizes) <= 160 and max(r["s"] for r in sizes) <= 400  # dealt by hash
    got = {(r["word"], r["other"]) for r in variants.near_words(frame, 100, 300).collect()}
    index = defaultdict(set)
    for w in words:
        for i in range(8):
            index[i, w[:i] + w[i + 1:]].add(w)
    assert got == {(a, b) for ws in index.values() for a in ws for b in ws if a != b}

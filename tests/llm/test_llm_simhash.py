"""Fingerprints, links and components against plain Python."""

import random
from collections import Counter

import pytest
import xxhash

from tessera.llm import simhash
from tessera.llm.components import connected_components
from tessera.llm.simhash import _signed, fingerprint


def slow_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_brute(fps, bits=3):
    parent = list(range(len(fps)))

    def root(i):
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                parent[root(i)] = root(j)
    return [root(i) for i in range(len(fps))]


def test_fingerprint_values(monkeypatch):
    rng = random.Random(1)
    texts = [None, "", " \t\n", "one", "One TWO", "a b c", "a b c a b c", "É é\xa0x y z",
             *(" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 200))) for _ in range(30))]
    for chunk in (1 << 15, 7):
        monkeypatch.setattr(simhash, "_CHUNK", chunk)
        assert [fingerprint(t) for t in texts] == [_signed(slow_fingerprint(t)) for t in texts]


def planted(rng, n=120):
    """Random fingerprints, chains of links, and near but unlinked pairs."""
    fps = [rng.getrandbits(64) for _ in range(n)] + [0, (1 << 64) - 1]
    for base in fps[:30]:
        x = base
        for _ in range(rng.randint(1, 5)):
            for bit in rng.sample(range(64), rng.choice((1, 2, 3, 3, 4))):
                x ^= 1 << bit
            fps.append(x)
    return sorted(set(fps))


def links_of(spark, fps):
    df = spark.createDataFrame([(_signed(f),) for f in fps], "fp bigint")
    return {(r["a"], r["b"]) for r in simhash.links(df).collect()}


@pytest.mark.parametrize("cell", [512, 0])
def test_links_are_all_pairs_within_three_bits(spark, monkeypatch, cell):
    monkeypatch.setattr(simhash, "CELL", cell)
    fps = planted(random.Random(3))
    signed = sorted(map(_signed, fps))
    want = {(a, b) for i, a in enumerate(signed) for b in signed[i + 1:] if ((a ^ b) & (1 << 64) - 1).bit_count() <= 3}
    assert len(want) > 40 and links_of(spark, fps) == want


def test_dense_ball_is_linked_through_finer_cells(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CELL", 20)
    base = 0x0123456789ABCDEF
    fps = {base} | {base ^ (1 << i) ^ (1 << j) for i in range(40) for j in range(i)}
    signed = sorted(map(_signed, fps))
    want = {(a, b) for i, a in enumerate(signed) for b in signed[i + 1:] if ((a ^ b) & (1 << 64) - 1).bit_count() <= 3}
    assert links_of(spark, fps) == want


def test_components_of_long_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(100, 164)]
    star = [(1000, x) for x in range(1001, 1040)]
    links = spark.createDataFrame([*chain, *star, (5, 3), (3, 4)], "a bigint, b bigint")
    got = {r["node"]: r["label"] for r in connected_components(links).collect()}
    assert {got[i] for i in range(100, 165)} == {100} and {got[i] for i in range(1000, 1040)} == {1000}
    assert [got[i] for i in (3, 4, 5)] == [3, 3, 3]


def test_report_matches_brute_force(odd_docs, odd_rows):
    fps = [slow_fingerprint(t) for _, t, *_ in odd_rows]
    roots = components_brute(fps)
    smallest = {}
    for (i, *_), r in zip(odd_rows, roots):
        if i is not None:
            smallest[r] = min(i, smallest.get(r, i))
    want = Counter((i, f"{f:016x}", smallest.get(r)) for (i, *_), f, r in zip(odd_rows, fps, roots))
    got = Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash.near_duplicate_report(odd_docs).collect())
    assert got == want


def test_one_document_of_each_group_stays(clashing_docs, odd_docs, odd_rows):
    report = simhash.near_duplicate_report(odd_docs).collect()
    stay = simhash.keep_one_per_group(clashing_docs)
    assert stay.columns == clashing_docs.columns
    rows = stay.collect()
    assert {r["doc_id"] for r in rows} == {r["component_id"] for r in report}
    groups = set(components_brute([slow_fingerprint(t) for _, t, *_ in odd_rows]))  # id 11 has two texts, so two groups
    assert len({(r["doc_id"], r["text"]) for r in rows}) == len(groups)


def test_empty_table(empty_docs):
    assert simhash.near_duplicate_report(empty_docs).count() == 0
    assert simhash.keep_one_per_group(empty_docs).count() == 0


def test_pivot_bound_and_joint_key_hold():
    """Within r bits: every whole distance differs by at most r, and two blocks agree."""
    rng = random.Random(5)
    for _ in range(500):
        x = rng.getrandbits(64)
        y = x
        for b in rng.sample(range(64), 3):
            y ^= 1 << b
        assert all(abs((x ^ r).bit_count() - (y ^ r).bit_count()) <= 3 for r in simhash.REFERENCES)
        assert sum((x ^ y) & m == 0 for m in simhash.BLOCK_MASKS) >= 2
    assert sum(simhash.BLOCK_MASKS) == (1 << 64) - 1

"""Personal data, quality rules and page text against plain Python and planted cases."""

import random
import re
import time
from collections import Counter
from datetime import date
from math import comb, inf

import pytest
from pyspark.sql import functions as F

from tessera.llm import html_text, pii, quality
from tessera.llm.html_blocks import blocks
from tessera.llm.html_text import common_lines
from tessera.llm.pii import FIRST_DAY, LAST_DAY, Permutation, Pseudonyms, _day, find

KEY = b"test key"


# ---- personal data -------------------------------------------------------------------

@pytest.mark.parametrize("size", [1, 2, 7, 26, 1000, 73_049])
def test_permutation_is_a_bijection_with_inverse(size):
    p = Permutation(KEY)
    images = [p.forward(x, size, "t") for x in range(min(size, 3000))]
    assert len(set(images)) == len(images) and all(0 <= y < size for y in images)
    assert [p.backward(y, size, "t") for y in images] == list(range(len(images)))
    if size <= 1000:
        assert sorted(images) == list(range(size))


def test_permutation_of_the_valid_values_alone():
    p, valid = Permutation(KEY), lambda x: x % 3 == 1
    images = [p.forward(x, 300, "t", valid) for x in range(1, 300, 3)]
    assert sorted(images) == list(range(1, 300, 3))
    assert images != [Permutation(b"other").forward(x, 300, "t", valid) for x in range(1, 300, 3)]


VALUES = {
    "email": ["jane.doe7@mail.example.com", "A_b@x.org"], "card": ["4111111111111111", "5500-0000-0000-0004", "4077 6013 6971 0178"],
    "ip": ["84.190.143.79", "10.0.0.7"], "phone": ["+1 (276) 555-5999", "415-555-0134"], "ssn": ["123-45-6789"],
    "date": ["2024-02-29", "31/12/1999", "12/31/1999", "03.04.2001", "05/06/2010"],
    "iban": ["DE89370400440532013000", "GB82 WEST 1234 5698 7654 32"],
    "secret": ["1b215194d600cf2230f038242a103d25b9f70c56", "aB3dE5fG7h"]}


@pytest.mark.parametrize("kind,value", [(k, v) for k, vs in VALUES.items() for v in vs])
def test_pseudonyms_keep_the_format_and_can_be_undone(kind, value):
    new = getattr(Pseudonyms(KEY), kind)(value)
    assert new != value and getattr(Pseudonyms(KEY, back=True), kind)(new) == value
    shape = lambda t: re.sub("[A-Z]", "A", re.sub("[a-z]", "a", re.sub("[0-9]", "9", t)))
    if kind == "ip":
        assert all(0 <= int(x) <= 255 for x in new.split("."))
    elif not re.fullmatch("[0-9a-f]+", value):
        assert shape(new) == shape(value)
    if kind == "card":
        assert pii.luhn_ok(pii._digits(new)) and new[0] == value[0]
    if kind == "iban":
        assert pii.iban_ok(new) and new[:2] == value[:2]
    if kind == "date":
        assert pii._day(new)[1] == pii._day(value)[1]


BESIDE = {
    "card": ["4111 1111 1111 1111", "4111111111111111", "5500-0000-0000-0004", "3782 822463 10005", "4222 2222 2222 2"],
    "iban": ["BE68 5390 0754 7034", "BE68539007547034", "NO93 8601 1117 947", "GB82 WEST 1234 5698 7654 32"],
    "phone": ["+44 20 7946 0958", "+442079460958", "+49 30 90182000", "+33 1 23 45 67 89", "+1 (276) 555-5999", "+14155550134", "415-555-0134"],
    "date": ["3/4/1985", "13/4/1985", "1985-3-4", "1985-03-04", "3.4.1985"], "ssn": ["123-45-6789"], "ip": ["84.190.143.79"]}


@pytest.mark.parametrize("kind,value", [(k, v) for k, vs in BESIDE.items() for v in vs])
@pytest.mark.parametrize("before,after", [("", " 12/25"), ("", " 123"), ("17 ", ""), ("17 ", " 5"), ("", " EUR 500"), ("XX12 ", " 123456"),
                                          ("2024-05-06 ", " 7"), ("415-555-0134 ", ""), ("", " 4077 6013 6971 0178")])
def test_values_beside_other_numbers(kind, value, before, after):
    text = before + value + after
    found = find(text, Pseudonyms(KEY))
    here = [f for f in found if f[0] == len(before)]
    assert [(f[1], f[2]) for f in here] == [(len(before) + len(value), kind)], found
    new = text[:here[0][0]] + here[0][3] + text[here[0][1]:]
    assert here[0][3] != value and getattr(Pseudonyms(KEY, back=True), kind)(here[0][3]) == value
    if kind != "ip":
        assert len(new) == len(text)


def test_a_day_has_one_pseudonym_in_every_layout():
    names, back = Pseudonyms(b"k"), Pseudonyms(b"k", back=True)
    layouts = ["{y}-{m:02}-{d:02}", "{y}/{m}/{d}", "{d:02}.{m:02}.{y}", "{d}.{m}.{y}"]
    seen = set()
    for n in range(FIRST_DAY.toordinal(), LAST_DAY.toordinal() + 1):
        day = date.fromordinal(n)
        # with slashes the month comes first, and the day where it can't be a month
        texts = [f.format(y=day.year, m=day.month, d=day.day) for f in layouts] + [f"{day.month}/{day.day}/{day.year}"]
        if day.day > 12:
            texts.append(f"{day.day}/{day.month:02}/{day.year}")
        new = [names.date(t) for t in texts]
        assert len({_day(t)[0] for t in new}) == 1, (day, new)
        assert [len(t) for t in new] == [len(t) for t in texts]
        if n % 97 == 0:
            assert [back.date(t) for t in new] == texts
        seen.add(_day(new[0])[0])
    assert len(seen) == LAST_DAY.toordinal() - FIRST_DAY.toordinal() + 1


def test_many_values_in_one_text_take_time_in_proportion():
    def seconds(n):
        text = " ".join(f"user{i}@example{i % 7}.org" for i in range(n))
        at = time.process_time()
        assert len(find(text, Pseudonyms(b"k"))) == n
        return time.process_time() - at

    assert seconds(16_000) < 8 * seconds(4_000)  # quadratic: sixteen times


def test_dates_before_a_time_and_two_cards_in_a_run():
    names = Pseudonyms(KEY)
    for text in ["1985-03-04T10:00", "at 1985-03-04T10:00:00Z", "1985-03-04T10"]:
        assert [text[a:b] for a, b, *_ in find(text, names)] == ["1985-03-04"]
    assert find("1985-03-04Total", names) == [] == find("13/13/1985", names)
    text = "4111 1111 1111 1111 5500 0000 0000 0004"
    assert [text[a:b] for a, b, *_ in find(text, names)] == [text[:19], text[20:]]
    # a phone and a social-security number are no card, whatever their digits' sum
    kinds = {f"415-555-{i:04d} 123-45-6789": "phone ssn" for i in range(1000, 1040)}
    assert all(" ".join(k for *_, k, _ in find(t, names)) == want for t, want in kinds.items())


def test_invalid_values_and_plain_text_stay():
    names = Pseudonyms(KEY)
    for text in ["order 4111111111111112 shipped", "version 1.2.3.4.5", "300.1.2.3", "2023-02-30", "DE89370400440532013001",
                 "000-12-3456 is no number", "a token of thanks", "page 12 of 345", "no-at-sign.example.com", "0000000000000000"]:
        assert find(text, names) == [], text


def test_documents_are_linked_and_otherwise_unchanged(spark, odd_docs, odd_rows):
    text = 'Mail jane.doe@mail.example.com, card 4111 1111 1111 1111, call +1 (276) 555-5999. IP 84.190.143.79; token = "1b215194d600cf22"'
    rows = [(900, text), (901, "x\n" + text + " end"), (902, "plain"), (903, None), (904, "")]
    got = {r["doc_id"]: r for r in pii.pseudonymise(spark.createDataFrame(rows, "doc_id bigint, text string"), KEY).collect()}
    assert got[901]["text"] == "x\n" + got[900]["text"] + " end" and got[900]["n_found"] == 5
    for secret in ["jane.doe@", "4111 1111 1111 1111", "(276) 555-5999", "84.190.143.79", "1b215194d600cf22"]:
        assert secret not in got[900]["text"]
    assert [text[s["start"]:s["end"]] for s in got[900]["spans"]][:2] == ["jane.doe@mail.example.com", "4111 1111 1111 1111"]
    assert got[902]["text"] == "plain" and got[903]["text"] is None and got[904]["text"] == ""
    assert Counter((r["doc_id"], r["text"]) for r in pii.pseudonymise(odd_docs, KEY).collect()) == Counter((r[0], r[1]) for r in odd_rows)


# ---- quality rules -------------------------------------------------------------------

def counts_brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines, dup = text.split("\n"), 0
    for i, line in enumerate(lines):
        dup += bool(re.search(r"[^\x20\x09-\x0D]", line)) and line in lines[:i]
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_base_counts():
    rng = random.Random(2)
    texts = [None, "", " ", "a", "a b", "a b c a b c", "x\nx\n\n \n \nx", "é\x85 # <b>|$%&*", "a a a a a"]
    texts += ["".join(rng.choice("ab# \n\té") for _ in range(rng.randint(1, 120))) for _ in range(300)]
    for t in texts:
        assert quality.base_counts(t) == counts_brute(t), t


def test_exact_bound_is_the_binomial_tail():
    for k, n, p in [(0, 10, 0.1), (3, 50, 0.02), (7, 900, 0.01)]:
        want = sum(comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(k + 1))
        assert quality.binomial_tail(k, n, p) == pytest.approx(want)
    assert not quality.shown(0, 0, 0.01, 0.05) and not quality.shown(0, 100, 0.01, 0.05) and quality.shown(0, 299, 0.01, 0.05)


def labelled(spark, n, bad_share):
    """n good rows per stratum, of which bad_share have many symbols."""
    rows = [(s, 100, 500, 40 if i < n * bad_share else 0, 0, 0, True) for s in ("en", None) for i in range(n)]
    return spark.createDataFrame(rows, "stratum string, " + ", ".join(f"{f} bigint" for f in quality.FEATURES) + ", good boolean")


def test_thresholds_need_evidence(spark):
    rule = "symbols_per_word"
    assert quality.thresholds(labelled(spark, 100, 0))["en"][rule] == inf  # too few rows to show anything
    assert quality.thresholds(labelled(spark, 4000, 0))[None][rule] == 0.01  # the strictest
    # 2 % of the good rows have 0.4 symbols a word: only cutoffs that spare them
    assert quality.thresholds(labelled(spark, 4000, 0.02))["en"][rule] == 0.5
    # the level is shared by all tests: more strata need more rows
    n = next(n for n in range(1000, 4000, 50) if quality.shown(0, n, 0.005, 0.05 / 100))
    assert not quality.shown(0, n, 0.005, 0.05 / 1000)


def test_fixed_sequence_stops_at_the_first_cutoff_not_shown(spark):
    """1.2 % of the good rows lie above 0.3: a bound of 2 % allows that cutoff with 4,000 rows; 3 % above
    0.1 ends the sequence there, although nothing lies between the stricter cutoffs."""
    n = 4000
    rows = [("en", 100, 500, 35 if i < 48 else 18 if i < 168 else 0, 0, 0, True) for i in range(n)]
    df = spark.createDataFrame(rows, "stratum string, " + ", ".join(f"{f} bigint" for f in quality.FEATURES) + ", good boolean")
    assert quality.thresholds(df, max_false=0.02)["en"]["symbols_per_word"] == 0.2


def test_copies_of_a_text_are_one_trial(spark):
    text = " ".join(f"word{i}" for i in range(80))
    docs = spark.createDataFrame([(i, text if i < 3000 else f"{text} {i}", "en") for i in range(3100)], "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(3100)], "doc_id bigint, quality int, toxic int")
    extra = spark.createDataFrame([(9999, text.replace("word", "word###"), "en")], "doc_id bigint, text string, lang string")
    out = quality.quality_report(docs.unionByName(extra), labels)
    assert out.filter("size(failed_rules) > 0").count() == 0  # 101 different texts show nothing


def test_false_rejections_stay_below_the_limit():
    """Over many holdouts a cutoff that rejects twice the allowed rate is almost never shown safe."""
    rng, limit, wrong = random.Random(4), 0.05, 0
    for _ in range(300):
        hits = sum(rng.random() < 2 * limit for _ in range(400))
        wrong += quality.shown(hits, 400, limit, 0.05)
    assert wrong == 0


def test_quality_report(spark, clashing_docs, odd_rows):
    labels = spark.createDataFrame([(100, 1, 0), (None, 1, 0), (101, None, 0), (99999, 1, 1)], "doc_id bigint, quality int, toxic int")
    got = quality.quality_report(clashing_docs, labels).collect()
    want = Counter()
    for i, t, lang, *_ in odd_rows:
        c = counts_brute(t) if len(t or "") < 5000 else quality.base_counts(t)
        failed = c[0] < 50 or 100 * c[4] > 50 * c[0]
        want[(i, *c, failed, not failed)] += 1
    assert Counter((r["doc_id"], *(r[f] for f in quality.FEATURES), r["base_failed"], r["kept"]) for r in got) == want


def test_rules_reject_junk_and_keep_the_good(spark):
    rng = random.Random(9)
    good = lambda: " ".join(f"word{rng.randint(0, 5000)}" for _ in range(80))
    junk = lambda: " ".join(f"word{rng.randint(0, 5000)} ###" for _ in range(80))
    rows = [(i, good() if i % 10 else junk(), "en") for i in range(3300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(4)
    labels = spark.createDataFrame([(i, int(i % 10 > 0), 0) for i in range(2400)], "doc_id bigint, quality int, toxic int")
    got = quality.quality_report(docs, labels).collect()
    assert all(r["kept"] == (r["doc_id"] % 10 > 0) for r in got)
    assert all("symbols_per_word" in r["failed_rules"] for r in got if not r["kept"])


# ---- page text -----------------------------------------------------------------------

def lcs_length(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def test_common_lines_is_a_longest_common_subsequence():
    rng = random.Random(6)
    for _ in range(500):
        a, b = ([rng.randint(0, 5) for _ in range(rng.randint(0, 14))] for _ in range(2))
        at = common_lines(a, b)
        rest = iter(b)
        assert at == sorted(set(at)) and all(a[i] in rest for i in at) and len(at) == lcs_length(a, b)


def test_blocks():
    page = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style></head><body class="has-sidebar"><header>Site</header>
    <nav><ul><li>Home</ul></nav><div id="cookie-notice">We use</div><article class="post"><h1>T &amp; U&nbsp;V</h1><p><b>One.<br>
    more<p>Two &lt;x&gt; &amp am<div class="ad">Buy</div><form>f</form><section id=comments><article>nice!</article></section>
    <script>if (a<b) "</p>"</script></article><aside>side</aside><footer>&copy; foot"""
    assert [t for t, z in blocks(page) if z == "main"] == ["T & U V", "One. more", "Two <x> & am"]
    assert {t for t, z in blocks(page) if z == "boiler"} == {"Site", "Home", "We use", "Buy", "f", "nice!", "side", "© foot"}
    assert blocks(None) == [] == blocks("") == blocks("<p> </p><!-- c --> <br>")
    assert blocks("a < b & c <") == [("a < b & c <", "free")]
    assert blocks("<main><p>m</p></main><p>out") == [("m", "main"), ("out", "boiler")]


@pytest.mark.parametrize("open_tag", ['<div class="layout has-sidebar">', '<div id="content-with-sidebar">', '<div class="sidebar">',
                                      '<section class="page has-fixed-header">', '<div class="site-notice">'])
@pytest.mark.parametrize("own", ["<article><p>text</p></article>", "<main><p>text</p></main>", "<h1>text</h1>",
                                 "<div role=main><p>text</p></div>"])
def test_a_name_never_drops_what_holds_the_article(open_tag, own):
    kind = open_tag[1:].split()[0]
    assert [t for t, z in blocks(f"<nav>n</nav>{open_tag}{own}</{kind}>") if z != "boiler"] == ["text"]


def test_a_name_inside_the_article_only_raises_a_doubt():
    page = """<article><h1>T</h1><p>a</p><h2 id="social-history">S</h2><p>b</p><section id="related-work"><h2>R</h2><p>c</p></section>
    <pre>x <span class="comment"># d</span></pre><div class="notice">e</div><div class="ad">Buy</div></article>
    <div id="comments"><article>nice</article></div><div class="related-posts"><article>other</article></div>"""
    assert [t for t, z in blocks(page) if z == "main"] == ["T", "a", "S", "b", "R", "c", "x # d", "e"]
    assert [t for t, z in blocks(page) if z == "boiler"] == ["Buy", "nice", "other"]
    assert [t for t, z in blocks('<main><p>m</p><div class="related"><article>o</article></div></main>') if z == "main"] == ["m"]
    # nothing else on the page: the name counts for nothing
    assert blocks('<div class="menu"><p>soup</p></div>') == [("soup", "free")]


def test_differencing_settles_the_doubt(spark):
    def page(i, links, work):
        return (f'<div class="page has-sidebar"><article><h1>title {i}</h1><p>text {i}</p><div class="share-links"><p>{links}</p></div>'
                f'<section id="related-work"><h2>Related work</h2><p>{work}</p></section></article></div>')
    rows = [(i, f"http://a.example.org/{i}", page(i, "Post this", f"work {i}")) for i in range(4)]
    rows += [(10, "http://b.example.org/x", page(1, "Post this", "work")), (11, "http://b.example.org/y", page(1, "Post this", "work 2"))]
    got = {r["page_id"]: r for r in html_text.extract_pages(pages_of(spark, rows)).collect()}
    for i in range(4):
        assert got[i]["text"] == f"title {i}\n\ntext {i}\n\nRelated work\n\nwork {i}" and got[i]["n_deleted"] == 1
    # a version of the same article confirms nothing
    assert got[10]["text"] == "title 1\n\ntext 1\n\nPost this\n\nRelated work\n\nwork" and got[10]["n_deleted"] == 0


def pages_of(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string")


TOP, END = "<div>Welcome to the site</div><p>All rights reserved", "<div>Contact us</div>"


def test_shared_lines_of_the_nearest_page_go(spark):
    rows = [(i, f"https://H.example.com/a/{i:03d}?q=1", f"{TOP}<p>own text {i}</p><p>second {i}</p>{END}") for i in range(30)]
    rows += [(100, "https://other.example.com/a/001", f"{TOP}<p>alone</p>"),
             (101, "http://copy.example.org/x", "<p>same</p>"), (102, "http://copy.example.org/x/", "<p>same</p>"),
             (103, "http://art.example.org/1", "<article><p>quoted</p><p>one</p></article>"),
             (104, "http://art.example.org/2", "<article><p>quoted</p><p>two</p></article>"),
             (105, None, None), (106, "no url", ""), (None, "https://h.example.com/zz", f"{TOP}<p>no id</p>")]
    got = {r["page_id"]: r for r in html_text.extract_pages(pages_of(spark, rows)).collect()}
    assert len(got) == len(rows)
    for i in range(30):
        assert got[i]["text"] == f"own text {i}\n\nsecond {i}" and got[i]["n_chars"] == len(got[i]["text"])
        assert abs(got[i]["pair_page_id"] - i) == 1
    assert got[100]["text"] == "Welcome to the site\n\nAll rights reserved\n\nalone" and got[100]["pair_page_id"] is None
    assert got[101]["text"] == got[102]["text"] == "same"
    assert got[103]["text"] == "quoted\n\none" and got[104]["text"] == "quoted\n\ntwo"
    assert got[105]["text"] == got[106]["text"] == "" and got[None]["text"] == "no id"


@pytest.mark.parametrize("size", [3, 1000])
def test_copies_are_paired_with_the_nearest_other_page(spark, monkeypatch, size):
    monkeypatch.setattr(html_text, "BLOCK_PAGES", size)
    page = lambda t: f"{TOP}<p>{t}</p>{END}"
    rows = [(1, "http://h.example.org/a", page("first")), (2, "http://h.example.org/z", page("last"))]
    # copies by query, fragment and slash, and re-crawls in other markup, over many blocks of three
    rows += [(100 + i, f"http://h.example.org/m{('?q=%d' % i, '#top%d' % i, '/')[i % 3]}", page("copied")) for i in range(20)]
    rows += [(200 + i, f"http://h.example.org/m/{i:02d}", f"<!-- {i} -->" + page("copied").replace("div", "p")) for i in range(20)]
    rows += [(300 + i, f"http://only.example.org/m?{i}", page("alone")) for i in range(7)]
    got = {r["page_id"]: r for r in html_text.extract_pages(pages_of(spark, rows)).collect()}
    assert len(got) == len(rows) and got[1]["text"] == "first" and got[2]["text"] == "last"
    for i in [*range(100, 120), *range(200, 220)]:
        assert got[i]["text"] == "copied" and got[i]["pair_page_id"] == 1, i
    assert got[1]["pair_page_id"] in range(100, 220) and got[2]["pair_page_id"] in range(100, 220)
    for i in range(300, 307):
        assert got[i]["text"].split("\n\n")[2] == "alone" and got[i]["pair_page_id"] is None and got[i]["n_deleted"] == 0


def test_copies_pair_alike_however_the_blocks_are_cut(spark, monkeypatch):
    rng = random.Random(18)
    rows = [(i, f"https://{rng.choice('ab')}.example.com/{rng.randint(0, 20)}?{i}", f"<p>top</p><p>line {rng.randint(0, 1)}</p>") for i in range(150)]
    by_page, lines = sorted(rows, key=lambda r: (r[1].split("?")[0], r[0])), {r[0]: r[2] for r in rows}
    want = {}
    for at, (i, url, html) in enumerate(by_page):
        host, path = url.split("?")[0].rsplit("/", 1)
        near = []
        for side in (reversed(by_page[:at]), by_page[at + 1:]):
            other = next((r for r in side if r[1].startswith(host + "/") and r[2] != html), None)
            if other:
                a, b = f"/{path}", "/" + other[1].split("?")[0].rsplit("/", 1)[1]
                near.append((next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b))), other[0]))
        want[i] = max(near, key=lambda x: x[0])[1] if near else None
    for size in (2, 5, 1000):
        monkeypatch.setattr(html_text, "BLOCK_PAGES", size)
        got = html_text.extract_pages(pages_of(spark, rows)).collect()
        assert {r["page_id"]: r["pair_page_id"] for r in got} == want, size
        assert all(f"<p>{r['text']}</p>" == lines[r["page_id"]][10:] for r in got)


def test_result_does_not_depend_on_the_cut_into_blocks(spark, monkeypatch):
    rng = random.Random(8)
    rows = [(i, f"https://{rng.choice('ab')}.example.com/{rng.randint(0, 40)}/{rng.randint(0, 9)}",
             "".join(f"<p>line {rng.randint(0, 12)}</p>" for _ in range(rng.randint(0, 9)))) for i in range(150)]
    rows += rows[:20]  # repeated rows
    results = []
    for size, parts in ((3, 2), (1000, 5)):
        monkeypatch.setattr(html_text, "BLOCK_PAGES", size)
        results.append(Counter(tuple(r) for r in html_text.extract_pages(pages_of(spark, rows).repartition(parts)).collect()))
    assert results[0] == results[1] and results[0].total() == 170


def test_empty_tables_and_clashing_columns(spark, empty_docs):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert pii.pseudonymise(empty_docs).count() == 0
    assert quality.quality_report(empty_docs, labels).count() == 0
    assert html_text.extract_pages(pages_of(spark, [])).count() == 0
    page = pages_of(spark, [(1, "http://a.b/c", "<p>x</p>")]).select("*", *[F.lit(0).alias(c) for c in ("digest", "host", "path", "block", "place", "lines")])
    assert html_text.extract_pages(page).first()["text"] == "x"

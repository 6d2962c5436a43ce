"""Main text of web pages by nearest-URL differencing.

Pages of a host that stand next to each other in URL-path order are mostly made from one
template. Each page is paired with the nearest page before or after it whose lines are
not the same as its own (copies expose nothing), the one that shares the longer beginning
of its path, the lines (blocks of text) of the two are aligned by longest common
subsequence, and lines that both have are deleted. What differencing cannot know is
taken from the markup: lines inside the page's own article or main element are never
deleted, even if a neighbour quotes them, and menus, footers, adverts and the like are
dropped even on a host with one page.
"""

from __future__ import annotations

import os.path
from bisect import bisect_right
from collections.abc import Iterator
from itertools import islice

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tessera.llm.common import materialise
from tessera.llm.html_blocks import BOILER, FREE, MAIN, page_blocks
from tessera.operators.sorting import with_position

#: Distinct pages per block of the URL order, and the largest number of blocks: the list of
#: keys that every task gets has at most three times so many, at any input size.
BLOCK_PAGES, MAX_BLOCKS = 128, 10_000
_HOST = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#]*)"
_PATH = r"^(?:(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*)?([^?#]*)"


def host_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case, and path without '/' at its end; '' for a URL without them."""
    known = F.coalesce(url, F.lit(""))
    return F.lower(F.regexp_extract(known, _HOST, 1)), F.regexp_replace(F.regexp_extract(known, _PATH, 1), "/+$", "")


def common_lines(a: list[int], b: list[int]) -> list[int]:
    """Positions in ``a`` of a longest common subsequence of ``a`` and ``b``: one row of bits
    per element of ``a``, a machine word for 64 elements of ``b``."""
    lo, hi_a, hi_b = 0, len(a), len(b)
    while lo < min(hi_a, hi_b) and a[lo] == b[lo]:
        lo += 1
    while min(hi_a, hi_b) > lo and a[hi_a - 1] == b[hi_b - 1]:
        hi_a, hi_b = hi_a - 1, hi_b - 1
    here = set(a[lo:hi_a])
    other = [x for x in b[lo:hi_b] if x in here]
    there = set(other)
    mine = [i for i in range(lo, hi_a) if a[i] in there]
    at: dict[int, int] = {}
    for j, x in enumerate(other):
        at[x] = at.get(x, 0) | 1 << j
    full, rows = (1 << len(other)) - 1, []
    row = full
    for i in mine:
        hit = row & at[a[i]]
        row = ((row + hit) | (row - hit)) & full
        rows.append(row)
    kept, i, j = [], len(mine), len(other)
    while i and j:
        if rows[i - 1] >> (j - 1) & 1:
            j -= 1
            continue
        i -= 1
        if not i or rows[i - 1] >> (j - 1) & 1:
            kept.append(mine[i])
            j -= 1
    return [*range(lo), *reversed(kept), *range(hi_a, len(a))]


_SLICE = 64
_KEY = ["host", "path", "page_id", "digest"]


def _order(host: str, path: str, page_id, digest: int) -> tuple:
    """The order of Spark's sort: text by UTF-8 bytes, null ids first."""
    return host.encode(), path.encode(), page_id is not None, 0 if page_id is None else page_id, digest


def _print(lines: list[int]) -> int:
    """One signed 64-bit number for a page's lines: equal for copies."""
    return xxhash.xxh64_intdigest(b"".join(x.to_bytes(8, "little") for x in lines)) - (1 << 63)


@F.arrow_udf(LongType())
def _lines_print(html: pa.Array) -> pa.Array:
    return pa.array([_print([xxhash.xxh64_intdigest(t) for t, *_ in page_blocks(h.as_py())]) for h in html], pa.int64())


def _cuts(rows: DataFrame) -> tuple[list[tuple], dict[tuple, list[int]]]:
    """(first keys of the blocks but the first, blocks to which a page of another block is
    copied by its key) of the URL order cut into blocks of equal numbers of distinct pages.
    A block gets the last page before it with other lines than its first page, and the
    first after it with other lines than its last, if on the same host."""
    keys = materialise(rows.select(*_KEY, _lines_print("html").alias("lines")).distinct(), "urls")
    size = max(BLOCK_PAGES, -(-keys.count() // MAX_BLOCKS))
    placed = with_position(keys, _KEY, "pos").withColumn("b", F.expr(f"(pos - 1) div {size}"))
    at_first, at_last = F.pmod(F.col("pos") - 1, F.lit(size)) == 0, F.pmod(F.col("pos"), F.lit(size)) == 0
    ends = placed.filter(at_first | at_last).select("*", at_first.alias("is_first"), at_last.alias("is_last")).collect()
    first, last = {r["b"]: r for r in ends if r["is_first"]}, {r["b"]: r for r in ends if r["is_last"]}

    # In each block the first page other than its first, and the last other than its last.
    page = F.struct("host", "lines")
    limits = [F.broadcast(placed.filter(here).select("b", page.alias(name))) for here, name in ((at_first, "a"), (at_last, "z"))]
    turns = placed.join(limits[0], "b").join(limits[1], "b", "left").groupBy("b").agg(
        F.min(F.when(page != F.col("a"), F.col("pos"))).alias("a"), F.max(F.when(page != F.col("z"), F.col("pos"))).alias("z")).collect()
    wanted = rows.sparkSession.createDataFrame([(p,) for r in turns for p in (r["a"], r["z"]) if p is not None], "pos bigint")
    at = {r["pos"]: r for r in placed.join(F.broadcast(wanted.distinct()), "pos").collect()}
    turn = {r["b"]: (at.get(r["a"]), at.get(r["z"])) for r in turns}

    copies: dict[tuple, list[int]] = {}
    for side, step, inner, outer in ((1, 1, first, last), (0, -1, last, first)):
        carried = None  # into the block before in the walk, for its own nearest page
        for b in (range(1, len(first)) if step > 0 else range(len(first) - 2, -1, -1)):
            mine = inner[b]
            near = outer[b - step]
            if (near["host"], near["lines"]) == (mine["host"], mine["lines"]):
                near = turn[b - step][side] or carried
            carried = near if near and near["host"] == mine["host"] else None
            if carried:
                copies.setdefault(_order(*(carried[k] for k in _KEY)), []).append(b)
    return [_order(*(first[b][k] for k in _KEY)) for b in range(1, len(first))], copies


def _places(firsts: list[tuple], copies: dict[tuple, list[int]]):
    """UDF of a key: its block as [2 b], and for a page that is copied to blocks b' also
    [.., 2 b' + 1]."""
    @F.pandas_udf("array<int>")
    def places(host: pd.Series, path: pd.Series, page_id: pd.Series, digest: pd.Series) -> pd.Series:
        out = []
        for h, p, i, d in zip(host, path, page_id, digest):
            key = _order(h, p, None if i is None else int(i), d)  # as text: a null would turn the ids into floats
            out.append([2 * bisect_right(firsts, key), *(2 * b + 1 for b in copies.get(key, ()))])
        return pd.Series(out)

    return places


class _Page:
    """A distinct page in URL order, with the ids and URLs of its rows."""

    def __init__(self, row: dict):
        self.block, self.own = divmod(row["place"], 2)
        self.own = not self.own
        self.key, self.host, self.path = (row["page_id"], row["digest"]), row["host"], row["path"]
        page = page_blocks(row["html"])
        self.texts, self.zones = [t for t, *_ in page], tuple((z, doubt) for _, z, doubt in page)
        self.lines = [xxhash.xxh64_intdigest(t) for t in self.texts]
        self.print = _print(self.lines)
        self.urls = [row["url"]]

    def beside(self, other: _Page | None) -> bool:
        return other is not None and (other.block, other.host) == (self.block, self.host)

    def nearness(self, other: _Page | None) -> int:
        return len(os.path.commonprefix([self.path, other.path])) if self.beside(other) else -1


class _Run:
    """Neighbouring pages of a host with the same lines: their texts are held once."""

    def __init__(self, page: _Page):
        self.pages, self.zones = [], {}
        self.add(page)

    def takes(self, page: _Page) -> bool:
        return page.beside(self.pages[0]) and page.print == self.pages[0].print

    def add(self, page: _Page) -> None:
        self.pages.append(page)
        page.texts, page.lines = self.pages[0].texts, self.pages[0].lines
        page.zones = self.zones.setdefault(page.zones, page.zones)

    def rows(self, before: _Page | None, after: _Page | None) -> Iterator[tuple]:
        """Result rows of the run between its neighbours."""
        known: dict[tuple, tuple] = {}
        for page in self.pages:
            if not page.own:
                continue
            left, right = page.nearness(before), page.nearness(after)
            pair = None if max(left, right) < 0 else before if left >= right else after
            which = (page.zones, pair is before)
            if which not in known:
                shared = common_lines(page.lines, pair.lines) if pair else []
                text, deleted = main_text([(t, *z) for t, z in zip(page.texts, page.zones)], shared)
                known[which] = (text, len(text), pair.key[0] if pair else None, len(shared), deleted)
            for url in page.urls:
                yield (page.key[0], url, *known[which])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages in URL order, block after block: holds a run of copies and the page before it."""
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64()),
                        ("pair_page_id", pa.int64()), ("n_shared", pa.int64()), ("n_deleted", pa.int64())])

    def results() -> Iterator[tuple]:
        before = run = None
        for b in batches:
            for lo in range(0, b.num_rows, _SLICE):
                for row in b.slice(lo, _SLICE).to_pylist():
                    here = run and run.pages[-1]
                    if here and (row["page_id"], row["digest"], row["place"] // 2) == (*here.key, here.block):
                        here.urls.append(row["url"])
                        continue
                    page = _Page(row)
                    if run and run.takes(page):
                        run.add(page)
                        continue
                    if run:
                        yield from run.rows(before, page)
                    before, run = here, _Run(page)
        if run:
            yield from run.rows(before, None)

    found = results()
    while out := list(islice(found, _SLICE)):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)


def main_text(page: list[tuple[str, str, int]], shared: list[int]) -> tuple[str, int]:
    """(text, number of lines deleted because the paired page has them) of a page's blocks.
    A doubtful part of the article goes if the paired page has all its lines but not most of
    the article. Where deletion would leave nothing, nothing is deleted."""
    common = set(shared)
    main = [(i, t, doubt) for i, (t, zone, doubt) in enumerate(page) if zone == MAIN]
    if main:
        plain = [i in common for i, _, doubt in main if not doubt]
        other = 2 * sum(plain) < len(plain)
        stays = {doubt for i, _, doubt in main if not (doubt and other and i in common)}
        kept = [t for _, t, doubt in main if doubt in stays]
        return "\n\n".join(kept), sum(page[i][1] == BOILER for i in common) + len(main) - len(kept)
    free = [(i, t) for i, (t, zone, _) in enumerate(page) if zone == FREE]
    own = [t for i, t in free if i not in common]
    return "\n\n".join(own or [t for _, t in free]), len(common) if own else 0


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars, pair_page_id, n_shared, n_deleted.

    Null and empty html give an empty text. A null URL is of the empty host. A page without
    a page of other lines on its host has no pair (null), and nothing is deleted. Rows equal in id, URL and html count as one page when
    pairing and get equal results. Empty table: empty result. Other columns are not read.
    ``id_col`` must be an integer column.

    The URL order is cut into blocks at fixed ranks, found from the keys and one number for
    each page's lines; the pages are then shuffled once, by block, with the nearest page
    of other lines on either side of a block copied to it, so
    neither hot hosts nor the layout of the input matter."""
    host, path = host_path(pages[url_col])
    rows = pages.select(pages[id_col].cast("bigint").alias("page_id"),
                        F.xxhash64(F.coalesce(pages[url_col], F.lit("\x00")), F.coalesce(pages[html_col], F.lit(""))).alias("digest"),
                        host.alias("host"), path.alias("path"), pages[url_col].alias("url"), pages[html_col].alias("html"))
    places = _places(*_cuts(rows))
    dealt = rows.select("*", F.explode(places("host", "path", F.col("page_id").cast("string"), "digest")).alias("place")).withColumn("block", F.shiftright("place", 1))
    ordered = dealt.repartition("block").sortWithinPartitions("block", *_KEY)
    return ordered.mapInArrow(_extract, "page_id bigint, url string, text string, n_chars bigint, "
                                        "pair_page_id bigint, n_shared bigint, n_deleted bigint")

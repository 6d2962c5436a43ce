"""Spelling variants: words one edit apart, found in a trie of letter-group counts.

A word's letters fall into groups; the counts of the groups, one after the other, are its
path in a trie. One edit changes a path little: the longer of two words has one letter more
in one group (a surplus), and of two words of equal length one has a surplus in one group and
a deficit in another, or their paths are equal. A depth-first search of the words' trie against
itself therefore spends one surplus, then one deficit, and the words of the leaves it reaches
are verified. Each pair has one direction only: at the first group where the paths differ the
searching word has more.

The top levels of the trie are the shuffle key. A word goes to its own cell, to be found, and to
the few cells its budget reaches, to search. Cells with too many words are cut by the next level of
the trie, and what is still too large is dealt to blocks in which every searching word
meets every found one once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import LOWER, UPPER, materialise, text_or_empty

# Fixed values of the words: runs of these letters, those of LEAST_LENGTH or more that occur
# LEAST_COUNT times; every DAMAGE-th occurrence by hash has a letter deleted.
LETTERS, LEAST_LENGTH, LEAST_COUNT, DAMAGE = r"[A-Za-zÀ-ÿ]", 5, 3, 97
#: Letter groups, the most telling first; other letters are dealt to them by code point.
GROUPS = ("ez", "aw", "ij", "nk", "tx", "rq", "svy", "ob", "lpf", "umg", "dhc", "éèêëñ", "äöüßç")
#: Levels of the trie that make the first cells; words and searches of a cell in one task.
TOP_LEVELS, CELL_WORDS, CELL_SEARCHES = 4, 50_000, 200_000
#: Candidate pairs verified at a time, and the longest words verified as one matrix.
VERIFY_PAIRS, MATRIX_LETTERS = 200_000, 64
_FOUND = -1  # the state of a word that waits to be found; 0, 1, 2: budget spent by a searching one


def occurrences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word) for every occurrence of a run of at least LEAST_LENGTH letters, damaged or not."""
    low = F.translate(text_or_empty(docs[text_col]), UPPER, LOWER)
    runs = F.regexp_extract_all(low, F.lit(f"{LETTERS}{{{LEAST_LENGTH},}}"), F.lit(0))
    rows = docs.select(F.coalesce(docs[id_col].cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    h: Column = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = (h % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return rows.select(F.when(h % DAMAGE == 0, cut).otherwise(F.col("run")).alias("word"))


def word_counts(words: DataFrame) -> DataFrame:
    """(word, n) of the words long and frequent enough; counts are combined per task first."""
    return (words.filter(F.length("word") >= LEAST_LENGTH).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") >= LEAST_COUNT))


def _group_table() -> np.ndarray:
    table = np.arange(256) % len(GROUPS)
    for g, letters in enumerate(GROUPS):
        table[[ord(c) for c in letters]] = g
    return table


def count_vectors(words: list[str]) -> np.ndarray:
    """(words, groups) counts; letters beyond Latin-1 are dealt like the others."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    group = _group_table()[points % 256]
    row = np.repeat(np.arange(len(words)), [len(w) for w in words])
    width = len(GROUPS)
    return np.bincount(row * width + group, minlength=len(words) * width).reshape(-1, width)


def _records(cells: np.ndarray, state: int, words: pa.Array, counts: pa.Array, keep: np.ndarray) -> pa.RecordBatch:
    """Rows (cell, state, word, n): a cell is the path's counts, four bytes each."""
    raw = np.ascontiguousarray(cells[keep].astype(">u4"))
    size = raw.shape[1] * 4
    offsets = pa.py_buffer((np.arange(len(raw) + 1) * size).astype(np.int32))
    cell = pa.Array.from_buffers(pa.binary(), len(raw), [None, offsets, pa.py_buffer(raw.tobytes())])
    at = pa.array(np.flatnonzero(keep))
    return pa.RecordBatch.from_arrays([cell, pa.array(np.full(len(raw), state, np.int32)), words.take(at), counts.take(at)],
                                      names=["cell", "state", "word", "n"])


_SCHEMA = "cell binary, state int, word string, n bigint"


def route(words: DataFrame, levels: int) -> DataFrame:
    """Each word to its own cell and to all cells its budget reaches in the first ``levels``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            word, n = batch.column(0), batch.column(1)
            top = count_vectors(word.to_pylist())[:, :levels]
            everyone = np.ones(len(top), bool)
            yield _records(top, _FOUND, word, n, everyone)
            yield _records(top, 0, word, n, everyone)
            for g in range(levels):
                less = top - (np.arange(levels) == g)
                has = top[:, g] > 0
                yield _records(less, 1, word, n, has)
                for h in range(g + 1, levels):
                    yield _records(less + (np.arange(levels) == h), 2, word, n, has)

    return words.select("word", "n").mapInArrow(run, _SCHEMA)


def _descend(records: DataFrame, levels: int) -> DataFrame:
    """The records of cells of ``levels`` levels, one level further down the trie."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            state, word, n = batch.column(1).to_numpy(), batch.column(2), batch.column(3)
            if not len(state):
                continue
            path = np.frombuffer(b"".join(batch.column(0).to_pylist()), ">u4").reshape(len(state), levels).astype(np.int64)
            own = count_vectors(word.to_pylist())[:, levels]
            for before, after, step in ((_FOUND, _FOUND, 0), (0, 0, 0), (1, 1, 0), (2, 2, 0), (0, 1, -1), (1, 2, 1)):
                keep = (state == before) & (own + step >= 0)
                yield _records(np.column_stack([path, own + step]), after, word, n, keep)

    return records.mapInArrow(run, _SCHEMA)


def cells_of(words: DataFrame, cell_words: int = CELL_WORDS, cell_searches: int = CELL_SEARCHES) -> DataFrame:
    """(cell, state, word, n, block): a (cell, block) has at most about ``cell_words`` words to be
    found and ``cell_searches`` searching ones, and every pair of both meets in one block.

    The lists of cells to cut have fewer than records / limit rows and are broadcast."""
    done, records, levels = None, materialise(route(words, TOP_LEVELS), "cells"), TOP_LEVELS
    while levels < len(GROUPS):
        large = (records.filter(F.col("state") == _FOUND).groupBy("cell").agg(F.count(F.lit(1)).alias("size"))
                 .filter(F.col("size") > cell_words).select("cell"))
        large = materialise(large, "large-cells")
        if large.isEmpty():
            break
        light = records.join(F.broadcast(large), "cell", "left_anti")
        done = light if done is None else done.unionByName(light)
        records = materialise(_descend(records.join(F.broadcast(large), "cell", "left_semi"), levels), "cells")
        levels += 1
    cells = records if done is None else done.unionByName(records)
    found = F.col("state") == _FOUND
    sizes = cells.groupBy("cell").agg(F.count(F.when(found, 1)).alias("f"), F.count(F.when(~found, 1)).alias("s"))
    cut = sizes.filter((F.col("f") > cell_words) | (F.col("s") > cell_searches)).select(
        "cell", F.ceil(F.col("f") / cell_words).alias("fb"), F.ceil(F.col("s") / cell_searches).alias("sb"))
    cut = materialise(cut, "cut-cells")
    h = F.xxhash64("word")
    # where a large cell has nothing to be found, nothing need search
    rows = cells.join(F.broadcast(cut), "cell", "left").filter(F.col("fb").isNull() | (F.col("fb") >= 1))
    mine = F.pmod(h, F.when(found, F.col("fb")).otherwise(F.col("sb")))
    # block = found block * sb + search block; each row goes to all blocks of its own part
    blocks = F.when(F.col("fb").isNull(), F.array(F.lit(0).cast("bigint"))).when(
        found, F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("sb") - 1), lambda b: mine * F.col("sb") + b)).otherwise(
        F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("fb") - 1), lambda b: b * F.col("sb") + mine))
    return rows.withColumn("block", F.explode(blocks)).select("cell", "state", "word", "n", "block")


def one_edit(a: str, b: str) -> bool:
    """Whether exactly one letter is inserted, deleted or replaced."""
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > 1 or a == b:
        return False
    i = 0
    while i < len(b) and a[i] == b[i]:
        i += 1
    return a[i + 1:] == b[i + (len(a) == len(b)):]


class _Verifier:
    """Verifies candidate pairs of (searching, found) words many at a time."""

    def __init__(self, words: list[str]):
        self.words, self.length = words, np.array([len(w) for w in words], np.int64)
        self.width = min(MATRIX_LETTERS, int(self.length.max(initial=0))) + 1
        self.letters = np.zeros((len(words), self.width), np.uint32)
        short = self.length < self.width
        if short.any():
            points = np.frombuffer("".join([w for w, s in zip(words, short) if s]).encode("utf-32-le"), np.uint32)
            lengths = np.where(short, self.length, 0)
            row = np.repeat(np.arange(len(words)), lengths)
            col = np.arange(len(points)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            self.letters[row, col] = points

    def check(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which pairs are one edit apart."""
        la, lb = self.length[a], self.length[b]
        swap = la < lb
        a, b = np.where(swap, b, a), np.where(swap, a, b)
        la, lb = np.maximum(la, lb), np.minimum(la, lb)
        ok = la - lb <= 1
        in_matrix = ok & (la < self.width)
        for k in np.flatnonzero(ok & ~in_matrix):
            ok[k] = one_edit(self.words[a[k]], self.words[b[k]])
        k = np.flatnonzero(in_matrix)
        x, y = self.letters[a[k]], self.letters[b[k]]
        differs = x != y
        replaced = (differs.sum(axis=1) == 1) & (la[k] == lb[k])
        first = differs.argmax(axis=1)  # the shorter word goes on there without a letter of the longer one
        shifted = (x[:, 1:] == y[:, :-1]) | (np.arange(self.width - 1) < first[:, None])
        ok[k] = replaced | (shifted.all(axis=1) & (la[k] == lb[k] + 1))
        return ok


def _trie(paths: np.ndarray, rows: np.ndarray) -> dict:
    """Nested dicts by count; a leaf is the array of its rows."""
    root: dict = {}
    order = np.lexsort(paths.T[::-1]) if paths.shape[1] else np.arange(len(paths))
    paths, rows = paths[order], rows[order]
    new = np.r_[True, (paths[1:] != paths[:-1]).any(axis=1)] if len(paths) else np.zeros(0, bool)
    starts = np.flatnonzero(new)
    for lo, hi, path in zip(starts.tolist(), [*starts[1:].tolist(), len(paths)], paths[starts].tolist()):
        node = root
        for c in path[:-1]:
            node = node.setdefault(c, {})
        node[path[-1] if path else 0] = rows[lo:hi]
    return root


def search(a: dict, b: dict, levels: int, state: int, out: list) -> None:
    """Depth-first search of the searching words' trie ``a`` in the found words' trie ``b``: appends
    (rows of a, rows of b, same path). At each level the counts agree, or the one surplus
    (state 0 -> 1) or the one deficit (1 -> 2) is spent."""
    last = levels == 1
    for c, mine in a.items():
        for step, after in ((0, state), (-1, 1)) if state == 0 else ((0, 1), (1, 2)) if state == 1 else ((0, 2),):
            theirs = b.get(c + step)
            if theirs is None:
                continue
            if last:
                out.append((mine, theirs, after == 0))
            else:
                search(mine, theirs, levels - 1, after, out)


def near_in_cell(levels: int, state: np.ndarray, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (searching row, found row) of one cell of ``levels`` levels, each once."""
    vectors = count_vectors(words)[:, levels:]
    rest = vectors.shape[1]
    if not rest:  # the cell is a leaf: one level that all share
        vectors, rest = np.zeros((len(words), 1), np.int64), 1
    found = np.flatnonzero(state == _FOUND)
    verifier, trie = _Verifier(words), _trie(vectors[found], found)
    text = np.array(words, object)
    a, b, held = [], [], 0

    def flush():
        x, y = np.concatenate(a), np.concatenate(b)
        ok = verifier.check(x, y)
        return x[ok], y[ok]

    for s in (0, 1, 2):
        searching = np.flatnonzero(state == s)
        if not len(searching) or not len(found):
            continue
        leaves: list = []
        search(_trie(vectors[searching], searching), trie, rest, s, leaves)
        for mine, theirs, same in leaves:
            for lo in range(0, len(mine), max(1, VERIFY_PAIRS // len(theirs))):
                part = mine[lo:lo + max(1, VERIFY_PAIRS // len(theirs))]
                x, y = np.repeat(part, len(theirs)), np.tile(theirs, len(part))
                if same:  # both words search here: one direction is enough
                    once = text[x] < text[y]
                    x, y = x[once], y[once]
                a.append(x)
                b.append(y)
                held += len(x)
                if held > VERIFY_PAIRS:
                    yield flush()
                    a, b, held = [], [], 0
    if a:
        yield flush()


def near_words(words: DataFrame, cell_words: int = CELL_WORDS, cell_searches: int = CELL_SEARCHES) -> DataFrame:
    """(word, other, other_n): every word of ``words`` (word, n; distinct) and each word one edit
    from it, both ways."""
    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        words_, n = group.column("word").to_pylist(), group.column("n").to_numpy()
        levels = len(group.column("cell")[0].as_py()) // 4
        pairs = [p for p in near_in_cell(levels, group.column("state").to_numpy(), words_) if len(p[0])]
        x = np.concatenate([p[0] for p in pairs]) if pairs else np.zeros(0, np.int64)
        y = np.concatenate([p[1] for p in pairs]) if pairs else np.zeros(0, np.int64)
        u, v = pa.array(np.r_[x, y]), pa.array(np.r_[y, x])
        column = pa.array(words_, pa.string())
        return pa.table({"word": column.take(u), "other": column.take(v), "other_n": pa.array(n).take(v)})

    return (cells_of(words, cell_words, cell_searches).groupBy("cell", "block")
            .applyInArrow(run, "word string, other string, other_n bigint"))


def follow_forms(forms: DataFrame) -> DataFrame:
    """(word, root) for ``forms`` (word, form; null: no form): forms followed to the last.

    Pointer doubling: a pointer is replaced by its target's pointer each round. A form has
    twice its word's count at least, so chains are no longer than 63 and six rounds end."""
    at = materialise(forms.select("word", F.coalesce("form", "word").alias("root")), "roots")
    while True:
        nxt = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = nxt.filter("root <> next")  # only pointers that lead on
        step = materialise(at.join(moved, "root", "left")
                           .select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("went")),
                           "roots")
        at = step.select("word", "root")
        if step.filter("went").isEmpty():
            return at


def group_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   cell_words: int = CELL_WORDS, cell_searches: int = CELL_SEARCHES) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    ``form`` is the near word of the largest count (of equal counts the smallest in code-point
    order) if that is at least twice the word's own, else null. Null and empty texts have no
    words; a null id hashes as an empty one. Repeated rows count each time. A very long text is
    read whole, and a very long run is one word, verified letter by letter. Empty table: empty
    result. Other columns are not read."""
    words = materialise(word_counts(occurrences(docs, id_col, text_col)), "words")
    best = near_words(words, cell_words, cell_searches).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("minus"), "other")).alias("best"))
    enough = -F.col("best.minus") >= 2 * F.col("n")
    forms = materialise(words.join(best, "word", "left").select(
        "word", F.when(enough, F.col("best.other")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(enough, -F.col("best.minus")).alias("form_n")), "forms")
    return forms.join(follow_forms(forms), "word").select("word", "form", "root", "n", "n_near", "form_n")

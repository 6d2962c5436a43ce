"""Language identification by a string kernel.

The kernel of two texts is the number of n-grams, of one to ``NGRAMS`` characters, present in
both (blended spectrum, presence), divided by the root of what each has with itself. Nyström:
a text is described by its kernels with a few landmark texts, through the inverse root of the
landmarks' own kernel matrix. One ridge regression per language on these descriptions scores a
text. Fitting sees a bounded sample of distinct labelled texts; scoring multiplies batches of
presence rows with the landmarks' rows, then kernels with weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import materialise

#: Longest n-gram; n-grams of a length are hashed to 2^HASH_BITS numbers of their own.
NGRAMS, HASH_BITS = 3, 18
#: Labelled texts the model is fitted on, of at most so many characters each, and landmarks.
FIT_ROWS, FIT_CHARS, LANDMARKS = 4000, 20_000, 160
#: Ridge penalty, and the part of the largest eigenvalue below which a landmark direction is noise.
RIDGE, LEAST_PART = 1e-3, 1e-6
#: Languages told apart at most (the most frequent of the labelled texts).
LANGUAGES = 400
#: Entries of one batch's presence rows.
BATCH_ENTRIES = 4 << 20
UNKNOWN = "und"
_SYMBOLS: list[np.ndarray] = []


def _symbols() -> np.ndarray:
    """By code point: a mixed 32-bit number for a letter, 0 for anything else."""
    if not _SYMBOLS:
        points = np.arange(0x110000, dtype=np.uint32)
        letter = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
        mixed = (points + 1) * np.uint32(0x9E3779B1)
        _SYMBOLS.append(np.where(letter, mixed ^ (mixed >> np.uint32(15)) | np.uint32(1), 0).astype(np.uint32))
    return _SYMBOLS[0]


def ngram_codes(text: str | None) -> list[np.ndarray] | None:
    """Codes of the text's n-grams by length, repeats included; None without a letter. Letters
    are lower-cased; what lies between two words is one blank, also before the first and after
    the last; n-grams of blanks alone are left out."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    symbol = _symbols()[points]
    symbol = np.concatenate([np.zeros(1, np.uint32), symbol, np.zeros(1, np.uint32)])
    symbol = symbol[(symbol != 0) | np.r_[True, symbol[:-1] != 0]]
    if len(symbol) < 2:
        return None
    shift, factor, out = np.uint32(32 - HASH_BITS), np.uint32(0x85EBCA6B), []
    rolling = symbol
    for n in range(NGRAMS):
        if n:
            rolling = rolling[:-1] * factor + symbol[n:]
        mixed = (rolling[symbol != 0] if not n else rolling) * np.uint32(0xC2B2AE35)
        out.append(((mixed ^ (mixed >> np.uint32(13))) * np.uint32(0x27D4EB2F) >> shift).astype(np.int64) + (n << HASH_BITS))
    return out


class _Distinct:
    """Counts distinct codes without sorting: the last writer of a slot is the one that counts."""

    def __init__(self):
        self.slot = np.zeros(NGRAMS << HASH_BITS, np.int32)

    def count(self, codes: np.ndarray) -> int:
        order = np.arange(len(codes), dtype=np.int32)
        self.slot[codes] = order
        return int((self.slot[codes] == order).sum())


@dataclass
class KernelModel:
    """``column``: code -> column of the presence rows (-1: in no landmark); ``landmarks``:
    (columns, landmarks) presence; ``norms`` of the landmarks; ``weights``: (landmarks,
    languages), Nyström's inverse root and the ridge weights in one matrix."""

    languages: list[str]
    column: np.ndarray
    landmarks: np.ndarray
    norms: np.ndarray
    weights: np.ndarray | None = None

    def kernels(self, texts: list[list[np.ndarray] | None]) -> np.ndarray:
        """(texts, landmarks) kernels of texts given by their codes; no letters: zeros."""
        width, own, distinct = self.landmarks.shape[0], np.ones(len(texts)), _Distinct()
        out = np.empty((len(texts), self.landmarks.shape[1]), np.float32)
        step = max(8, BATCH_ENTRIES // max(1, width))
        for lo in range(0, len(texts), step):
            part = texts[lo:lo + step]
            present = np.zeros((len(part), width + 1), np.float32)  # the last column takes what no landmark has
            for row, codes in enumerate(part):
                if codes is not None:
                    every = np.concatenate(codes)
                    own[lo + row] = distinct.count(every)
                    present[row, self.column[every]] = 1
            out[lo:lo + len(part)] = present[:, :width] @ self.landmarks
        return out / np.sqrt(own)[:, None].astype(np.float32) / self.norms

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        codes = [ngram_codes(t) for t in texts]
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        values = self.kernels(codes) @ self.weights
        best = values.argmax(axis=1)
        known = np.array([c is not None for c in codes], bool)
        score = np.where(known, np.clip(values.max(axis=1), 0, 1), 0.0)
        return [self.languages[b] if k else UNKNOWN for b, k in zip(best.tolist(), known.tolist())], score.astype(float)


def _landmark_model(languages: list[str], texts: list[list[np.ndarray]]) -> KernelModel:
    grams = [np.unique(np.concatenate(codes)) for codes in texts]
    used = np.unique(np.concatenate(grams)) if grams else np.zeros(0, np.int64)
    column = np.full(NGRAMS << HASH_BITS, -1, np.int32)
    column[used] = np.arange(len(used))
    present = np.zeros((len(used), len(grams)), np.float32)
    for k, g in enumerate(grams):
        present[column[g], k] = 1
    return KernelModel(languages, column, present, np.sqrt([len(g) for g in grams]).astype(np.float32))


def fit_kernel(rows: list[tuple[str, str]], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> KernelModel:
    """The model of (language, text) rows; the first rows of each language in turn become
    landmarks. Rows without a letter are left out; without rows no language is known."""
    coded = [(lang, c) for lang, t in rows if (c := ngram_codes(t)) is not None]
    languages = sorted({lang for lang, _ in coded})
    by_lang = {lang: [c for at, c in coded if at == lang] for lang in languages}
    turns = sorted((i, lang) for lang in languages for i in range(len(by_lang[lang])))
    chosen = [by_lang[lang][i] for i, lang in turns[:max(landmarks, len(languages))]]
    model = _landmark_model(languages, chosen)
    if not languages:
        return model
    values, vectors = np.linalg.eigh(model.kernels(chosen).astype(float))
    keep = values > LEAST_PART * values[-1]
    root = vectors[:, keep] / np.sqrt(values[keep])
    phi = model.kernels([c for _, c in coded]).astype(float) @ root
    target = np.array([[float(lang == x) for x in languages] for lang, _ in coded])
    # every language weighs the same, however many texts it has
    weight = 1 / (len(languages) * target.sum(axis=0))[target.argmax(axis=1)]
    gram = phi.T @ (phi * weight[:, None])
    solved = np.linalg.solve(gram + ridge * np.eye(len(gram)), phi.T @ (target * weight[:, None]))
    model.weights = (root @ solved).astype(np.float32)
    return model


def is_held_out(doc_id: Column) -> Column:
    """crc32 of the id as text leaves 2 by 4; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit_sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, fit_rows: int = FIT_ROWS) -> list[tuple[str, str]]:
    """At most ``fit_rows`` (language, text) rows that may be learned from, equally many of each
    language as far as it has them: distinct texts of at most FIT_CHARS characters, those with
    the smallest hashes. Only hashes are shuffled; the chosen ones (``fit_rows`` at most) are broadcast."""
    rows = docs.select(docs[text_col].alias("text"), docs[lang_col].cast("string").alias("lang"),
                       is_held_out(docs[id_col]).alias("held_out"))
    rows = rows.filter(F.col("text").isNotNull() & F.col("lang").isNotNull() & ~F.col("held_out")
                       & (F.length("text") <= FIT_CHARS) & F.col("text").rlike(r"\p{L}")).select("text", "lang")
    hashed = materialise(rows.select("lang", F.xxhash64("text").alias("hash")).distinct(), "labelled")
    sizes = hashed.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect()
    if not sizes:
        return []
    # of each language about twice its share, by the lowest part of the hash range, then the share itself
    share = max(1, fit_rows // len(sizes))
    limits = {r["lang"]: min((1 << 63) - 1, -(1 << 63) + int((2 * share + 50) / r["n"] * (1 << 64))) for r in sizes}
    limit = F.element_at(F.create_map(*[x for lang, v in limits.items() for x in (F.lit(lang), F.lit(v))]), F.col("lang"))
    turn = F.row_number().over(Window.partitionBy("lang").orderBy("hash"))
    chosen = (hashed.filter(F.col("hash") <= limit).withColumn("turn", turn).filter(F.col("turn") <= share)
              .select("lang", "hash"))
    drawn = (rows.withColumn("hash", F.xxhash64("text")).join(F.broadcast(chosen), ["lang", "hash"])
             .groupBy("lang", "hash").agg(F.min("text").alias("text")))
    return [(r["lang"], r["text"]) for r in sorted(drawn.collect(), key=lambda r: (r["hash"], r["lang"]))]


def identify_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                       fit_rows: int = FIT_ROWS, landmarks: int = LANDMARKS) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score (0 to 1).

    The model learns from rows that are not held out, have a language and a text. Null texts and
    those without a letter (empty, digits) are ``und`` with score 0; so is everything where nothing
    can be learned. Very long texts are read whole when scored, and not learned from. Equal texts
    get equal predictions, copies are learned once per language; of equal values the first
    language in order wins. A null id is carried and not held out. Empty table: empty
    result. Other columns are not read."""
    model = fit_kernel(fit_sample(docs, id_col, text_col, lang_col, fit_rows), landmarks)
    id_type = docs.select(docs[id_col]).schema[0].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                langs, score = shared.value.predict(part.column(2).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(langs, pa.string()),
                                                  pa.array(score)], names=["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(docs[id_col].alias("doc_id"), is_held_out(docs[id_col]).alias("held_out"), docs[text_col].alias("text"))
    return rows.mapInArrow(run, f"doc_id {id_type}, held_out boolean, lang_pred string, score double")

"""Tokenised documents packed into sequences of fixed length by the sum-of-squares rule."""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialise

CAPACITY, END_ID = 4096, 1
#: Sequences a task packs at a time, and the smallest such batch when that gives fewer than
#: ``PARALLEL`` batches. A batch ends with a few part-filled sequences.
BATCH_SEQUENCES, LEAST_SEQUENCES, PARALLEL = 1024, 128, 48
#: Words whose ids a Python worker remembers (0.8 KB each with what Python adds), in two generations.
CACHE_WORDS = 300_000
_SLICE = 64
# Beyond these characters lower-casing is left to the tokenizer itself.
_NOT_LATIN = re.compile("[^\x00-ɏ]|İ")
# Words of these characters alone (no special tokens, no white space of any kind) are cut into
# pieces here; the rest goes through the whole tokenizer.
_LATIN_WORD = re.compile("[!-~\xa1-\xac\xae-įı-ɏ]+")
# How the tokenizer cuts a word into pieces, and how it writes bytes as characters.
_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
_SPECIAL, _STOPS = "<|", (b".", b",", b";", b":", b"!", b"?")
_AS_THEMSELVES = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTE_CHARS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in set(_AS_THEMSELVES))}
_ENCODERS: dict[str, Encoder] = {}


class Encoder(dict):
    """Token ids of words, and of texts, as little-endian unsigned 32-bit bytes.

    The tokenizer never merges across white space, so a text's ids are its words' ids one
    after the other. The mapping holds the words of the younger generation and works out a
    missing one on the way. When it holds half of ``cache_words`` it becomes the older
    generation, which is looked into before a word is encoded again, so words in use move
    on and rare ones are forgotten; memory is bounded and nothing is ever cleared at once."""

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.bytes_of = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]
        self.half, self.older = cache_words // 2, {}

    @staticmethod
    def of(path: str) -> Encoder:
        if path not in _ENCODERS:
            _ENCODERS[path] = Encoder(path)
        return _ENCODERS[path]

    def __missing__(self, word: bytes) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = self.word_ids(word)
        self[word] = ids
        return ids

    def word_ids(self, word: bytes) -> bytes:
        if word.isalpha():  # ASCII letters
            return self.piece_ids(word.decode().lower())
        if word[:-1].isalpha() and word[-1:] in _STOPS:
            return self[word[:-1]] + self[word[-1:]]
        text = word.decode()
        if not _LATIN_WORD.fullmatch(text) or _SPECIAL in text:
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        pieces = _PIECES.findall(text.lower())
        if len(pieces) == 1:
            return self.piece_ids(pieces[0])
        return b"".join([self[p.encode()] for p in pieces])

    def piece_ids(self, piece: str) -> bytes:
        if not piece.isascii():
            piece = piece.encode().decode("latin-1").translate(_BYTE_CHARS)
        return b"".join([self.bytes_of[t.id] for t in self.model.tokenize(piece)])

    def encode(self, texts: list[str | None]) -> list[bytes]:
        if len(self) > self.half:
            self.older = dict(self)
            self.clear()
        known = self.__getitem__
        return [b"".join(map(known, (t if _NOT_LATIN.search(t) else t.lower()).encode().split())) if t else b""
                for t in texts]


def token_pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): each document's ids then
    ``end_id``, cut into pieces of ``capacity`` only where it is longer. Null text: just
    ``end_id``."""
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end, step = Encoder.of(tokenizer_path), np.array([end_id], "<u4").tobytes(), 4 * capacity
        for batch in batches:
            for lo in range(0, batch.num_rows, _SLICE):
                part = batch.slice(lo, _SLICE)
                at, out = [], {n: [] for n in names[1:]}
                for row, ids in enumerate(encoder.encode(part.column(1).to_pylist())):
                    ids += end
                    for k, first in enumerate(range(0, len(ids), step)):
                        piece = ids[first:first + step]
                        at.append(row)
                        for n, v in zip(names[1:], (k, first // 4, len(piece) // 4, zlib.crc32(piece), piece)):
                            out[n].append(v)
                types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(at, pa.int64())),
                                                  *(pa.array(out[n], t) for n, t in zip(names[1:], types))], names=names)

    schema = f"doc_id {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * with_ids
    return rows.mapInArrow(run, schema)


def sum_of_squares(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of every item: items in decreasing length, each placed where the sum
    over residual gaps of the squared number of open bins becomes smallest, a new bin
    included; of equal choices the fullest bin."""
    count = np.zeros(capacity + 1, np.int64)  # open bins by gap; full bins are not counted
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    made = 0
    for item in np.argsort(-lengths, kind="stable"):
        s = int(lengths[item])
        left = capacity - s
        best, gap = (2 * int(count[left]) + 1 if left else 0), capacity  # a new bin
        here = count[s:capacity]
        if here.any():
            # one bin fewer with gap g, one more with gap g - s: 2 (N[g-s] - N[g] + 1), full bins apart
            change = 2 * (count[:left] - here + 1)
            change[0] = 1 - 2 * here[0]
            change[here == 0] = np.iinfo(np.int64).max
            k = int(change.argmin())
            if change[k] <= best:
                gap = s + k
        if gap == capacity:
            b, made = made, made + 1
        else:
            b = open_bins[gap].pop()
            count[gap] -= 1
        bins[item], offsets[item] = b, capacity - gap
        if gap - s:
            open_bins[gap - s].append(b)
            count[gap - s] += 1
    return bins, offsets


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` plus sequence_id and offset (gapless from 0 in each sequence). Pieces are
    dealt by hash to batches of bounded size, each packed on its own; their number ``row``,
    which the result drops, deals identical pieces to all batches too. Read twice: pass a stored
    table."""
    tokens = pieces.agg(F.sum("length").alias("n")).first()["n"] or 0
    sequences = -(-tokens // capacity)
    batches = max(1, -(-sequences // BATCH_SEQUENCES), min(PARALLEL, sequences // LEAST_SEQUENCES))

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        batch = rows.pop("__batch").iloc[0]
        rows = rows.sort_values(["length", "ids_crc32", "doc_id", "start"], ascending=False, kind="stable")
        bins, offsets = sum_of_squares(rows["length"].to_numpy(), capacity)
        return rows.assign(sequence_id=(int(batch) << 32) + bins, offset=offsets)

    dealt = pieces.withColumn("__batch", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", "row"), F.lit(batches)))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return dealt.groupBy("__batch").applyInPandas(run, f"{schema}, sequence_id bigint, offset bigint").drop("row")


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                   capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """All documents packed: one row per piece with its sequence and offset.

    Null and empty texts are one token (the end id). Repeated rows are packed once each and
    dealt to all batches; equal lengths go by their checksum, id and start. A very long text is
    encoded whole and cut into as many pieces as it fills. Null ids are carried. Empty table: empty result. Other columns are not read."""
    pieces = token_pieces(docs, tokenizer_path, id_col, text_col, capacity, with_ids=with_ids)
    return pack(materialise(pieces.withColumn("row", F.monotonically_increasing_id()), "pieces"), capacity)

"""WARC archives in Zstandard: one frame per record, dictionary in a leading skippable frame.

The writer stores each payload once: of equal payloads of ``LEAST_REVISIT`` bytes or more
the page with the largest id is a response record and the others are revisit records
that name it. The reader streams an archive frame by frame (its memory is one record's,
whatever the archive's size), loads the dictionary, and checks frames, headers, lengths
and digests; a damaged record becomes a row with an ``error``.

Archives are opened in the tasks with ``pyarrow.fs``, so their folder may be any store that
it reaches from every executor (a shared mount, HDFS, S3, GCS).
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import attach_group, drop_marked, materialise, with_place
from tessera.session import scratch_path

LEAST_REVISIT = 1000
#: An archive is closed once it holds this many bytes.
ARCHIVE_BYTES = 32 << 20
#: The dictionary is trained on at most so many payloads of at most so many bytes each.
SAMPLE_ROWS, SAMPLE_BYTES, DICTIONARY_BYTES = 256, 1 << 16, 1 << 16
# Formats of Zstandard and WARC.
_FRAME, _SKIPPABLE, _DICTIONARY = 0xFD2FB528, 0x184D2A50, 0x184D2A5D
_VERSIONS = (b"WARC/1.0", b"WARC/1.1")
_REQUIRED = ("warc-type", "warc-record-id", "warc-date", "content-length")
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "1970-01-01T00:00:00Z"  # pages carry no date
_NAME = re.compile(rb"[!-9;-~]+")
_CONTROL = re.compile(r"[\x00-\x20\x7f]")


def train_dictionary(pages: DataFrame, html_col: str = "html") -> bytes:
    """A dictionary from a bounded sample of payloads, b'' where there is none."""
    html, size = pages[html_col], F.octet_length(pages[html_col])
    # a part of the hash range that holds twice the sample on average; no task sends more than the sample
    part = min(1.0, 2 * SAMPLE_ROWS / max(1, pages.count()))
    drawn = F.shiftrightunsigned(F.xxhash64(*[pages[c] for c in pages.columns]), 11) <= F.lit(int(part * (1 << 53)))
    rows = (pages.filter(drawn & (size > 0) & (size <= SAMPLE_BYTES)).select(html.alias("html")).limit(SAMPLE_ROWS)).collect()
    samples = [r["html"].encode() for r in rows]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes() if samples else b""
    except zstandard.ZstdError:  # too little to train on: the sample itself is the dictionary
        return b"".join(samples)[:DICTIONARY_BYTES]


# ---- writing -------------------------------------------------------------------------

def _record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + f"Content-Length: {len(block)}\r\n\r\n"
    return head.encode() + block + b"\r\n\r\n"


def page_record(page_id: int | None, url: str | None, payload: bytes | None, digest: str, refers_to: int | None,
                size: int | None = None) -> bytes:
    """Record of a page: a revisit of page ``refers_to`` if that is given, else a response. A revisit
    holds no payload, so its ``size`` in bytes is enough."""
    name = f"urn:x-page:{page_id}" if page_id is not None else f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, digest)}"
    uri = _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url) if url else "urn:x-page:unknown"
    revisit = refers_to is not None
    headers = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", f"<{name}>"), ("WARC-Date", _DATE),
               ("WARC-Target-URI", uri), ("Content-Type", "application/http;msgtype=response"),
               ("WARC-Payload-Digest", f"sha1:{digest}")]
    if revisit:
        headers += [("WARC-Refers-To", f"<urn:x-page:{refers_to}>"), ("WARC-Profile", _PROFILE)]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload) if size is None else size}\r\n\r\n".encode()
    return _record(headers, http if revisit else http + payload)


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    if not dictionary:
        return zstandard.ZstdCompressor(level=3, write_checksum=True)
    trained = zstandard.ZstdCompressionDict(dictionary)
    trained.precompute_compress(level=3)
    return zstandard.ZstdCompressor(dict_data=trained, write_checksum=True)


class _Writer:
    """Archives of one task. Names are new for every attempt: a retried task never meets
    files of the lost one, and only archives it reports at the end are ever read."""

    def __init__(self, folder: str, dictionary: bytes, archive_bytes: int):
        self.store, self.path = fs.FileSystem.from_uri(folder)
        self.store.create_dir(self.path, recursive=True)
        self.folder, self.dictionary, self.most = folder, dictionary, archive_bytes
        self.zstd, self.file, self.done = _compressor(dictionary), None, []

    def add(self, record: bytes) -> None:
        if self.file is None:
            self.name, self.bytes, self.records = f"{uuid.uuid4().hex}.warc.zst", 0, 0
            self.file = self.store.open_output_stream(f"{self.path}/{self.name}", compression=None)
            if self.dictionary:
                self._write(_DICTIONARY.to_bytes(4, "little") + len(self.dictionary).to_bytes(4, "little") + self.dictionary)
            self._write(self.zstd.compress(_record(
                [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", _DATE),
                 ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")))
        self._write(self.zstd.compress(record))
        self.records += 1
        if self.bytes >= self.most:
            self.close()

    def _write(self, data: bytes) -> None:
        self.file.write(data)
        self.bytes += len(data)

    def close(self) -> None:
        if self.file is not None:
            self.file.close()
            self.done.append((f"{self.folder}/{self.name}", self.records, self.bytes))
            self.file = None


def _with_response(pages: DataFrame, least: int, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, html, digest, size, refers_to) per row; html is null for revisits.

    Digests alone are compared. Which rows are revisits is sent to the scan as one bit per row, and
    a revisit record needs no payload, so no html ever leaves its task."""
    pages, file, row = with_place(pages)
    page_id, html = pages[id_col].cast("bigint"), F.coalesce(pages[html_col], F.lit(""))
    digests = materialise(pages.select(page_id.alias("page_id"), pages[url_col].alias("url"), F.sha1(html).alias("digest"),
                                       F.octet_length(html).cast("bigint").alias("size"), file.alias("file"), row.alias("row"))
                          .filter(F.col("size") >= least), "digests")
    sizes = materialise(digests.groupBy("digest").agg(F.max("page_id").alias("best"), F.count(F.lit(1)).alias("n"))
                        .filter("n > 1"), "payloads")
    copies = attach_group(digests, sizes, "digest", "n", sizes.agg(F.sum("n")).first()[0] or 0)
    revisits = materialise(copies.filter(~F.col("page_id").eqNullSafe(F.col("best"))), "revisits")
    kept = drop_marked(pages, revisits.select("file", "row"))
    html = F.coalesce(kept[html_col], F.lit(""))
    responses = kept.select(kept[id_col].cast("bigint").alias("page_id"), kept[url_col].alias("url"), html.alias("html"),
                            F.sha1(html).alias("digest"), F.octet_length(html).cast("bigint").alias("size"),
                            F.lit(None).cast("bigint").alias("refers_to"))
    return responses.unionByName(revisits.select("page_id", "url", F.lit(None).cast("string").alias("html"), "digest", "size",
                                                 F.col("best").alias("refers_to")))


def qualified(spark: SparkSession, folder: str) -> str:
    """``folder`` as the tasks' file systems name it: without a scheme it is in Hadoop's default
    store, as for Spark, and not on an executor's own disk."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    full = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    full = re.sub("^file:/+", "file:///", full)
    return re.sub("^s3[an]://", "s3://", full)


def write_archives(pages: DataFrame, folder: str, dictionary: bytes | None = None, id_col: str = "page_id",
                   url_col: str = "url", html_col: str = "html", archive_bytes: int = ARCHIVE_BYTES,
                   least_revisit: int = LEAST_REVISIT) -> DataFrame:
    """Write every row as a record into archives under ``folder``; returns the stored list
    (path, records, bytes) of complete archives. ``id_col`` must be an integer column."""
    folder = qualified(pages.sparkSession, folder)
    if dictionary is None:
        dictionary = train_dictionary(pages.select(pages[id_col].cast("bigint").alias("page_id"), pages[url_col].alias("url"),
                                                   pages[html_col].alias("html")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = _Writer(folder, dictionary, archive_bytes)
        for b in batches:
            for page_id, url, html, digest, size, refers_to in zip(*b.columns):
                payload = None if html.as_py() is None else html.as_py().encode()
                writer.add(page_record(page_id.as_py(), url.as_py(), payload, digest.as_py(), refers_to.as_py(), size.as_py()))
        writer.close()
        if writer.done:
            paths, records, sizes = zip(*writer.done)
            yield pa.RecordBatch.from_arrays([pa.array(paths), pa.array(records, pa.int64()), pa.array(sizes, pa.int64())],
                                             names=["path", "records", "bytes"])

    records = _with_response(pages, least_revisit, id_col, url_col, html_col)
    return materialise(records.mapInArrow(run, "path string, records bigint, bytes bigint"), "archives")


# ---- reading -------------------------------------------------------------------------

class Damaged(ValueError):
    pass


def _exactly(file, n: int) -> bytes:
    data = file.read(n)
    if len(data) < n:
        raise Damaged("the archive ends inside a frame")
    return data


def frames(file) -> Iterator[tuple[int, bytes]]:
    """(kind, bytes) of each frame of a stream: kind is the dictionary magic for a leading
    dictionary (bytes: its content) or the frame magic (bytes: the whole frame). Frame ends
    come from the block headers; other skippable frames are passed over."""
    first = True
    while True:
        magic = file.read(4)
        if not magic:
            return
        if len(magic) < 4:
            raise Damaged("the archive ends inside a frame")
        number = int.from_bytes(magic, "little")
        if number & 0xFFFFFFF0 == _SKIPPABLE:
            content = _exactly(file, int.from_bytes(_exactly(file, 4), "little"))
            if number == _DICTIONARY and first:
                yield _DICTIONARY, content
            first = False
            continue
        first = False
        if number != _FRAME:
            raise Damaged(f"no frame begins with {magic.hex()}")
        parts = [magic, _exactly(file, 1)]
        flags = parts[1][0]
        single = flags >> 5 & 1
        size = (1 - single) + (0, 1, 2, 4)[flags & 3] + ((1 if single else 0), 2, 4, 8)[flags >> 6]
        parts.append(_exactly(file, size))
        last = 0
        while not last:
            parts.append(_exactly(file, 3))
            head = int.from_bytes(parts[-1], "little")
            last, kind = head & 1, head >> 1 & 3
            if kind == 3:
                raise Damaged("a block of reserved type")
            parts.append(_exactly(file, 1 if kind == 1 else head >> 3))
        if flags >> 2 & 1:
            parts.append(_exactly(file, 4))
        yield _FRAME, b"".join(parts)


def _dictionary(content: bytes) -> zstandard.ZstdCompressionDict:
    """The dictionary of a skippable frame, which may itself be compressed."""
    if content[:4] == _FRAME.to_bytes(4, "little"):
        content = zstandard.ZstdDecompressor().decompressobj().decompress(content)
    return zstandard.ZstdCompressionDict(content)


def _headers(lines: list[bytes]) -> dict[str, str]:
    out = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        if not colon or not _NAME.fullmatch(name):
            raise Damaged(f"not a header: {line[:60]!r}")
        out[name.strip().lower().decode("utf-8", "replace")] = value.strip().decode("utf-8", "replace")
    return out


def _length(headers: dict[str, str]) -> int:
    text = headers.get("content-length", "")
    if not text.isascii() or not text.isdigit():
        raise Damaged(f"Content-Length is {text[:30]!r}")
    return int(text)


def parse_record(data: bytes) -> dict:
    """Fields of one record; raises ``Damaged`` where its headers, lengths or digest are wrong."""
    head, end, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not end or lines[0] not in _VERSIONS:
        raise Damaged("no WARC version line or header end")
    headers = _headers(lines[1:])
    if missing := [h for h in _REQUIRED if not headers.get(h)]:
        raise Damaged(f"missing {missing[0]}")
    n = _length(headers)
    if len(rest) != n + 4 or rest[n:] != b"\r\n\r\n":
        raise Damaged(f"the block has {max(0, len(rest) - 4)} bytes, Content-Length says {n}")
    kind, block = headers["warc-type"], rest[:n]
    out = {"record_type": kind, "record_id": headers["warc-record-id"], "target_uri": headers.get("warc-target-uri"),
           "refers_to_id": headers.get("warc-refers-to"), "payload": None, "payload_bytes": None, "payload_digest": None}
    if kind not in ("response", "revisit"):
        return out
    if "warc-target-uri" not in headers:
        raise Damaged("missing warc-target-uri")
    top, end, payload = block.partition(b"\r\n\r\n")
    if not end or not top.startswith(b"HTTP/"):
        raise Damaged("the block is no HTTP response")
    size = _length(_headers(top.split(b"\r\n")[1:]))
    algorithm, _, digest = headers.get("warc-payload-digest", "").partition(":")
    if algorithm.lower() != "sha1" or not re.fullmatch("[0-9a-f]{40}", digest):
        raise Damaged("no SHA-1 payload digest")
    if kind == "response":
        if len(payload) != size:
            raise Damaged(f"the payload has {len(payload)} bytes, its Content-Length says {size}")
        if hashlib.sha1(payload).hexdigest() != digest:
            raise Damaged("the payload does not match its digest")
        out["payload"] = payload
    elif payload or not out["refers_to_id"]:
        raise Damaged("a revisit holds a payload or names no record")
    return out | {"payload_bytes": size, "payload_digest": digest}


def read_archive(file) -> Iterator[dict]:
    """The records of an open archive, each with ``error`` (None if sound). A damaged record
    does not stop the rest; a damaged frame boundary is reported and ends the archive."""
    zstd, n = zstandard.ZstdDecompressor(), 0
    try:
        for kind, data in frames(file):
            if kind == _DICTIONARY:
                zstd = zstandard.ZstdDecompressor(dict_data=_dictionary(data))
                continue
            try:
                yield parse_record(zstd.decompressobj().decompress(data)) | {"frame": n, "error": None}
            except (Damaged, zstandard.ZstdError) as e:
                yield {"frame": n, "error": str(e)}
            n += 1
    except (Damaged, zstandard.ZstdError) as e:
        yield {"frame": n, "error": str(e)}


_SCHEMA = pa.schema([("archive", pa.string()), ("frame", pa.int64()), ("record_type", pa.string()), ("record_id", pa.string()),
                     ("target_uri", pa.string()), ("refers_to_id", pa.string()), ("payload", pa.binary()),
                     ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("error", pa.string())])


def read_archives(paths: DataFrame, with_payload: bool = True) -> DataFrame:
    """All records of the archives in ``paths`` (path), in any order, sound or not.

    ``with_payload=False`` leaves the payload null after checking it."""
    n = paths.sparkSession.sparkContext.defaultParallelism
    dealt = paths.select("path").repartition(max(n, min(paths.count(), 64 * n)), "path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column(0).to_pylist():
                store, at = fs.FileSystem.from_uri(path)
                rows, size = [], 0
                with store.open_input_stream(at, compression=None, buffer_size=1 << 20) as file:
                    for r in read_archive(file):
                        rows.append(r | {"archive": path} | ({} if with_payload else {"payload": None}))
                        size += 200 + len(rows[-1].get("payload") or b"")
                        if size > 8 << 20:
                            yield pa.RecordBatch.from_pylist(rows, _SCHEMA)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, _SCHEMA)

    return dealt.mapInArrow(run, "archive string, frame bigint, record_type string, record_id string, target_uri string, "
                                 "refers_to_id string, payload binary, payload_bytes bigint, payload_digest string, error string")


def archive_round_trip(spark: SparkSession, pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write ``pages`` to archives and read them back: one row per page with page_id,
    payload_bytes, payload_digest, record_type, refers_to, error.

    Null html is an empty payload. Rows that share the largest page_id of their payload are
    all responses; of equal small payloads every page is one. Very long payloads are single records,
    read as streams. A null id is a response unless another page has its payload. Line
    breaks and spaces in a URL are percent-encoded. Empty table: no archive, empty
    result. Other columns are not read."""
    archives = write_archives(pages, folder or scratch_path(spark, "warc"))
    records = read_archives(archives, with_payload=False).filter("record_type IS NULL OR record_type <> 'warcinfo'")
    page = lambda c: F.regexp_extract(c, "^<urn:x-page:(-?[0-9]+)>$", 1).try_cast("bigint")
    return records.select(page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                          page("refers_to_id").alias("refers_to"), "error")

"""Registered queries of this subpackage: each operator over its whole table.

``ORACLES`` has DuckDB SQL for those that SQL can express; the others are tested
against brute force in ``tests/llm``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tessera.llm import (exact_dedup, html_text, language_id, mixing, packing, pii, quality, sharding, simhash, toxicity,
                         variants, warc, whitening)
from tessera.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return register


@query("op1_sharding")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), [1.0] * 8)


@query("op6_exact_dedup", r"""
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))
           AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept,
       text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicate_report(table(spark, sf_dir, "documents"))


@query("op9_mixing", r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w
  FROM d GROUP BY source),
lam AS (
  SELECT 0 AS step, sum(source_size)::DOUBLE / sum(w) AS share FROM s
  UNION ALL
  SELECT l.step + 1,
         (SELECT (SELECT sum(source_size) FROM s) - coalesce(sum(3.0 * source_size) FILTER (w * l.share > 3.0 * source_size), 0) FROM s)::DOUBLE
         / (SELECT sum(w) FILTER (w * l.share <= 3.0 * source_size) FROM s)
  FROM lam l WHERE l.step < 64),
t AS (
  SELECT source, source_size, least(3.0 * source_size::DOUBLE, w * (SELECT share FROM lam WHERE step = 64)) AS target FROM s),
r AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM t)
SELECT d.doc_id, d.size, r.source_size, r.target,
       (d.size * (floor(r.rate)::BIGINT + (('0x' || substr(md5('0:' || d.doc_id::VARCHAR), 1, 13))::BIGINT
         / 4503599627370496.0 < r.rate - floor(r.rate))::BIGINT))::BIGINT AS taken,
       (floor(r.rate)::BIGINT + (('0x' || substr(md5('0:' || d.doc_id::VARCHAR), 1, 13))::BIGINT
         / 4503599627370496.0 < r.rate - floor(r.rate))::BIGINT) AS copies,
       r.rate
FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source
""")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


@query("op2_simhash")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicate_report(table(spark, sf_dir, "documents"))


@query("op7_packing")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op4_quality_rules")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op8_toxicity")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op3_pii")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(table(spark, sf_dir, "documents"))


@query("op5_html_text")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_pages(table(spark, sf_dir, "pages"))


@query("op10_warc")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(spark, table(spark, sf_dir, "pages"))


@query("op11_language_id")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify_languages(table(spark, sf_dir, "documents"))


@query("op12_whitening")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten_vectors(table(spark, sf_dir, "embeddings"))


@query("op13_variants", r"""
WITH RECURSIVE t AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
              ORDER BY i) AS crc FROM range(256) r(i)),
r AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[A-Za-z\x{C0}-\x{FF}]{5,}')) AS run
  FROM documents),
k AS (SELECT run, doc_id, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS x, count(*) AS c FROM r GROUP BY doc_id, run),
h AS (
  SELECT run, c, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(len(x) // 2),
                                   lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT)),
                                 lambda a, b: xor(a >> 8, crc[(xor(a, b) & 255) + 1])), 4294967295) AS h
  FROM k, t),
o AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2)
              ELSE run END AS word, c FROM h),
w AS (SELECT word, sum(c)::BIGINT AS n FROM o WHERE length(word) >= 5 GROUP BY word HAVING sum(c) >= 3),
p AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
      FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w)),
e AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM p a JOIN p b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT p.word, w.word, w.n FROM p JOIN w ON p.rest = w.word
  UNION SELECT w.word, p.word, p.n FROM p JOIN w ON p.rest = w.word),
b AS (SELECT word, count(*) AS n_near, max(other_n) AS top FROM e GROUP BY word),
f AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0)::BIGINT AS n_near, CASE WHEN b.top >= 2 * w.n THEN b.top END AS form_n,
         CASE WHEN b.top >= 2 * w.n THEN (SELECT min(e.other) FROM e WHERE e.word = w.word AND e.other_n = b.top) END AS form
  FROM w LEFT JOIN b ON w.word = b.word),
c AS (
  SELECT word, word AS root, form AS next FROM f
  UNION ALL SELECT c.word, f.word, f.form FROM c JOIN f ON c.next = f.word)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n FROM f JOIN c ON c.word = f.word AND c.next IS NULL
""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.group_variants(table(spark, sf_dir, "documents"))

"""One query per operator over the whole of its driver table, and SQL where it can say the same."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from phraseloom.llm import exact_dedup, jaccard_join, kd_search, license_scan, mixing, piece_fst, quality, resampling, substring_dedup, token_alignment, token_files, toxicity, web_archive
from phraseloom.llm.scratch import shared_folder


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_files(spark: SparkSession, sf: str) -> DataFrame:
    path = f"{shared_folder(spark)}/token_files-{uuid.uuid4().hex}"
    token_files.write_token_files(table(spark, sf, "documents"), path, tokenizer_path("word_bpe_49k.json"), end_id=1)
    return token_files.with_crc32(token_files.read_token_files(spark, path))


def op2_piece_fst(spark: SparkSession, sf: str) -> DataFrame:
    return piece_fst.encode_pieces(table(spark, sf, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op3_quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality.quality_table(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op6_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(table(spark, sf, "documents"))


def op7_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf, "documents"))


def op8_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.toxicity_table(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op9_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return license_scan.license_scan(table(spark, sf, "documents"))


def op4_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return substring_dedup.substring_dedup(table(spark, sf, "documents"))


def op5_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    index = exact_dedup.DigestIndex(spark, f"digests_{uuid.uuid4().hex}")
    return exact_dedup.exact_dedup(table(spark, sf, "documents"), index)


def op10_kd_search(spark: SparkSession, sf: str) -> DataFrame:
    return kd_search.nearest(table(spark, sf, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op11_web_archive(spark: SparkSession, sf: str) -> DataFrame:
    path = f"{shared_folder(spark)}/web_archive-{uuid.uuid4().hex}"
    web_archive.archive_pages(table(spark, sf, "pages"), path)
    return web_archive.archived_pages(spark, path)


def op12_resampling(spark: SparkSession, sf: str) -> DataFrame:
    return resampling.resample(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op13_token_alignment(spark: SparkSession, sf: str) -> DataFrame:
    return token_alignment.align(table(spark, sf, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))[0]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


OP4_SQL = r"""
WITH lists AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS k FROM lists),
windows AS (
  SELECT doc_id, k, count(*) OVER f AS n, string_agg(word, ' ') OVER f AS twenty FROM words
  WINDOW f AS (PARTITION BY doc_id ORDER BY k ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)
),
again AS (SELECT doc_id, k FROM (SELECT doc_id, k, row_number() OVER (PARTITION BY twenty ORDER BY doc_id, k) AS place FROM windows WHERE n = 20) WHERE place > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(k, k + 20)) AS k FROM again),
kept AS (
  SELECT words.doc_id, count(gone.k) AS n_removed, string_agg(word, ' ' ORDER BY words.k) FILTER (gone.k IS NULL) AS text
  FROM words LEFT JOIN gone ON gone.doc_id = words.doc_id AND gone.k = words.k GROUP BY words.doc_id
)
SELECT lists.doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM lists LEFT JOIN kept USING (doc_id)
"""

OP7_SQL = r"""
WITH RECURSIVE lists AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS k, len(w) AS n_words FROM lists),
runs AS (
  SELECT doc_id, k, n_words, count(*) OVER f AS n, string_agg(word, ' ') OVER f AS five FROM words
  WINDOW f AS (PARTITION BY doc_id ORDER BY k ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING)
),
sets AS (SELECT DISTINCT doc_id, five FROM runs WHERE n = 5 OR (n_words < 5 AND k = 1)),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
both_ways AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM sets a JOIN sets b ON a.five = b.five AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM both_ways JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * both_ways.n >= 75 * (x.n + y.n - both_ways.n)
),
reach AS (SELECT doc_id AS a, doc_id AS b FROM lists UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b)
SELECT lists.doc_id, coalesce(any_value(sizes.n), 0) AS n_shingles, min(reach.b) AS component_id
FROM lists JOIN reach ON reach.a = lists.doc_id LEFT JOIN sizes ON sizes.doc_id = lists.doc_id GROUP BY lists.doc_id
"""

OP5_SQL = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""


OP11_SQL = r"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (
  SELECT page_id, octet_length(payload) AS payload_bytes, sha256(payload) AS payload_digest,
         min(page_id) OVER (PARTITION BY sha256(payload)) AS first_id
  FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM d
"""

# A word's crc32 is taken byte by byte with the usual table, once per distinct word.
OP12_SQL = r"""
WITH crc_table AS (
  SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, b::BIGINT)) AS t
),
both_sides AS (
  SELECT doc_id, text, false AS target, row_number() OVER () AS row FROM documents
  UNION ALL SELECT NULL, text, true, -row_number() OVER () FROM benchmark
),
word_rows AS (
  SELECT row, target, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
  FROM both_sides
),
counted AS (SELECT row, target, word, count(*) AS n FROM word_rows GROUP BY ALL),
words AS (
  SELECT word, xor(4294967295, list_reduce(
           list_transform(range(1, 2 * octet_length(encode(word)) + 1, 2), lambda i: ('0x' || substr(hex(encode(word)), i, 2))::BIGINT),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295::BIGINT)) % 10000 AS bucket
  FROM (SELECT DISTINCT word FROM counted), crc_table
),
by_bucket AS (
  SELECT b.bucket, coalesce(sum(n) FILTER (NOT target), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (target), 0)::DOUBLE AS t
  FROM range(10000) b(bucket) LEFT JOIN (counted JOIN words USING (word)) USING (bucket) GROUP BY ALL
),
gain AS (
  SELECT bucket, floor(1000.0::DOUBLE * ln((t + 1) * (sum(s) OVER () + 10000) / ((s + 1) * (sum(t) OVER () + 10000))))::BIGINT AS gain FROM by_bucket
),
weighed AS (
  SELECT row, sum(n)::BIGINT AS n_features, floor(sum(n * gain)::DOUBLE / sum(n))::BIGINT AS weight
  FROM counted JOIN words USING (word) JOIN gain USING (bucket) WHERE NOT target GROUP BY row
),
scored AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000.0::DOUBLE * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296.0::DOUBLE)))::BIGINT AS score
  FROM both_sides LEFT JOIN weighed USING (row) WHERE NOT target
),
ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n
  FROM scored WHERE n_features >= 20 AND doc_id IS NOT NULL
)
SELECT s.doc_id, n_features, weight, score, CASE WHEN rank <= 10 * n // 100 THEN rank END AS rank
FROM scored s LEFT JOIN ranked r ON s.doc_id = r.doc_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op4_substring_dedup": OP4_SQL, "op5_exact_dedup": OP5_SQL, "op7_jaccard_join": OP7_SQL, "op11_web_archive": OP11_SQL, "op12_resampling": OP12_SQL}

"""The subpackage's queries by name, and SQL for those that it can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontamination, language, language_model, near_duplicates, packing, substrings, token_files, top_k, url_filter, warc


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return top_k.search(vectors, F.col("vec_id") % 100 == 0)


OP1_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 100 = 0
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(spark.read.parquet(f"{sf_dir}/pages.parquet")).select("page_id", "host", "path", "rule", "verdict", "score")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_digest(packing.pack(_documents(spark, sf_dir)))


def op4_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.held_out_scores(_documents(spark, sf_dir))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    found = language.identify(docs.select("doc_id", "text"), language.fitted(docs))
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.leaks(_documents(spark, sf_dir), items).drop("rid")


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicate_classes(_documents(spark, sf_dir)).select("doc_id", "class_id", "links", "copies")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.archive_round_trip(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substrings.without_repeats(_documents(spark, sf_dir), joined=True)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(_documents(spark, sf_dir)).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


OP8_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
h AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS h, min(page_id) OVER (PARTITION BY html) AS first FROM p),
b AS (
  SELECT *, array_to_string(list_transform(range(1, 41), lambda i: substr('0000000100100011010001010110011110001001101010111100110111101111',
    CAST(4 * (strpos('0123456789abcdef', substr(h, CAST(i AS INTEGER), 1)) - 1) + 1 AS INTEGER), 4)), '') AS bits FROM h
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + 16 * CAST(substr(bits, CAST(5 * j + 1 AS INTEGER), 1) AS INTEGER)
    + 8 * CAST(substr(bits, CAST(5 * j + 2 AS INTEGER), 1) AS INTEGER) + 4 * CAST(substr(bits, CAST(5 * j + 3 AS INTEGER), 1) AS INTEGER)
    + 2 * CAST(substr(bits, CAST(5 * j + 4 AS INTEGER), 1) AS INTEGER) + CAST(substr(bits, CAST(5 * j + 5 AS INTEGER), 1) AS INTEGER), 1)), '') AS payload_digest,
  CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN first <> page_id THEN first END AS refers_to
FROM b
"""

OP9_SQL = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
w AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS s FROM d),
k AS (SELECT doc_id, s, row_number() OVER (PARTITION BY array_to_string(ws[s:s + 19], ' ') ORDER BY doc_id, s) AS n FROM w),
c AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS p FROM k WHERE n > 1),
e AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS p, unnest(ws) AS word FROM d),
r AS (
  SELECT e.doc_id, count(*) AS n_left, string_agg(e.word, ' ' ORDER BY e.p) AS kept FROM e LEFT JOIN c ON e.doc_id = c.doc_id AND e.p = c.p WHERE c.p IS NULL GROUP BY e.doc_id
)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, CAST(len(d.ws) - coalesce(r.n_left, 0) AS BIGINT) AS n_removed, sha256(coalesce(r.kept, '')) AS kept_sha256
FROM d LEFT JOIN r ON d.doc_id = r.doc_id
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_top_k": op1_top_k,
    "op2_url_filter": op2_url_filter,
    "op3_packing": op3_packing,
    "op4_language_model": op4_language_model,
    "op5_language": op5_language,
    "op6_decontamination": op6_decontamination,
    "op7_near_duplicates": op7_near_duplicates,
    "op8_warc": op8_warc,
    "op9_substrings": op9_substrings,
    "op10_token_files": op10_token_files,
}
ORACLES: dict[str, str] = {"op1_top_k": OP1_SQL, "op8_warc": OP8_SQL, "op9_substrings": OP9_SQL}

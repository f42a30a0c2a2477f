"""One query per operator over its whole table, with SQL where SQL can say it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallyhouse.llm import (
    hard_negatives,
    html_text,
    language_id,
    line_dedup,
    minhash,
    mixing,
    pii,
    piece_fst,
    quality_rules,
    secrets,
    spelling,
    token_files,
    top_k,
)
from tallyhouse.session import shared_dir

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql:
            ORACLES[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op1_sentencepiece_fst(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_fst.encode_check(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query(r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         ('0x' || substr(md5('17:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8))::BIGINT AS draw
  FROM documents
), totals AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, count(*) AS source_docs FROM sized GROUP BY source
), ranked AS (
  SELECT *, [5.0::DOUBLE, 2.0, 1.0][1 + CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INT)] AS weight,
         2.0::DOUBLE * source_size AS cap FROM totals
), sums AS (
  SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS filled,
         sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST
                           ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS spare,
         1.5::DOUBLE * sum(source_size) OVER () AS total FROM ranked
), level AS (
  SELECT filled, spare FROM sums WHERE weight * (total - filled) < cap * spare
  ORDER BY cap / weight, source NULLS LAST LIMIT 1
), targets AS (
  SELECT s.*, CASE WHEN l.filled IS NULL OR s.filled < l.filled OR s.cap / s.weight = 0 THEN s.cap
                   ELSE least(s.weight * (s.total - l.filled) / l.spare, s.cap) END AS target
  FROM sums s LEFT JOIN level l ON true
), parts AS (
  SELECT source, source_size, source_docs, target,
         CASE WHEN source_size = 0 THEN 0 ELSE CAST(floor(target / source_size) AS BIGINT) END AS whole FROM targets
), marked AS (
  SELECT doc_id, size, draw, p.*, target - whole * source_size AS part,
         size * source_docs > 2 * source_size AS long
  FROM sized s JOIN parts p ON s.source IS NOT DISTINCT FROM p.source
), drawn AS (
  SELECT *, draw * source_size < part * 4294967296.0::DOUBLE AS drawn FROM marked
), reached AS (
  SELECT *, part - sum(CASE WHEN long AND drawn THEN size ELSE 0 END) OVER (PARTITION BY source) AS missing,
         sum(CASE WHEN long THEN 0 ELSE size END) OVER (PARTITION BY source ORDER BY draw, doc_id, size
                                                        ROWS UNBOUNDED PRECEDING) AS until
  FROM drawn
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, source,
       CAST(whole + CASE WHEN long THEN drawn WHEN size > 0 THEN until - size / 2 < missing ELSE false END::INT
            AS BIGINT) AS repetitions,
       CAST(size * (whole + CASE WHEN long THEN drawn WHEN size > 0 THEN until - size / 2 < missing
                            ELSE false END::INT) AS BIGINT) AS taken
FROM reached
""")
def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


@query()
def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/tallyhouse/{spark.sparkContext.applicationId}/tokens-{uuid.uuid4().hex}"
    token_files.write_token_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.read_token_files(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")


@query()
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality(table(spark, sf_dir, "documents"))


@query("""
WITH good AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vector FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, r.vec_id, CAST(list_dot_product(q.vector, r.vector) AS BIGINT) AS score
  FROM good q JOIN good r ON q.vec_id % 50 = 0 AND q.vec_id <> r.vec_id
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score
FROM scored QUALIFY rank <= 5
""")
def op5_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k.top_k(table(spark, sf_dir, "embeddings"))


@query()
def op6_html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extracted(table(spark, sf_dir, "pages"))


@query()
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


@query()
def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=4)


@query()
def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


@query()
def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secrets(table(spark, sf_dir, "documents"))


@query("""
WITH good AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vector
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND label IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
         CAST(list_dot_product(a.vector, r.vector) AS BIGINT) AS score
  FROM good a JOIN good r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INT) AS rank
FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT same
 AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
""")
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"), label=hard_negatives.shifted_label())


@query("""
WITH cut AS (
  SELECT row_number() OVER () AS row, doc_id, md5(text) AS digest, string_split(coalesce(text, ''), chr(10)) AS lines
  FROM documents
), lined AS (
  SELECT row, doc_id, digest, unnest(range(len(lines))) AS place, unnest(lines) AS line FROM cut
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lined
), shared AS (
  SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT (doc_id, digest)) >= 10
), marked AS (
  SELECT k.*, s.key IS NOT NULL AS dropped FROM keyed k LEFT JOIN shared s ON k.key = s.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY row, doc_id
""")
def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_digests(table(spark, sf_dir, "documents"))


@query()
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))

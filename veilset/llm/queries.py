"""One query per operator, over its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import (
    alignment,
    fim,
    licenses,
    mixing,
    pieces,
    pii,
    quality,
    simhash,
    templates,
    tokenfile,
    topk,
    toxicity,
    warc,
)
from .common import table
from .registry import ORACLE, QUERIES, query  # noqa: F401


@query("op3_quality_bands")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(table(spark, sf_dir, "documents"))


@query("op7_simhash_bktree")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.cluster(table(spark, sf_dir, "documents"))


@query("op4_token_pfor")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfile.round_trip(table(spark, sf_dir, "documents"),
                                public_tokenizers.path("word_bpe_49k.json"))


@query("op6_block_topk", sql="""
    WITH v AS (
      SELECT vec_id, embedding,
             list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS z
      FROM embeddings
      WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    q AS (SELECT vec_id AS query_id, min_by(z, embedding) AS y
          FROM v WHERE vec_id % 20 = 0 GROUP BY vec_id),
    s AS (SELECT query_id, vec_id,
                 CAST(list_sum(list_transform(list_zip(y, z),
                      lambda p: coalesce(p[1], 0) * coalesce(p[2], 0))) AS BIGINT) AS score
          FROM q JOIN v ON vec_id <> query_id),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n
          FROM s)
    SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 20""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where("vec_id % 20 = 0"))


@query("op8_pii_disclosure")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


@query("op2_toxicity_ftrl")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


@query("op1_html_templates")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.main_text(table(spark, sf_dir, "pages"))


@query("op9_piece_dropout")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip(table(spark, sf_dir, "documents"),
                             public_tokenizers.path("piece_bpe_32k.model"))


@query("op5_temperature_mixing")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


@query("op10_license_compression")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


@query("op11_fim_rank_index", sql="""
    WITH d AS (
      SELECT doc_id, coalesce(text, '') AS t,
             regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
             sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
      FROM documents),
    r AS (
      SELECT doc_id, t, u, CAST(len(u) AS BIGINT) AS n,
             CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(u) + 1) AS x,
             CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(u) + 1) AS y,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                       OR CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 >= 90 THEN 'plain'
                  WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 20 THEN 'spm'
                  ELSE 'psm' END AS form
      FROM d),
    c AS (
      SELECT doc_id, t, n, form,
             coalesce(array_to_string(u[1:least(x, y)], ''), '') AS pre,
             coalesce(array_to_string(u[least(x, y) + 1:greatest(x, y)], ''), '') AS mid,
             coalesce(array_to_string(u[greatest(x, y) + 1:], ''), '') AS suf
      FROM r)
    SELECT doc_id, n, form,
           CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
           sha256(CASE form WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                            WHEN 'spm' THEN '<S>' || suf || '<P>' || pre || '<M>' || mid
                            ELSE t END) AS output_sha256,
           sha256(t) AS restored_sha256
    FROM c""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digests(table(spark, sf_dir, "documents"))


@query("op13_token_alignment")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"),
                           public_tokenizers.path("byte_bpe_50k.json"),
                           public_tokenizers.path("piece_bpe_32k.model"))


@query("op12_warc_chunks", sql="""
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes,
           sha256(coalesce(html, '')) AS payload_digest,
           CASE WHEN strlen(html) >= 100 AND row_number() OVER w > 1
                THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN strlen(html) >= 100 AND row_number() OVER w > 1
                THEN first_value(page_id) OVER w END AS refers_to
    FROM pages
    WINDOW w AS (PARTITION BY html ORDER BY page_id NULLS LAST)""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))

"""The operators as registered queries over whole tables, and DuckDB SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareseg.llm import align, bpe, html_blocks, jaccard, licenses, near_embed, negatives, packing, quality, secret_scan, shards, topk, toxicity
from fareseg.llm.common import table


def op1_near_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_embed.near_duplicates(table(spark, sf_dir, "embeddings"))


def op2_top_inner_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_inner_products(table(spark, sf_dir, "embeddings"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_digests(table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_blocks.main_text(table(spark, sf_dir, "pages"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_digests(table(spark, sf_dir, "documents"))


def op9_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard_digests(table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.piece_digests(table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(emb.withColumn("label", moved))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.alignment_digests(table(spark, sf_dir, "documents"))


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_digests(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_near_embeddings, op2_top_inner_products, op3_toxicity, op4_ngram_jaccard, op5_secret_scan, op6_quality,
    op7_main_text, op8_byte_bpe, op9_shards, op10_packing, op11_hard_negatives,
    op12_token_alignment, op13_license_scan)}

ORACLE = {
    "op1_near_embeddings": """
WITH RECURSIVE u AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
),
n AS MATERIALIZED (SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS r FROM u),
l AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM n a JOIN n b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_dot_product(a.e, b.e) / (a.r * b.r) >= 0.93
),
c(v, r) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT l.b, c.r FROM c JOIN l ON l.a = c.v)
SELECT e.vec_id, coalesce(k.n, 0) AS n_links, m.r AS component_id, e.vec_id = m.r AS kept
FROM embeddings e JOIN (SELECT v, min(r) AS r FROM c GROUP BY v) m ON m.v = e.vec_id
LEFT JOIN (SELECT a, count(*) AS n FROM l GROUP BY a) k ON k.a = e.vec_id
""",
    "op2_top_inner_products": """
WITH v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5
""",
    "op4_ngram_jaccard": r"""
WITH RECURSIVE w AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws
  FROM documents
),
g AS MATERIALIZED (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) AS s
    FROM w WHERE len(ws) >= 5
    UNION ALL SELECT doc_id, array_to_string(ws, ' ') FROM w WHERE len(ws) BETWEEN 1 AND 4)
),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
o AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM g a JOIN g b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2
),
l AS MATERIALIZED (
  SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 80 * (x.n + y.n - i)
),
c(v, r) AS (SELECT doc_id, doc_id FROM documents UNION SELECT l.b, c.r FROM c JOIN l ON l.a = c.v)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.r AS component_id
FROM documents d JOIN (SELECT v, min(r) AS r FROM c GROUP BY v) m ON m.v = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
""",
    "op11_hard_negatives": """
WITH v AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
),
s AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_dot_product(a.e, c.e)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0
),
p AS MATERIALIZED (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
),
n AS (
  SELECT anchor_id, positive_id, positive_score, s.vec_id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM p JOIN s USING (anchor_id)
  WHERE NOT same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
""",
}

"""The operators as queries over whole tables, and their check in SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronomart.llm import (
    alignment, bpe, embedding_dedup, exact_dedup, html_extract, jaccard_join, maxent_lm, merkle, mixing, packing, quality, token_files, url_filter,
)
from chronomart.llm.common import ascii_lower, table


def op1_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.embedding_dedup(table(spark, sf_dir, "embeddings"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", *[F.col(f"{mixing.ID}.{c}").alias(c) for c in ("size", "source_size", "target", "taken")])


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(table(spark, sf_dir, "documents"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_join(table(spark, sf_dir, "documents"))


def op10_maxent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent_lm.score(table(spark, sf_dir, "documents"))


def lower_cased_texts(columns: dict[str, Column]) -> Column:
    """The leaf with the text's A-Z lower-cased where 5 divides the crc32 of the id; null elsewhere."""
    text = columns["text"]
    changed = merkle.leaf_hash(list({**columns, "text": F.when(text.isNotNull(), ascii_lower(text))}.values()))
    return F.when(F.crc32(columns["doc_id"].cast("string").cast("binary")) % 5 == 0, changed)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = merkle.verified(table(spark, sf_dir, "documents"), lower_cased_texts)
    return found.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", F.col("proof").alias("proof_sha256"), "folded_root", "verified")


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents")).drop("ids")


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"))


OP4_SQL = """
WITH n AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER g AS kept, sha256(norm) AS text_sha256
FROM n WINDOW g AS (PARTITION BY norm)
"""

OP11_SQL = """
WITH RECURSIVE given AS (
  SELECT doc_id, coalesce('1' || source, '0') AS tree, source, lang, n_chars, text,
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
    xor(4294967295::UBIGINT, list_reduce(
      list_transform(string_split(doc_id::VARCHAR, ''), lambda d: ascii(d)::UBIGINT),
      lambda c, d: list_reduce([0, 1, 2, 3, 4, 5, 6, 7]::UBIGINT[], lambda a, i: xor(a // 2, 3988292384::UBIGINT * (a % 2)), xor(c, d)),
      4294967295::UBIGINT)) AS crc
  FROM documents
), hashed AS (
  SELECT doc_id, tree, crc, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf, sha256(head || coalesce(strlen(low) || ':' || low, '-')) AS changed
  FROM (SELECT *, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
    || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head FROM given)
), leaves AS (
  SELECT doc_id, tree, leaf, CASE WHEN crc % 5 = 0 THEN changed ELSE leaf END AS claim,
    row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY tree) AS n
  FROM hashed
), low_nodes AS (
  SELECT tree, 0 AS level, idx, leaf AS hash, n FROM leaves
  UNION ALL
  SELECT tree, level + 1, idx // 16, sha256(string_agg(hash, '' ORDER BY idx)), (max(n) + 15) // 16
  FROM low_nodes WHERE n > 1 GROUP BY tree, level, idx // 16
), roots AS (
  SELECT tree, hash, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS n FROM low_nodes WHERE n = 1
), top_nodes AS (
  SELECT '' AS tree, 0 AS level, idx, hash, n FROM roots
  UNION ALL
  SELECT tree, level + 1, idx // 16, sha256(string_agg(hash, '' ORDER BY idx)), (max(n) + 15) // 16
  FROM top_nodes WHERE n > 1 GROUP BY tree, level, idx // 16
), runs AS (
  SELECT tree, level, idx // 16 AS run, max(n) AS n, list(hash ORDER BY idx) AS hashes
  FROM (SELECT * FROM low_nodes UNION ALL SELECT * FROM top_nodes) WHERE n > 1 GROUP BY tree, level, idx // 16
), climb AS (
  SELECT doc_id, tree AS own, idx AS place, tree, 0 AS level, idx, n, claim AS folded, '' AS proof FROM leaves
  UNION ALL
  SELECT c.doc_id, c.own, c.place, CASE WHEN c.n > 1 THEN c.tree ELSE '' END, CASE WHEN c.n > 1 THEN c.level + 1 ELSE 0 END,
    CASE WHEN c.n > 1 THEN c.idx // 16 ELSE t.idx END, CASE WHEN c.n > 1 THEN (c.n + 15) // 16 ELSE t.n END,
    CASE WHEN c.n > 1 THEN sha256(list_aggregate(list_concat(list_slice(r.hashes, 1, c.idx % 16), [c.folded], list_slice(r.hashes, c.idx % 16 + 2, 16)), 'string_agg', '')) ELSE c.folded END,
    CASE WHEN c.n > 1 THEN c.proof || coalesce(list_aggregate(list_concat(list_slice(r.hashes, 1, c.idx % 16), list_slice(r.hashes, c.idx % 16 + 2, 16)), 'string_agg', ''), '') ELSE c.proof END
  FROM climb c
  LEFT JOIN runs r ON c.n > 1 AND r.tree = c.tree AND r.level = c.level AND r.run = c.idx // 16
  LEFT JOIN roots t ON c.n = 1 AND t.tree = c.tree
  WHERE c.n > 1 OR c.tree <> ''
)
SELECT l.doc_id, l.leaf, s.hash AS subroot, t.hash AS root, sha256(c.proof) AS proof_sha256, c.folded AS folded_root, c.folded = t.hash AS verified
FROM climb c JOIN leaves l ON l.tree = c.own AND l.idx = c.place JOIN roots s ON s.tree = c.own JOIN top_nodes t ON t.n = 1
WHERE c.tree = '' AND c.n = 1
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_extract": op1_html_extract,
    "op2_embedding_dedup": op2_embedding_dedup,
    "op3_quality": op3_quality,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_url_filter": op5_url_filter,
    "op6_mixing": op6_mixing,
    "op7_token_files": op7_token_files,
    "op8_bpe": op8_bpe,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_maxent_lm": op10_maxent_lm,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_packing": op12_packing,
    "op13_alignment": op13_alignment,
}

SQL: dict[str, str] = {"op4_exact_dedup": OP4_SQL, "op11_merkle_manifest": OP11_SQL}

"""The registered queries of the operators and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.llm import (
    bpe, covertree, decontaminate, divergence, fingerprint, jaccard, langid, licences, linedup, pii, secrets, sharding, warc,
)
from rivulet.runtime import fresh_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_boosted_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.span_digests(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_multiset_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_edits(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_sparse_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", langid.held_out())
    model = langid.train(docs.where("NOT held_out"))
    return langid.predict(docs, model).select("doc_id", "held_out", "lang_pred", "score")


def op4_cgk_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = decontaminate.mark_leaks(docs, table(spark, sf_dir, "benchmark"))
    return marked.select("doc_id", F.inline("leaks"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard.near_duplicates(docs, width=4, percent=85)


def op6_dictionary_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), folder)
    return warc.read_archives(spark, folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.digests(docs, ranks, public_tokenizers.PATTERN)


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return linedup.dedup_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256")
    )


def op9_licence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan_licences(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_secret_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return secrets.secret_report(docs, path="source")


def op11_covertree_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.coded(table(spark, sf_dir, "embeddings"))


def op12_quadtree_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents").select("text", "lang", "source"))


def op13_interleaved_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assignments(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_boosted_pii, op2_multiset_fingerprint, op3_sparse_langid, op4_cgk_decontamination, op5_jaccard_join,
        op6_dictionary_warc, op7_byte_bpe, op8_line_dedup, op9_licence_rules, op10_secret_forest,
        op11_covertree_codes, op12_quadtree_divergence, op13_interleaved_shards,
    )
}

_SQL_LINES = """SELECT doc_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS lines
  FROM documents"""

ORACLES = {
    "op11_covertree_codes": covertree.sql(),
    "op12_quadtree_divergence": divergence.SQL,
    "op13_interleaved_shards": sharding.SQL,
    "op9_licence_rules": licences.sql(),
    "op8_line_dedup": f"""WITH docs AS ({_SQL_LINES}),
cells AS (
  SELECT doc_id, pos, lines[pos] AS line,
    translate(trim(lines[pos], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS pos FROM docs)),
first_of AS (
  SELECT key, min(doc_id) AS origin FROM cells WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) > 1),
judged AS (
  SELECT c.doc_id, c.pos, c.line, coalesce(f.origin <> c.doc_id, false) AS gone
  FROM cells c LEFT JOIN first_of f ON c.key = f.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id""",
}

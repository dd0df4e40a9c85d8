"""A training-data pipeline over ``documents``: each stage is written as Parquet and read by the next.

Language identification, line deduplication, near-duplicate removal, benchmark decontamination and
tokenising. Stages take a table with the columns of ``documents``; all but the last return these columns.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.llm import bpe, decontaminate, jaccard, langid, linedup
from rivulet.runtime import delete_folder, fresh_path

#: Documents whose language is less certain than this go.
LEAST_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or of no language that the model is sure of, go.

    The model learns from the labelled documents of the stage's own input. Without any label there
    is nothing to judge by, and only documents without a letter go.
    """
    model = langid.train(docs.where(~langid.held_out()))
    if not model.languages:
        return docs.where(F.coalesce(F.col("text"), F.lit("")).rlike(r"\p{L}"))
    judged = langid.predict(docs, model, language="_lang_pred", score="_score")
    kept = (F.col("_lang_pred") != langid.UNDETERMINED) & (F.col("_score") >= LEAST_SCORE)
    return judged.where(kept).select(docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines leave the texts, and documents of which only blanks are left go; ``n_chars`` follows."""
    slim = linedup.dedup_lines(docs).where((F.col("n_dropped") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return slim.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five words, 0.8) the document with the smallest id stays."""
    groups = jaccard.near_duplicates(docs.select("doc_id", "text"), width=5, percent=80)
    gone = groups.where(F.col("component_id") != F.col("doc_id")).select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage within the edit distance of a benchmark item go."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.mark_leaks(docs, items).where(F.size("leaks") == 0).select(docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of each text, their number, and whether they decode to the text."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.round_trip(docs, ranks, public_tokenizers.PATTERN)


STAGES = [
    ("language ID", language_id),
    ("line dedup", line_dedup),
    ("near duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("tokens", tokens),
]

#: Learned and tokenised stages have no SQL form; the tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stage is written and read back; what an earlier stage wrote is deleted once the next one has read it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES:
        path = fresh_path(spark, f"pipeline-{name.lower().replace(' ', '-')}")
        try:
            stage(spark, docs, sf_dir).write.parquet(path)
        finally:
            if before:
                delete_folder(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs

"""File scans and sinks over files written from the given tables, and the SQL of what they read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.plans import frames as fr
from rivulet.plans.frames import with_sql
from rivulet.runtime import fresh_path
from rivulet.sources import files, sinks


def _text(spark: SparkSession, rows: DataFrame, label: str) -> str:
    path = fresh_path(spark, label)
    rows.write.text(path)
    return path


def lines_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All document lines with how often each occurs."""
    path = _text(spark, fr.document_lines(spark, sf_dir), "lines")
    return files.text_lines(spark, path).groupBy("value").agg(F.count(F.lit(1)).alias("times"))


def id_list_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = fr.table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("value"))
    ids = files.id_list(spark, _text(spark, users, "ids"))
    return ids.groupBy("target_user").agg(F.count(F.lit(1)).alias("times"))


def vertex_words_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as lines ``doc_id words``, in the order of their ids over several files."""
    docs = fr.table(spark, sf_dir, "documents").repartitionByRange(5, "doc_id").sortWithinPartitions("doc_id")
    line = F.concat_ws(" ", F.col("doc_id"), F.regexp_replace("text", r"[ \t\n\x0B\f\r]+", " "))
    vertices = files.vertex_words(spark, _text(spark, docs.select(line.alias("value")), "vertices"))
    return vertices.select("id", F.size("words").cast("long").alias("n_words"), F.md5(F.array_join("words", " ")).alias("words_md5"))


def sparse_examples_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "examples")
    fr.binary_examples(spark, sf_dir).withColumn("value", F.col("value").cast("array<float>")).write.parquet(path)
    rows = files.sparse_examples(spark, path)
    total = F.aggregate(F.arrays_zip("index", "value"), F.lit(0.0), lambda s, e: s + e["index"] * e["value"])
    return rows.select("example_id", "label", F.size("index").cast("long").alias("n"), F.round(total, 4).alias("weighted"))


def stop_words_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shortest words of the documents as a stop list."""
    short = fr.document_words(spark, sf_dir).distinct().where(F.length("word") <= 3)
    return files.stop_words(spark, _text(spark, short.select(F.col("word").alias("value")), "stop"))


def text_sink_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "text-sink")
    sinks.text_sink(fr.table(spark, sf_dir, "customer"), path, "c_name", "c_custkey")
    return files.text_lines(spark, path)


def delimited_sink_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "delimited-sink")
    sinks.delimited_sink(fr.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role"), path, max_rows_per_file=100)
    return spark.read.schema("conv_id BIGINT, turn BIGINT, role STRING").option("sep", "|").csv(path)


QUERIES = {
    f.__name__: f
    for f in (
        lines_scan, id_list_scan, vertex_words_scan, sparse_examples_scan, stop_words_scan, text_sink_scan,
        delimited_sink_scan,
    )
}

ORACLES = {
    "lines_scan": with_sql(fr.SQL_LINES, select="SELECT value, count(*) AS times FROM lines GROUP BY value"),
    "id_list_scan": "SELECT user_id AS target_user, count(*) AS times FROM events GROUP BY user_id",
    "vertex_words_scan": rf"""
      SELECT row_number() OVER (ORDER BY doc_id) - 1 AS id, len(words) AS n_words, md5(array_to_string(words, ' ')) AS words_md5
      FROM (SELECT doc_id, [w FOR w IN string_split_regex(text, {fr.SQL_SPACE}) IF w <> ''] AS words FROM documents)""",
    "sparse_examples_scan": with_sql(
        fr.SQL_EXAMPLES,
        select="""SELECT example_id, label, count(*) AS n, round(sum(idx * value ORDER BY idx), 4) AS weighted
          FROM ex GROUP BY example_id, label""",
    ),
    "stop_words_scan": with_sql(fr.SQL_WORDS, select="SELECT DISTINCT word FROM words WHERE length(word) <= 3"),
    "text_sink_scan": "SELECT c_custkey || chr(9) || c_name AS value FROM customer",
    "delimited_sink_scan": "SELECT conv_id, turn, role FROM conversations",
}

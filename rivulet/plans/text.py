"""Text queries and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.functions import text as fn
from rivulet.operators import anagrams
from rivulet.plans import frames as fr
from rivulet.plans.frames import with_sql
from rivulet.runtime import fresh_path
from rivulet.sources import files


def activity_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the events as an activity file and reads it back."""
    path = fresh_path(spark, "activity")
    lines = F.concat_ws(" ", "user_id", "event_id", "ts_s", "action")
    fr.events(spark, sf_dir).select(lines.alias("value")).write.text(path)
    return files.activity(spark, path)


def letter_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fr.document_words(spark, sf_dir).distinct().withColumn("letter_key", fn.letter_key("word"))


def anagram_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anagrams.anagram_groups(fr.document_words(spark, sf_dir))


def anagram_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anagrams.anagram_ranked(anagram_groups(spark, sf_dir)).select("place", "letter_key", "n_words")


def anagram_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anagrams.anagram_lines(anagram_groups(spark, sf_dir))


def contains_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fr.document_lines(spark, sf_dir).agg(
        F.count_if(F.contains("value", F.lit("a"))).alias("lines_with_a"),
        F.count_if(F.contains("value", F.lit("b"))).alias("lines_with_b"),
    )


def line_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.line_count(fr.document_lines(spark, sf_dir))


def flatten_newlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fr.table(spark, sf_dir, "documents").select("doc_id", fn.flatten_newlines("text").alias("text"))


QUERIES = {
    f.__name__: f
    for f in (
        activity_scan, letter_key, anagram_groups, anagram_ranked, anagram_render, contains_counts, line_count,
        flatten_newlines,
    )
}

_KEYED = f"""{fr.SQL_WORDS},
keyed AS (
  SELECT word, array_to_string(list_sort(string_split(word, '')), '') AS letter_key
  FROM (SELECT DISTINCT word FROM words)),
grouped AS (
  SELECT letter_key, count(*) AS n_words, string_agg(word, ',' ORDER BY word) AS words
  FROM keyed GROUP BY letter_key HAVING count(*) > 1),
placed AS (SELECT *, row_number() OVER (ORDER BY n_words DESC, letter_key) AS place FROM grouped)"""

ORACLES = {
    "activity_scan": with_sql(
        fr.SQL_EVENTS,
        select="SELECT user_id::INTEGER AS user_a, event_id::INTEGER AS user_b, ts_s, action FROM ev",
    ),
    "letter_key": with_sql(_KEYED, select="SELECT word, letter_key FROM keyed"),
    "anagram_groups": with_sql(
        _KEYED, select="SELECT letter_key, word, n_words FROM keyed JOIN grouped USING (letter_key)"
    ),
    "anagram_ranked": with_sql(_KEYED, select="SELECT place, letter_key, n_words FROM placed"),
    "anagram_render": with_sql(_KEYED, select="SELECT place, replace(words, ',', ' ') AS line FROM placed"),
    "contains_counts": with_sql(
        fr.SQL_LINES,
        select="""SELECT count(*) FILTER (contains(value, 'a')) AS lines_with_a,
          count(*) FILTER (contains(value, 'b')) AS lines_with_b FROM lines""",
    ),
    "line_count": with_sql(fr.SQL_LINES, select="SELECT count(*) AS n_lines FROM lines"),
    "flatten_newlines": "SELECT doc_id, replace(text, chr(10), ' ') AS text FROM documents",
}

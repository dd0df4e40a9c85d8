"""Tweet queries and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.operators import control, words
from rivulet.plans import frames as fr
from rivulet.plans.frames import DAY, with_sql
from rivulet.runtime import literal_table
from rivulet.sources import tweets as src

COLLECTED = 4000


def stop_list(spark: SparkSession) -> DataFrame:
    return literal_table(spark, "word", fr.TEST_STOP_WORDS, "string")


def _with_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return control.asof_regular(fr.tweets(spark, sf_dir), fr.threshold_rows(spark, sf_dir), DAY)


def _accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return control.threshold_filter(_with_thresholds(spark, sf_dir))


def tweet_keyword_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.tweet_filter(fr.tweets(spark, sf_dir), fr.TEST_KEYWORDS).select("event_id", "lang", "friends_count")


def asof_threshold_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _accepted(spark, sf_dir).select("event_id", "generation_s", "friends_count")


def asof_irregular_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sign-up events are the control rows: they come at no fixed interval."""
    rows = fr.events(spark, sf_dir).withColumn("friends_count", F.floor("value").cast("int"))
    latest = control.asof_latest(rows, signup_marks(spark, sf_dir), "thresholds")
    return control.threshold_filter(latest).select("event_id", "generation_s", "friends_count")


def signup_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Control rows: per second with a sign-up its largest number of friends."""
    rows = fr.events(spark, sf_dir).where("action = 'signup'")
    most = F.max(F.floor("value").cast("int"))
    return rows.groupBy(F.col("ts_s").alias("generation_s")).agg(F.array(most).alias("thresholds"))


def generation_pairing(spark: SparkSession, sf_dir: str) -> DataFrame:
    accepted = accepted_without_text(spark, sf_dir)
    return control.pair_generations(accepted, fr.tag_rows(spark, sf_dir)).select(
        "generation_s", "tick_s", F.array_join("tags", ",").alias("tags")
    )


def accepted_without_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fr.events(spark, sf_dir).withColumn("friends_count", F.floor("value").cast("int"))
    return control.threshold_filter(control.asof_regular(rows, fr.threshold_rows(spark, sf_dir), DAY))


def tag_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = control.pair_generations(accepted_without_text(spark, sf_dir), fr.tag_rows(spark, sf_dir))
    return words.tag_filter(_accepted(spark, sf_dir), pairs).select("event_id", "generation_s")


def tweet_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every kept word of every document, counted per document."""
    docs = fr.documents(spark, sf_dir).select("doc_id", "text")
    kept = words.tweet_words(docs, stop_list(spark))
    return kept.groupBy("doc_id", "word").agg(F.count(F.lit(1)).alias("cnt"))


def _flushed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _accepted(spark, sf_dir).select("generation_s", F.floor(F.col("ts_s") / 21600).alias("flush"), "text")
    return words.generation_word_counts(words.tweet_words(rows, stop_list(spark), times="times"), "flush", times="times")


def generation_word_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flushed_counts(spark, sf_dir)


def generation_word_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.generation_word_totals(_flushed_counts(spark, sf_dir))


def popular_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _accepted(spark, sf_dir).select("generation_s", "text")
    found = words.tweet_words(rows, stop_list(spark), times="times")
    return words.popular_words(words.generation_word_counts(found, times="times"))


def popular_words_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    popular, _ = words.popular_words_pipeline(
        _with_thresholds(spark, sf_dir), fr.tag_rows(spark, sf_dir), stop_list(spark)
    )
    return popular


def collect_first_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = src.tweet_filter(fr.tweets(spark, sf_dir), [])
    return words.collect_first(rows.select("event_id", "ts", "text"), COLLECTED).select(
        "event_id", "pos", F.md5("text").alias("text_md5")
    )


QUERIES = {
    f.__name__: f
    for f in (
        tweet_keyword_filter, asof_threshold_filter, asof_irregular_filter,
        generation_pairing, tag_filter, tweet_words, generation_word_counts, generation_word_totals,
        popular_words, popular_words_pipeline, collect_first_n,
    )
}

TOP_HALF = """counted AS (SELECT generation_s, word, count(*) AS cnt FROM tw GROUP BY ALL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY generation_s ORDER BY cnt DESC, word) AS place,
    count(*) OVER (PARTITION BY generation_s) AS n FROM counted)"""
TOP_HALF_SELECT = "SELECT generation_s, place, word, cnt FROM ranked WHERE place <= greatest(n // 2, 1)"
_KEYWORD_TEST = " OR ".join(
    "len(list_filter([{}], lambda w: NOT list_contains(found, w))) = 0".format(
        ", ".join(f"'{w}'" for w in phrase.lower().split())
    )
    for phrase in fr.TEST_KEYWORDS
)
_FLUSHED = with_sql(
    fr.SQL_ACCEPTED,
    "flushed AS (SELECT generation_s, ts_s // 21600 AS flush, text FROM accepted)",
    fr.sql_tweet_words("flushed", "generation_s, flush"),
    select="SELECT generation_s, word, flush, count(*) AS cnt FROM tw GROUP BY ALL",
)

ORACLES = {
    "tweet_keyword_filter": with_sql(
        fr.SQL_TWEETS,
        "t AS (SELECT *, string_split_regex(lower(text), '[^a-z0-9]+') AS found FROM tweets WHERE lang = 'en')",
        select=f"SELECT event_id, lang, friends_count FROM t WHERE {_KEYWORD_TEST}",
    ),
    "asof_threshold_filter": with_sql(
        fr.SQL_ACCEPTED, select="SELECT event_id, generation_s, friends_count FROM accepted"
    ),
    "asof_irregular_filter": with_sql(
        fr.SQL_EVENTS,
        """marks AS (
          SELECT ts_s AS generation_s, max(CAST(floor(value) AS INTEGER)) AS threshold
          FROM ev WHERE action = 'signup' GROUP BY ts_s)""",
        """latest AS (
          SELECT event_id, CAST(floor(value) AS INTEGER) AS friends_count,
            coalesce(m.generation_s, (SELECT min(generation_s) FROM marks)) AS generation_s,
            coalesce(m.threshold, (SELECT arg_min(threshold, generation_s) FROM marks)) AS threshold
          FROM ev ASOF LEFT JOIN marks m ON ev.ts_s >= m.generation_s)""",
        select="SELECT event_id, generation_s, friends_count FROM latest WHERE friends_count < threshold",
    ),
    "generation_pairing": with_sql(
        fr.SQL_PAIRS, select="SELECT generation_s, tick_s, array_to_string(tags, ',') AS tags FROM pairs"
    ),
    "tag_filter": with_sql(fr.SQL_TAGGED, select="SELECT event_id, generation_s FROM tagged"),
    "tweet_words": with_sql(
        fr.sql_tweet_words("documents", "doc_id"),
        select="SELECT doc_id, word, count(*) AS cnt FROM tw GROUP BY doc_id, word",
    ),
    "generation_word_counts": _FLUSHED,
    "generation_word_totals": (
        f"SELECT generation_s, word, sum(cnt)::BIGINT AS cnt FROM ({_FLUSHED}) GROUP BY generation_s, word"
    ),
    "popular_words": with_sql(
        fr.SQL_ACCEPTED, fr.sql_tweet_words("accepted", "generation_s"), TOP_HALF, select=TOP_HALF_SELECT
    ),
    "popular_words_pipeline": with_sql(
        fr.SQL_TAGGED, fr.sql_tweet_words("tagged", "generation_s"), TOP_HALF, select=TOP_HALF_SELECT
    ),
    "collect_first_n": with_sql(
        fr.SQL_TWEETS,
        """placed AS (
          SELECT event_id, row_number() OVER (ORDER BY ts_us, event_id) AS pos,
            md5(replace(text, chr(10), ' ')) AS text_md5
          FROM tweets WHERE lang = 'en')""",
        select=f"SELECT event_id, pos, text_md5 FROM placed WHERE pos <= {COLLECTED}",
    ),
}

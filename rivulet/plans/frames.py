"""Frames derived from the given tables, each next to the SQL that defines the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.functions.text import WHITESPACE, letters_only, words_of
from rivulet.runtime import ordered_for_join, spread_if_narrow

DAY = 86400
TAG_EVERY = 100_000
DOCUMENTS_PER_TASK = 50_000  # a task hashes the texts of about so many at once
EVENTS_SCHEMA = (
    "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
)
CONTROL_DAYS = 3  # the threshold rows end so many days before the events do
TEST_KEYWORDS = ["thon", "the thand", "TION", "in of hathe", "with"]
TEST_STOP_WORDS = ["the", "of", "and", "le", "de", "is", "on", "to", "that", "in", "la", "der", "und", "el"]

SQL_SPACE = r"'[ \t\n\x0B\f\r]+'"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_sql(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


# --- graph -----------------------------------------------------------------------------------------

def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts and supplier slots in one id space: some vertices have no in-edge, some no out-edge."""
    target = F.col("l_suppkey") * 20 + F.col("l_linenumber")
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("src"), target.alias("dst"))
    return rows.where("src <> dst")


SQL_LINKS = """links AS (
  SELECT l_partkey AS src, l_suppkey * 20 + l_linenumber AS dst FROM lineitem
  WHERE l_partkey <> l_suppkey * 20 + l_linenumber)"""
SQL_VERTICES = "vertices AS (SELECT src AS id FROM links UNION SELECT dst FROM links)"


def overlap_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "benchmark")
    return rows.select(F.col("item_id").alias("id"), words_of("text").alias("words"))


SQL_OVERLAP = f"""vw AS (
  SELECT item_id AS id, list_filter(string_split_regex(text, {SQL_SPACE}), lambda w: w <> '') AS words FROM benchmark),
tok AS (SELECT DISTINCT id, unnest(words) AS word FROM vw),
pairs AS (SELECT DISTINCT a.id AS src, b.id AS dst FROM tok a JOIN tok b ON a.word = b.word AND a.id <> b.id),
overlap AS (
  SELECT src, dst, len(s.words) AS src_n, len(d.words) AS dst_n
  FROM pairs JOIN vw s ON s.id = src JOIN vw d ON d.id = dst)"""


def document_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as vertices; their ids have gaps and so span several bitmap blocks."""
    return documents(spark, sf_dir).select((F.col("doc_id") * 10).alias("id"), words_of("text").alias("words"))


SQL_DOCUMENT_OVERLAP = SQL_OVERLAP.replace("item_id AS id", "doc_id * 10 AS id").replace("FROM benchmark", "FROM documents")


# --- text ------------------------------------------------------------------------------------------

def document_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every token of every document, letters only, in lower case."""
    letters = F.lower(letters_only("text"))
    tokens = documents(spark, sf_dir).select(F.explode(F.split(letters, WHITESPACE)).alias("word"))
    return tokens.where("word <> ''")


SQL_WORDS = rf"""words AS (
  SELECT word FROM (
    SELECT lower(regexp_replace(unnest(string_split_regex(text, {SQL_SPACE})), '[^\p{{L}}]', '', 'g')) AS word
    FROM documents) WHERE word <> '')"""


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread_if_narrow(table(spark, sf_dir, "documents"), "doc_id")


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select(F.explode(F.split("text", "\n")).alias("value"))


SQL_LINES = "lines AS (SELECT unnest(string_split(text, chr(10))) AS value FROM documents)"


# --- events ----------------------------------------------------------------------------------------

def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    instant = F.col("ts").cast("timestamp")
    return table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        F.col("event_type").alias("action"),
        "value",
        instant.alias("ts"),
        F.unix_micros(instant).alias("ts_us"),
        F.unix_seconds(instant).alias("ts_s"),
    )


SQL_EVENTS = """ev AS (
  SELECT event_id, user_id, event_type AS action, value, epoch_us(ts) AS ts_us, epoch_us(ts) // 1000000 AS ts_s
  FROM events)"""


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with an arrival time up to 100 hours late, so most rows come out of order."""
    late = (F.col("event_id") * 7919 % 1000) * 360 * 1_000_000
    return events(spark, sf_dir).select("event_id", "action", "ts_s", (F.col("ts_us") + late).alias("arrival"))


SQL_ARRIVALS = f"""{SQL_EVENTS},
arr AS (
  SELECT event_id, action, ts_s, ts_us + (event_id * 7919 % 1000) * 360 * 1000000 AS arrival FROM ev),
seen AS (
  SELECT *, max(ts_s) OVER (ORDER BY arrival, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen_s,
    ts_s // {DAY} * {DAY} AS window_s FROM arr)"""


# --- tweets ----------------------------------------------------------------------------------------

def joined_tweets(events_df: DataFrame, docs: DataFrame) -> DataFrame:
    """Events that carry the text of document ``event_id % number of documents``; batch or stream.

    In a batch the rows of a task are in order of time, as tweets come, so neighbours share their generation and flush.
    The events are sorted, not the texts: a hash join keeps the order of the side it does not hash. Few large tasks meet a
    word of a flush less often than many small ones would, so there are three per core unless the texts need more.
    """
    n_docs = docs.agg(F.count(F.lit(1)).alias("n")).scalar()
    keyed, texts = events_df.withColumn("doc_id", F.col("event_id") % n_docs), docs.select("doc_id", "text", "lang")
    if not events_df.isStreaming:
        tasks = max(3 * docs.sparkSession.sparkContext.defaultParallelism, docs.count() // DOCUMENTS_PER_TASK)
        keyed = ordered_for_join(keyed.repartition(tasks, "doc_id"), "ts_s")
        texts = texts.repartition(tasks, "doc_id").hint("shuffle_hash")
    return keyed.join(texts, "doc_id").withColumn("friends_count", F.floor("value").cast("int"))


def tweets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joined_tweets(events(spark, sf_dir), documents(spark, sf_dir))


SQL_TWEETS = f"""{SQL_EVENTS},
tweets AS (
  SELECT event_id, ts_us, ts_s, CAST(floor(value) AS INTEGER) AS friends_count, text, lang
  FROM ev JOIN documents ON event_id % (SELECT count(*) FROM documents) = doc_id)"""


def threshold_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Control rows from the events: per day half of its largest value; they end before the events do."""
    rows = events(spark, sf_dir).select((F.floor(F.col("ts_s") / DAY) * DAY).alias("generation_s"), F.floor("value").cast("int").alias("v"))
    per_day = rows.groupBy("generation_s").agg(F.array((F.max("v") / 2).cast("int")).alias("thresholds"))
    last = rows.agg(F.max("generation_s")).scalar()
    return per_day.where(F.col("generation_s") <= last - CONTROL_DAYS * DAY)


def tag_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Control rows from the events: per tick the beginnings of the actions that are more frequent there than the mean."""
    tick = (F.floor(F.col("ts_s") / TAG_EVERY) * TAG_EVERY).alias("generation_s")
    counts = events(spark, sf_dir).where("ts_s IS NOT NULL").groupBy(tick, "action").agg(F.count(F.lit(1)).alias("n"))
    means = counts.groupBy("generation_s").agg(F.sum("n").alias("_all"), F.count(F.lit(1)).alias("_k"))
    often = counts.join(means, "generation_s").where(F.col("n") * F.col("_k") > F.col("_all"))
    tag = F.lower(F.substring("action", 1, 3))
    return often.groupBy("generation_s").agg(F.sort_array(F.collect_set(tag)).alias("tags"))


SQL_THRESHOLDS = f"""threshold_rows AS (
  SELECT day AS generation_s, CAST(max(v) // 2 AS INTEGER) AS threshold
  FROM (SELECT ts_s // {DAY} * {DAY} AS day, CAST(floor(value) AS INTEGER) AS v FROM ev)
  WHERE day <= (SELECT max(ts_s) // {DAY} * {DAY} FROM ev) - {CONTROL_DAYS * DAY} GROUP BY day)"""
SQL_TAGS = f"""tag_counts AS (
  SELECT ts_s // {TAG_EVERY} * {TAG_EVERY} AS tick, action, count(*) AS n FROM ev WHERE ts_s IS NOT NULL GROUP BY ALL),
tag_rows AS (
  SELECT tick AS generation_s, list_sort(list(DISTINCT lower(action[1:3]))) AS tags
  FROM (SELECT *, sum(n) OVER (PARTITION BY tick) AS total, count(*) OVER (PARTITION BY tick) AS k FROM tag_counts)
  WHERE n * k > total GROUP BY tick)"""
SQL_ACCEPTED = f"""{SQL_TWEETS},
{SQL_THRESHOLDS},
accepted AS (
  SELECT t.*, coalesce(g.generation_s, (SELECT min(generation_s) FROM threshold_rows)) AS generation_s
  FROM tweets t ASOF LEFT JOIN threshold_rows g ON t.ts_s >= g.generation_s
  WHERE friends_count < coalesce(threshold, (SELECT arg_min(threshold, generation_s) FROM threshold_rows)))"""
SQL_PAIRS = f"""{SQL_ACCEPTED},
{SQL_TAGS},
pairs AS (
  SELECT a.generation_s, b.tick_s, b.tags FROM
    (SELECT generation_s, row_number() OVER (ORDER BY generation_s) AS k
     FROM (SELECT DISTINCT generation_s FROM accepted)) a
    JOIN (SELECT generation_s AS tick_s, tags, row_number() OVER (ORDER BY generation_s) AS k FROM tag_rows) b
    ON a.k = b.k)"""
SQL_TAGGED = f"""{SQL_PAIRS},
tagged AS (
  SELECT event_id, ts_us, ts_s, tick_s AS generation_s, text FROM accepted JOIN pairs USING (generation_s)
  WHERE len(list_filter(tags, lambda g: contains(lower(text), g))) > 0)"""


def sql_tweet_words(source: str, columns: str) -> str:
    """CTE ``tw`` with one row per kept word of ``source``."""
    # The signs a word keeps, the mark of a mention and the beginning of a link, as in ``operators/words.py``.
    stop = ", ".join(f"'{w}'" for w in TEST_STOP_WORDS)
    return rf"""split AS (
  SELECT {columns}, string_split_regex(regexp_replace(text, '[ \t\n\x0B\f\r]+$', ''), {SQL_SPACE}) AS parts
  FROM {source}),
cutoff AS (
  SELECT *, list_position(list_transform(parts, lambda p: p[1] = '@'), true) AS mention FROM split),
raw AS (
  SELECT {columns}, unnest(CASE WHEN mention > 0 THEN parts[1:mention - 1] ELSE parts END) AS token FROM cutoff),
tw AS (
  SELECT {columns}, word FROM (
    SELECT {columns}, lower(regexp_replace(token, '[^a-zA-Z0-9-]', '', 'g')) AS word FROM raw)
  WHERE word NOT IN ({stop}) AND NOT starts_with(word, 'http') AND regexp_matches(word, '[a-z]'))"""


# --- numbers ---------------------------------------------------------------------------------------

def binary_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as ±1 examples of index and value, all entries."""
    kept = F.transform("embedding", lambda v, i: F.struct(i.cast("bigint").alias("index"), v.cast("double").alias("value")))
    label = F.when(F.col("label") < 5, 1.0).otherwise(-1.0)
    rows = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("example_id"), label.alias("label"), kept.alias("_e")
    )
    return rows.select("example_id", "label", F.col("_e.index").alias("index"), F.col("_e.value").alias("value"))


SQL_EXAMPLES = """ex AS MATERIALIZED (
  SELECT example_id, label, idx, value FROM (
    SELECT vec_id AS example_id, CASE WHEN label < 5 THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END AS label,
      i - 1 AS idx, embedding[i]::DOUBLE AS value
    FROM (SELECT vec_id, label, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)))"""


def word_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents as ±1 examples: a feature per word, a number made of its digest, with its share of the words."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("quality") == 1, 1.0).otherwise(-1.0).alias("label"))
    found = F.filter(F.split(F.lower(letters_only("text")), WHITESPACE), lambda w: w != "")
    # the words are counted before they are given out: in one step the text would be cut again for every word of it
    cut = documents(spark, sf_dir).join(labels, "doc_id").select("doc_id", "label", found.alias("_found"))
    words = cut.select("doc_id", "label", F.size("_found").alias("_n"), "_found").select("doc_id", "label", "_n", F.explode("_found").alias("word"))
    index = F.conv(F.substring(F.md5("word"), 1, 15), 16, 10).cast("bigint")
    counted = words.groupBy("doc_id", "label", "_n", index.alias("index")).agg(F.count(F.lit(1)).alias("_k"))
    entry = F.struct("index", (F.col("_k") / F.col("_n")).alias("value"))
    return counted.groupBy(F.col("doc_id").alias("example_id"), "label").agg(F.sort_array(F.collect_list(entry)).alias("_e")).select(
        "example_id", "label", F.col("_e.index").alias("index"), F.col("_e.value").alias("value")
    )


SQL_WORD_EXAMPLES = rf"""tok AS (
  SELECT doc_id, label, lower(regexp_replace(token, '[^\p{{L}}]', '', 'g')) AS word FROM (
    SELECT doc_id, CASE WHEN quality = 1 THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END AS label,
      unnest(string_split_regex(text, {SQL_SPACE})) AS token FROM documents JOIN labels USING (doc_id))),
ex AS MATERIALIZED (
  SELECT doc_id AS example_id, label, ('0x' || md5(word)[1:15])::BIGINT AS idx,
    count(*) / sum(count(*)) OVER (PARTITION BY doc_id) AS value
  FROM tok WHERE word <> '' GROUP BY doc_id, label, word)"""


def softmax_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("example_id"), F.col("label").cast("int").alias("label"),
        F.col("embedding").cast("array<double>").alias("features"),
    )


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sparse square matrix of ordered quantities over parts and supplier slots."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("i"), (F.col("l_suppkey") * 20 + F.col("l_linenumber")).alias("j"),
        F.col("l_quantity").alias("v"),
    )


def counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(
        F.col("user_id").alias("host"), F.col("action").alias("metric"), "ts_us", "event_id", "value"
    )

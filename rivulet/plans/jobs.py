"""The complete jobs, from input paths to output, as a user starts them.

Each returns its result frame, still to be written or shown, unless it takes an output path.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from rivulet.operators import anagrams, bursts, control, graph, overlap, sgd, words
from rivulet.runtime import make_folder
from rivulet.sources import files, sinks, tweets
from rivulet.streaming import queries as sq
from rivulet.streaming import state
from rivulet.streaming.sinks import BatchTable, CollectedLines, LateDropWindows


def anagram_job(spark: SparkSession, words_path: str, output: str) -> None:
    """Anagram groups of a word list as text lines; the output files in name order rank them."""
    listed = files.text_lines(spark, words_path).select(F.col("value").alias("word")).where("word <> ''")
    lines = anagrams.anagram_lines(anagrams.anagram_groups(listed))
    sinks.text_sink(lines.orderBy("place").select("line"), output, "line")


def pagerank_job(spark: SparkSession, edges_path: str, iterations: int = 10, **options) -> DataFrame:
    """PageRank of an edge list, ids as strings; ``options`` as of ``graph.pagerank``."""
    return graph.pagerank(files.edge_list(spark, edges_path), iterations, **options)


def graph_pagerank_job(spark: SparkSession, edges_path: str, iterations: int = 20) -> DataFrame:
    """PageRank of an edge list with integer ids, as edges with the rank and out-degree of both ends."""
    edges = files.edge_list(spark, edges_path).select(F.col("src").cast("int"), F.col("dst").cast("int"))
    ranks = graph.pagerank_graph(edges, iterations)
    return graph.triplets(graph.out_degrees(ranks, edges), edges)


def word_compare_job(spark: SparkSession, lines_path: str) -> DataFrame:
    return overlap.longer_edge_count(files.vertex_words(spark, lines_path))


def most_popular_job(spark: SparkSession, lines_path: str) -> DataFrame:
    return overlap.most_popular_vertex(files.vertex_words(spark, lines_path))


def average_words_job(spark: SparkSession, lines_path: str, count_timestamp: bool = False) -> DataFrame:
    return overlap.neighborhood_avg_words(files.vertex_words(spark, lines_path), count_timestamp=count_timestamp)


def action_query_job(
    spark: SparkSession,
    folder: str,
    query: str,
    each_batch: Callable[[DataFrame, int], None],
    checkpoint: str,
    targets_path: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start one of the action-stream queries: ``sliding``, ``mentions`` or ``targets``."""
    actions = files.action_stream(spark, folder).select(
        F.col("userA").alias("user_a"), F.col("userB").alias("user_b"), F.col("timestamp").alias("ts"), "action"
    )
    if query == "sliding":
        return sq.start(sq.sliding_counts(actions), "complete", each_batch, checkpoint, trigger)
    if query == "mentions":
        every = trigger or {"processingTime": "10 seconds"}
        return sq.start(sq.filter_project(actions), "append", each_batch, checkpoint, every)
    if query == "targets":
        counts = sq.static_join_counts(actions, files.id_list(spark, targets_path))
        return sq.start(counts, "complete", each_batch, checkpoint, trigger or {"processingTime": "5 seconds"})
    raise ValueError(f"unknown query {query}")


def sliding_burst_job(spark: SparkSession, activity_path: str, min_count: int = 100) -> DataFrame:
    """Bursts of an in-order activity file in windows of 60 s that start every second."""
    return bursts.sliding_bursts(files.activity(spark, activity_path), 60, 1, min_count)


def tumbling_burst_job(
    spark: SparkSession, activity_path: str, arrival: list[str], delay_s: int = 500, min_count: int = 100
) -> DataFrame:
    """Bursts in one-minute windows; rows later than ``delay_s`` behind the ``arrival`` order are dropped."""
    return bursts.late_drop_windows(files.activity(spark, activity_path), delay_s, 60, arrival, min_count)


def collect_tweets_job(
    tweet_rows: DataFrame, output: str, keywords: list[str], n: int = 200_000
) -> None:
    """The first ``n`` matching tweets as delimited lines."""
    chosen = tweets.tweet_filter(tweet_rows, keywords)
    sinks.delimited_sink(words.collect_first(chosen, n).select("text"), output)


def popular_words_job(
    tweet_rows: DataFrame,
    stop: DataFrame | list[str],
    words_output: str,
    tweets_output: str,
    keywords: list[str],
    thresholds: DataFrame,
    tags: DataFrame,
) -> None:
    """Popular words per generation and the tweets they come from, both as delimited lines.

    ``tweet_rows`` are ``(event_id, ts_s, text, lang, friends_count)``, the control rows
    ``thresholds(generation_s, thresholds)`` and ``tags(generation_s, tags)`` with tags in lower case. A tweet
    takes the latest thresholds at or before it.
    """
    chosen = tweets.tweet_filter(tweet_rows, keywords)
    joined = control.asof_latest(chosen, thresholds, "thresholds", "ts_s", "event_id")
    popular, tagged = words.popular_words_pipeline(joined, tags, stop)
    sinks.delimited_sink(words.popular_lines(popular).select("line"), words_output)
    sinks.delimited_sink(tagged.select("generation_s", "text"), tweets_output)


def popular_words_stream_job(
    tweet_rows: DataFrame,
    thresholds: DataFrame,
    tags: DataFrame,
    stop: DataFrame | list[str],
    folder: str,
    flush_s: int = 10,
    delay: str = "0 seconds",
    trigger: dict | None = None,
) -> list[StreamingQuery]:
    """The same as a stream: three queries side by side, which hand rows on by files under ``folder``.

    Streams: ``tweet_rows (event_id, ts, text, friends_count)``, ``thresholds (generation_s, thresholds)`` and
    ``tags (generation_s, tags)``; rows with only a time are heartbeats. Accepted tweets are in ``accepted``, generations
    with their tags in ``pairs``, and ranked words of closed generations in ``popular``. Started again with the same
    ``folder``, the queries go on where they stopped.
    """
    spark = tweet_rows.sparkSession
    accepted = sq.accepted_rows(tweet_rows, thresholds, delay=delay)
    queries = [sq.publish(accepted, f"{folder}/accepted", f"{folder}/state/accepted", trigger)]

    def published(name: str, schema: StructType) -> DataFrame:
        make_folder(spark, f"{folder}/{name}")
        return spark.readStream.schema(schema).parquet(f"{folder}/{name}")

    pairs = state.pair_generations(published("accepted", accepted.schema), tags.where("tags IS NOT NULL"))
    queries.append(sq.publish(pairs, f"{folder}/pairs", f"{folder}/state/pairs", trigger))
    counts = sq.tagged_words(published("accepted", accepted.schema), published("pairs", pairs.schema), None, stop, flush_s)
    queries.append(sq.start(counts, "append", popular_table(folder), f"{folder}/state/popular", trigger))
    return queries


def popular_table(folder: str) -> BatchTable:
    """The ranked words that ``popular_words_stream_job`` has written."""
    return BatchTable(f"{folder}/popular", "generation_s BIGINT, place BIGINT, word STRING, cnt BIGINT", words.popular_words)


def collect_stream_job(
    tweet_rows: DataFrame, output: str, keywords: list[str], n: int = 200_000, max_bytes: int = 5_000_000,
    checkpoint: str | None = None, trigger: dict | None = None,
) -> tuple[StreamingQuery, CollectedLines]:
    """The first ``n`` matching tweets of a stream ``(event_id, ts, text, lang)`` as lines in files of ``max_bytes``.

    ``drain`` of the second result waits until there are enough and stops the query.
    """
    chosen = tweets.tweet_filter(tweet_rows, keywords).select("event_id", "ts", "text")
    sink = CollectedLines(output, n, max_bytes=max_bytes)
    return sq.start(chosen, "append", sink, checkpoint, trigger), sink


def late_drop_stream_job(
    actions: DataFrame, output: str, arrival: list[str], delay_s: int = 500, checkpoint: str | None = None,
    trigger: dict | None = None,
) -> tuple[StreamingQuery, LateDropWindows]:
    """One-minute windows over a stream ``(action, ts_s, …)``; rows later than ``delay_s`` are dropped one by one."""
    sink = LateDropWindows(output, delay_s, 60, arrival)
    return sq.start(actions, "append", sink, checkpoint, trigger), sink


def logistic_job(
    spark: SparkSession, train_path: str, test_path: str, steps: int, n_batches: int, eta: float = 0.01, init: float = 1.0
) -> DataFrame:
    """Synchronous SGD on sparse examples, then rows and sign errors on the test files."""
    train = sgd.minibatch_assign(files.sparse_examples(spark, train_path), n_batches)
    model = sgd.sync_sgd(train, steps, n_batches, eta, init)
    held_out = files.sparse_examples(spark, test_path).withColumn("split", F.lit("held_out"))
    return sgd.error_counts(held_out, model, init, "split")

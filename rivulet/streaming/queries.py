"""Streaming queries over an action stream ``(user_a, user_b, ts TIMESTAMP, action)`` and over tweets."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from rivulet.functions.text import contains_any
from rivulet.operators.bursts import burst_columns
from rivulet.operators.words import tweet_words
from rivulet.runtime import broadcast_if_small, configured, delete_folder, fresh_path, lean_shuffles
from rivulet.streaming import state
from rivulet.streaming.sinks import BatchTable

_STORE_KEY = "spark.sql.streaming.stateStore.providerClass"
_RETAIN_KEY = "spark.sql.streaming.minBatchesToRetain"
_COMPACT_KEY = "spark.sql.streaming.stateStore.rocksdb.compactOnCommit"


def start(
    stream: DataFrame,
    mode: str,
    each_batch: Callable[[DataFrame, int], None],
    checkpoint: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start a query with its own checkpoint folder; by default it ends when the present input is done."""
    writer = stream.writeStream.outputMode(mode).foreachBatch(each_batch)
    return _started(stream.sparkSession, writer, checkpoint, trigger)


def publish(
    stream: DataFrame, path: str, checkpoint: str | None = None, trigger: dict | None = None
) -> StreamingQuery:
    """Start a query whose rows another query reads from ``path``: Parquet files with a commit log, each row once."""
    writer = stream.writeStream.outputMode("append").format("parquet").option("path", path)
    return _started(stream.sparkSession, writer, checkpoint, trigger)


def _started(spark: SparkSession, writer: DataStreamWriter, checkpoint: str | None, trigger: dict | None) -> StreamingQuery:
    folder = checkpoint or fresh_path(spark, "stream-state")
    writer = writer.option("checkpointLocation", folder).trigger(**(trigger or {"availableNow": True}))
    with configured(spark, _STORE_KEY, state.STORE):  # a query takes it over when it starts
        return writer.start()


def run(stream: DataFrame, mode: str, sink: BatchTable, checkpoint: str | None = None) -> BatchTable:
    """Work off the present input into ``sink``.

    Without a ``checkpoint`` nothing goes on from here: only the latest versions of the state are kept and without what was
    given out, the files of a micro-batch's shuffles go when it ends, and the state goes when the input is done.
    """
    if checkpoint:
        start(stream, mode, sink, checkpoint).awaitTermination()
        return sink
    spark = stream.sparkSession
    folder = fresh_path(spark, "stream-state")
    try:
        with lean_shuffles(spark), configured(spark, _RETAIN_KEY, "2"), configured(spark, _COMPACT_KEY, "true"):
            query = start(stream, mode, sink, folder)
        query.awaitTermination()
    finally:
        delete_folder(spark, folder)
    return sink


def _bounds() -> list:
    return [F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end")]


def sliding_counts(actions: DataFrame, size: str = "60 minutes", slide: str = "30 minutes") -> DataFrame:
    """Rows per sliding window and action, ordered; for complete mode."""
    counted = actions.groupBy(F.window("ts", size, slide), "action").agg(F.count(F.lit(1)).alias("cnt"))
    return counted.select(*_bounds(), "action", "cnt").orderBy("window_start", "action")


def filter_project(actions: DataFrame, action: str = "MT") -> DataFrame:
    """``user_b`` of rows with one action; for append mode."""
    return actions.where(F.col("action") == action).select("user_b")


def static_join_counts(actions: DataFrame, targets: DataFrame) -> DataFrame:
    """Rows per user of a static list; a user listed twice counts twice. For complete mode."""
    users = broadcast_if_small(targets.select(F.col("target_user").alias("user_a")))
    return actions.join(users, "user_a").groupBy("user_a").agg(F.count(F.lit(1)).alias("cnt"))


def bursts(
    actions: DataFrame, size: str = "60 seconds", delay: str = "500 seconds", min_count: int = 100, slide: str | None = None
) -> DataFrame:
    """Closed windows, tumbling or with a ``slide``, of more than ``min_count`` rows per action; for append mode.

    Sliding windows are built from panes of one slide: rows are counted once, and only the panes, one per
    action and slide, are copied into their windows. ``size`` is a multiple of ``slide``.
    """
    seconds = F.unix_seconds("ts")
    counted = (
        actions.withWatermark("ts", delay)
        .groupBy(F.window("ts", slide or size).alias("window"), "action")
        .agg(F.min(seconds).alias("start_s"), F.max(seconds).alias("end_s"), F.count(F.lit(1)).alias("cnt"))
    )
    if slide:
        panes = counted.select(F.window_time("window").alias("pane"), "action", "start_s", "end_s", "cnt")
        counted = panes.groupBy(F.window("pane", size, slide).alias("window"), "action").agg(
            F.min("start_s").alias("start_s"), F.max("end_s").alias("end_s"), F.sum("cnt").alias("cnt")
        )
    return counted.where(F.col("cnt") > min_count).select(
        F.unix_seconds("window.start").alias("window_s"), *burst_columns()
    )


def control_join(tweets: DataFrame, control: DataFrame, every_s: int = 30, delay: str = "60 seconds") -> DataFrame:
    """A stream ``(ts, …)`` joined with a stream of control rows ``(generation_s, …)`` on the tick.

    Ticks lie on multiples of ``every_s`` without gaps; with gaps take ``state.asof_latest``. Both sides carry the
    tick as a watermarked time, so the join drops its state once a tick is older than ``delay`` on both.
    """
    tick = (F.floor(F.unix_seconds("ts") / every_s) * every_s).cast("bigint")
    left = tweets.withColumn("tick", F.timestamp_seconds(tick)).withWatermark("tick", delay)
    right = control.withColumn("_tick", F.timestamp_seconds("generation_s")).withWatermark("_tick", delay)
    return left.join(right, F.col("tick") == F.col("_tick")).drop("_tick", "tick")


def generation_counts(
    tweets: DataFrame, stop: DataFrame | list[str], every: str = "30 seconds", delay: str = "0 seconds"
) -> DataFrame:
    """``(generation_s, word, cnt)`` of closed generations; each is reported once and whole.

    ``tweets`` is a stream ``(ts, text)`` that has passed the filters. For append mode.
    """
    spans = tweets.withWatermark("ts", delay).select(F.window("ts", every).alias("window"), "text")
    words = tweet_words(spans, stop, times="times")
    counted = words.groupBy("window", "word").agg(F.sum("times").alias("cnt"))
    return counted.select(F.unix_seconds("window.start").alias("generation_s"), "word", "cnt")


def flushed_totals(
    tweets: DataFrame, stop: DataFrame | list[str], flush: str = "10 seconds", every: str = "30 seconds",
    delay: str | None = "0 seconds", count_flushes: bool = False,
) -> DataFrame:
    """``(generation_s, word, cnt)``: counts per flush, and of these the totals per closed generation.

    Two chained aggregations: a flush gives out its counts once the watermark has passed it and forgets
    them, a generation adds up what its flushes gave and is reported once. ``count_flushes`` counts the
    flushes instead. ``every`` is a multiple of ``flush``. Without a ``delay`` the stream has its watermark
    already. For append mode.
    """
    timed = tweets if delay is None else tweets.withWatermark("ts", delay)
    words = tweet_words(timed.select(F.window("ts", flush).alias("flush"), "text"), stop, times="times")
    flushed = words.groupBy("flush", "word").agg(F.sum("times").alias("cnt"))
    total = F.count(F.lit(1)) if count_flushes else F.sum("cnt")
    given = flushed.select(F.window_time("flush").alias("given"), "word", "cnt")
    totals = given.groupBy(F.window("given", every).alias("span"), "word").agg(total.alias("cnt"))
    return totals.select(F.unix_seconds("span.start").alias("generation_s"), "word", "cnt")


def accepted_rows(
    rows: DataFrame, thresholds: DataFrame, time: str = "ts", id: str = "event_id", delay: str = "0 seconds",
    salts: int = state.SALTS,
) -> DataFrame:
    """Streams: ``rows`` with fewer friends than the latest thresholds allow, with the ``generation_s`` of these.

    A row with a null ``id`` is a heartbeat: it passes, and its generation is its own time.
    """
    joined = state.asof_latest(rows, thresholds, "thresholds", time, id, delay, salts)
    beat = F.col(id).isNull()
    kept = joined.where(beat | F.exists("thresholds", lambda t: F.col("friends_count") < t)).drop("thresholds")
    return kept.withColumn("generation_s", F.when(beat, F.unix_seconds(time)).otherwise(F.col("generation_s")))


def tagged_words(
    accepted: DataFrame, pairs: DataFrame, texts: DataFrame | None, stop: DataFrame | list[str], flush_s: int = 10,
    id: str = "event_id", delay: str = "1 second", salts: int = state.SALTS,
) -> DataFrame:
    """``(generation_s, word, cnt)`` of the accepted rows whose text has a tag of their generation; for append mode.

    ``accepted`` and ``pairs`` are streams; the text is in ``accepted``, or in a table ``texts (doc_id, text)``. A generation closes when both
    streams have come to a later one; it is counted flush by flush, and reported once, by its tag tick.
    Heartbeats of ``accepted`` have a ``doc_id`` without a text, not a null one: the optimizer would drop nulls
    of a join before they move the watermark on.
    """
    if texts is None:
        accepted = accepted.withColumn("text", F.coalesce("text", F.lit("")))  # for the same reason
    met = state.join_pairs(accepted, pairs, id, delay, salts)
    tagged = (met if texts is None else met.join(texts, "doc_id")).where(contains_any("text", F.col("tags")))
    flush = F.floor(F.unix_seconds("ts") / flush_s).alias("flush")
    words = tweet_words(tagged.select("generation", "tick_s", flush, "text"), stop, times="times")
    flushed = words.groupBy("generation", "tick_s", "flush", "word").agg(F.sum("times").alias("cnt"))
    totals = flushed.groupBy("generation", "tick_s", "word").agg(F.sum("cnt").alias("cnt"))
    return totals.select(F.col("tick_s").alias("generation_s"), "word", "cnt")

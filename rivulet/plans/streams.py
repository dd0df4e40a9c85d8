"""Streaming queries, run over the present input, and the SQL of their results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.operators import words
from rivulet.plans import frames as fr
from rivulet.plans import tweets as tw
from rivulet.plans.bursts import ARRIVAL, BURST_COLUMNS
from rivulet.plans.bursts import ORACLES as BURST_ORACLES
from rivulet.plans.frames import DAY, with_sql
from rivulet.runtime import delete_folder, fresh_path
from rivulet.sources import tweets as src
from rivulet.sources.files import parquet_stream
from rivulet.streaming import queries as sq
from rivulet.streaming import state
from rivulet.streaming.sinks import BatchTable, CollectedLines, LateDropWindows, ReportSink

BURST_DELAY_H = 6
SLICES = 4
#: A stream whose state grows with its words takes about so many events to a micro-batch.
EVENTS_PER_SLICE = 1_000_000
FLUSH_S = 6 * 3600
LATE_S = 24 * 3600
#: The heartbeat that ends an input lies so long after its last event.
CLOSING_S = 30 * DAY
COLLECT_BYTES = 1_000_000
_sliced: dict[tuple, tuple[str, int]] = {}


def _slices(spark: SparkSession, sf_dir: str, label: str, rows: DataFrame, place: Column, width: int, closing_s: int, time: str, slices: int = SLICES) -> tuple[str, int]:
    """``rows`` in ``slices`` folders by ``place``, each with ``width`` files, and a last one of heartbeats.

    The folders are written one after the other, which is the order in which a stream reads them. They are
    made once per session and table. For more than ``SLICES`` the rows are dealt out once, not read for each.
    """
    key = (spark.sparkContext.applicationId, sf_dir, label, slices)
    if key not in _sliced:
        folder = fresh_path(spark, f"{label}-slices")
        dealt = fresh_path(spark, f"{label}-dealt") if slices > SLICES else None
        if dealt:
            rows.withColumn("_place", place).write.partitionBy("_place").parquet(dealt)
            rows, place = spark.read.schema(f"{_schema(rows)}, _place BIGINT").parquet(dealt), F.col("_place")
        for k in range(slices):
            path = f"{folder}/slice-{k}"
            rows.where(place == k).drop("_place").repartition(width).write.parquet(path)
            for _ in range(width - _files(spark, path)):  # tasks without a row leave no file
                rows.limit(0).drop("_place").coalesce(1).write.mode("append").parquet(path)
        if dealt:
            rows = rows.drop("_place")
            delete_folder(spark, dealt)
        _beats(rows, time, closing_s, width).write.parquet(f"{folder}/closing")
        _sliced[key] = folder, width
    return _sliced[key]


def _files(spark: SparkSession, path: str) -> int:
    return len(spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).inputFiles())


def _span(rows: DataFrame, second: Column) -> tuple[int, int]:
    """The first and the last second of the rows."""
    first, last = rows.agg(F.min(second), F.max(second)).first()
    return first or 0, last or 0


def _second() -> Column:
    return F.unix_seconds(F.col("ts").cast("timestamp"))


def _place(second: Column, first: int, last: int, slices: int = SLICES) -> Column:
    """The slice of a time: equal spans from ``first`` to ``last``; no time, or an earlier one, is in the first slice."""
    part = F.floor((second - first) * slices / F.lit(last - first + 1))
    return F.greatest(F.lit(0), F.least(F.coalesce(part, F.lit(0)), F.lit(slices - 1)))


def _beats(rows: DataFrame, time: str, second: int, width: int) -> DataFrame:
    """A heartbeat for each of ``width`` files: a row that carries only a time."""
    kind = dict(rows.dtypes)[time]
    value = F.lit(second) if kind == "bigint" else F.timestamp_seconds(F.lit(second)).cast(kind)
    spark = rows.sparkSession
    return spark.range(0, width, 1, width).select(
        *[(value if name == time else F.lit(None)).cast(k).alias(name) for name, k in rows.dtypes]
    )


def event_stream(spark: SparkSession, sf_dir: str, closing: bool = False, per_slice: int | None = None) -> DataFrame:
    """The events in ``SLICES`` equal spans of time, each a micro-batch of its own; those without a time are in the first.

    A slice is written by as many tasks as read the table, and a trigger takes a slice. With ``closing`` a
    last batch holds heartbeats: rows without an id, long after the last event. There are more slices where the
    events would come to more than ``per_slice`` each.
    """
    rows = fr.table(spark, sf_dir, "events")
    first, last = _span(rows, _second())
    slices = max(SLICES, -(-rows.count() // per_slice)) if per_slice else SLICES
    place, width = _place(_second(), first, last, slices), rows.rdd.getNumPartitions()
    folder, width = _slices(spark, sf_dir, "event", rows, place, width, last + CLOSING_S, "ts", slices)
    stream = parquet_stream(
        spark, f"{folder}/*" if closing else f"{folder}/slice-*", fr.EVENTS_SCHEMA, files_per_trigger=width
    )
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def control_stream(spark: SparkSession, sf_dir: str, label: str, control: DataFrame) -> DataFrame:
    """``control (generation_s, …)`` in the slices of the events, a file each, and a heartbeat at the end."""
    first, last = _span(fr.table(spark, sf_dir, "events"), _second())
    place = _place(F.col("generation_s"), first, last)
    folder, width = _slices(spark, sf_dir, label, control, place, 1, last + CLOSING_S, "generation_s")
    return parquet_stream(spark, f"{folder}/*", _schema(control), files_per_trigger=width)


def arrival_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as they arrive, a fourth of the arrival time to a micro-batch."""
    rows = fr.arrivals(spark, sf_dir)
    second = F.floor(F.col("arrival") / 1_000_000)
    place, width = _place(second, *_span(rows, second)), fr.table(spark, sf_dir, "events").rdd.getNumPartitions()
    folder, width = _slices(spark, sf_dir, "arrival", rows, place, width, 0, "ts_s")
    return parquet_stream(spark, f"{folder}/slice-*", _schema(rows), files_per_trigger=width)


def action_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_stream(spark, sf_dir).select(
        F.col("user_id").alias("user_a"), F.col("event_id").alias("user_b"), "ts", F.col("event_type").alias("action")
    )


def _schema(df: DataFrame) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in df.dtypes)


def _table(spark: SparkSession, stream: DataFrame, sink=BatchTable, keep: int | None = None) -> BatchTable:
    return sink(fresh_path(spark, "stream-rows"), _schema(stream), keep=keep)


def _sliding(spark: SparkSession, sf_dir: str) -> ReportSink:
    counts = sq.sliding_counts(action_stream(spark, sf_dir))
    return sq.run(counts, "complete", _table(spark, counts, ReportSink, keep=2))


def stream_sliding_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _counts(_sliding(spark, sf_dir).latest(spark))


def _counts(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.unix_seconds("window_start").alias("window_start_s"),
        F.unix_seconds("window_end").alias("window_end_s"),
        "action", "cnt",
    )


def stream_restarted_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same counts by a query that is stopped after its first batches and goes on from its checkpoint.

    Times go through whole seconds, as a source with epoch seconds gives them.
    """
    actions = action_stream(spark, sf_dir).withColumn("ts", F.timestamp_seconds(F.unix_seconds("ts")))
    counts, checkpoint = sq.sliding_counts(actions), fresh_path(spark, "stream-state")
    sink = _table(spark, counts, keep=2)
    first = sq.start(counts, "complete", sink, checkpoint, {"processingTime": "0 seconds"})
    while not first.awaitTermination(0.1) and len(first.recentProgress) < 2:
        pass
    first.stop()
    return _counts(sq.run(counts, "complete", sink, checkpoint).latest(spark))


def stream_batch_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sliding(spark, sf_dir).reports(spark)


def stream_filter_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = sq.filter_project(action_stream(spark, sf_dir), "click")
    return sq.run(chosen, "append", _table(spark, chosen)).rows(spark).select("user_b")


def stream_static_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Targets: customers with a balance above 3000, and once more those in the building segment."""
    customers = fr.table(spark, sf_dir, "customer")
    targets = customers.where("c_acctbal > 3000").unionByName(customers.where("c_mktsegment = 'BUILDING'"))
    counts = sq.static_join_counts(
        action_stream(spark, sf_dir), targets.select(F.col("c_custkey").alias("target_user"))
    )
    return sq.run(counts, "complete", _table(spark, counts, keep=2)).latest(spark)


def stream_burst_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    closed = sq.bursts(action_stream(spark, sf_dir), "1 day", f"{BURST_DELAY_H} hours", 65)
    return sq.run(closed, "append", _table(spark, closed)).rows(spark).drop("batch_id")


def stream_burst_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of 60 hours that start every hour."""
    closed = sq.bursts(action_stream(spark, sf_dir), "60 hours", f"{BURST_DELAY_H} hours", 130, "1 hour")
    return sq.run(closed, "append", _table(spark, closed)).rows(spark).drop("batch_id")


def stream_late_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events in order of arrival, most of them out of order: late ones are told record by record."""
    sink = LateDropWindows(fresh_path(spark, "stream-rows"), LATE_S, DAY, ARRIVAL)
    return sq.run(arrival_stream(spark, sf_dir), "append", sink).windows(spark)


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events in whole seconds, with a number of friends and the document that holds their text."""
    return event_stream(spark, sf_dir, closing=True).select(
        "event_id", F.date_trunc("second", "ts").alias("ts"), F.floor("value").cast("int").alias("friends_count"),
        _doc_id(spark, sf_dir).alias("doc_id"),
    )


def _doc_id(spark: SparkSession, sf_dir: str) -> Column:
    """The document of an event; -1, which no document has, for a heartbeat (a null would be dropped by a join
    before it moves the watermark on)."""
    n_docs = fr.table(spark, sf_dir, "documents").agg(F.count(F.lit(1)).alias("n")).scalar()
    return F.coalesce(F.col("event_id") % n_docs, F.lit(-1))


def stream_asof_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sign-ups are the control rows: they come at no fixed interval."""
    marks = control_stream(spark, sf_dir, "signup", tw.signup_marks(spark, sf_dir))
    accepted = sq.accepted_rows(_rows(spark, sf_dir), marks)
    chosen = accepted.where("event_id IS NOT NULL").select("event_id", "generation_s", "friends_count")
    return sq.run(chosen, "append", _table(spark, chosen)).rows(spark).drop("batch_id")


def _paired(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Runs the first two queries of the topology over the present input; the folders of their rows."""
    folder = fresh_path(spark, "topology")
    thresholds = control_stream(spark, sf_dir, "threshold", fr.threshold_rows(spark, sf_dir))
    accepted = sq.accepted_rows(_rows(spark, sf_dir), thresholds)
    sq.publish(accepted, f"{folder}/accepted").awaitTermination()
    tags = control_stream(spark, sf_dir, "tag", fr.tag_rows(spark, sf_dir)).where("tags IS NOT NULL")
    pairs = state.pair_generations(_published(spark, f"{folder}/accepted", _ACCEPTED), tags)
    sq.publish(pairs, f"{folder}/pairs").awaitTermination()
    return f"{folder}/accepted", f"{folder}/pairs"


_ACCEPTED = "event_id BIGINT, ts TIMESTAMP, friends_count INT, doc_id BIGINT, generation_s BIGINT"
_PAIRS = "generation_s BIGINT, tick_s BIGINT, tags ARRAY<STRING>"


def _published(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)


def stream_generation_pairing(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, pairs = _paired(spark, sf_dir)
    return spark.read.schema(_PAIRS).parquet(pairs).where("tags IS NOT NULL").select(
        "generation_s", "tick_s", F.array_join("tags", ",").alias("tags")
    )


def stream_generation_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word counts per six hours, and of these the totals per day."""
    timed = event_stream(spark, sf_dir, True, EVENTS_PER_SLICE).withWatermark("ts", "0 seconds")  # before heartbeats go
    texts = fr.table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = timed.withColumn("doc_id", _doc_id(spark, sf_dir)).join(texts, "doc_id").select("ts", "text")
    totals = sq.flushed_totals(rows, tw.stop_list(spark), f"{FLUSH_S} seconds", "1 day", delay=None)
    return sq.run(totals, "append", _table(spark, totals)).rows(spark).drop("batch_id")


def stream_popular_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tweet topology: three queries that hand rows on by files. Closed generations are ranked."""
    accepted, pairs = _paired(spark, sf_dir)
    counts = sq.tagged_words(
        _published(spark, accepted, _ACCEPTED), _published(spark, pairs, _PAIRS),
        fr.table(spark, sf_dir, "documents").select("doc_id", "text"), tw.stop_list(spark), FLUSH_S,
    )
    sink = BatchTable(
        fresh_path(spark, "stream-rows"), "generation_s BIGINT, place BIGINT, word STRING, cnt BIGINT", words.popular_words
    )
    return sq.run(counts, "append", sink).rows(spark).drop("batch_id")


def stream_collect_first_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first matching tweets as lines in files that roll over by bytes, read back."""
    rows = fr.joined_tweets(event_stream(spark, sf_dir), fr.table(spark, sf_dir, "documents"))
    chosen = src.tweet_filter(rows, []).select("event_id", "ts", "text")
    sink = CollectedLines(fresh_path(spark, "collected"), tw.COLLECTED, max_bytes=COLLECT_BYTES)
    parts = F.split("value", r"\|", 4)  # place, id, time, and the text with all its bars
    lines = sq.run(chosen, "append", sink).lines(spark)
    return lines.select(
        parts[1].cast("bigint").alias("event_id"), parts[0].cast("bigint").alias("pos"), F.md5(parts[3]).alias("text_md5")
    )


QUERIES = {
    f.__name__: f
    for f in (
        stream_sliding_counts, stream_restarted_counts, stream_batch_report, stream_filter_project, stream_static_join,
        stream_burst_tumbling, stream_burst_sliding, stream_late_drop, stream_asof_filter, stream_generation_pairing,
        stream_generation_totals, stream_popular_words, stream_collect_first_n,
    )
}

_SLIDING = f"""{fr.SQL_EVENTS},
copies AS (SELECT action, ts_s // 1800 * 1800 - 1800 * unnest([0, 1]) AS window_start_s FROM ev),
sliding AS (SELECT window_start_s, action, count(*) AS cnt FROM copies GROUP BY window_start_s, action)"""

_COUNTS = with_sql(
    _SLIDING, select="SELECT window_start_s, window_start_s + 3600 AS window_end_s, action, cnt FROM sliding"
)

ORACLES = {
    "stream_sliding_counts": _COUNTS,
    "stream_restarted_counts": _COUNTS,
    "stream_batch_report": with_sql(
        fr.SQL_EVENTS,
        f"""parts AS (
          SELECT action, ts_s // 1800 * 1800 - 1800 * unnest([0, 1]) AS window_start_s,
            CAST(floor((ts_s - (SELECT min(ts_s) FROM ev)) * {SLICES}
              / (SELECT max(ts_s) - min(ts_s) + 1 FROM ev)) AS BIGINT) AS part FROM ev)""",
        f"ids AS (SELECT unnest(range(0, {SLICES})) AS batch_id)",
        select="""SELECT batch_id, false AS rerun, count(DISTINCT (window_start_s, action)) AS total_size
          FROM ids JOIN parts ON part <= batch_id GROUP BY batch_id""",
    ),
    "stream_filter_project": "SELECT event_id AS user_b FROM events WHERE event_type = 'click'",
    "stream_static_join": """
      SELECT user_id AS user_a, count(*) AS cnt FROM events JOIN (
        SELECT c_custkey FROM customer WHERE c_acctbal > 3000
        UNION ALL SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') ON user_id = c_custkey
      GROUP BY user_id""",
    "stream_burst_tumbling": with_sql(
        fr.SQL_EVENTS,
        f"""w AS (
          SELECT ts_s // {DAY} * {DAY} AS window_s, action, min(ts_s) AS start_s, max(ts_s) AS end_s, count(*) AS cnt
          FROM ev GROUP BY ALL)""",
        select=f"""SELECT {BURST_COLUMNS} FROM w WHERE cnt > 65
          AND (window_s + {DAY}) * 1000 <= (SELECT max(ts_us) // 1000 FROM ev) - {BURST_DELAY_H * 3600 * 1000}""",
    ),
    "stream_burst_sliding": with_sql(
        fr.SQL_EVENTS,
        """steps AS (
          SELECT ts_s // 3600 * 3600 AS step_s, action, min(ts_s) AS start_s, max(ts_s) AS end_s, count(*) AS cnt
          FROM ev GROUP BY ALL)""",
        """w AS (
          SELECT window_s, action, min(start_s) AS start_s, max(end_s) AS end_s, sum(cnt)::BIGINT AS cnt
          FROM (SELECT *, step_s - 3600 * unnest(range(0, 60)) AS window_s FROM steps) GROUP BY window_s, action)""",
        select=f"""SELECT {BURST_COLUMNS} FROM w WHERE cnt > 130
          AND (window_s + 60 * 3600) * 1000 <= (SELECT max(ts_us) // 1000 FROM ev) - {BURST_DELAY_H * 3600 * 1000}""",
    ),
    "stream_late_drop": BURST_ORACLES["late_drop_windows"],
    "stream_asof_filter": tw.ORACLES["asof_irregular_filter"],
    "stream_generation_pairing": tw.ORACLES["generation_pairing"],
    "stream_generation_totals": with_sql(
        fr.SQL_TWEETS,
        f"days AS (SELECT ts_s // {DAY} * {DAY} AS generation_s, text FROM tweets)",
        fr.sql_tweet_words("days", "generation_s"),
        select="SELECT generation_s, word, count(*) AS cnt FROM tw GROUP BY generation_s, word",
    ),
    "stream_popular_words": tw.ORACLES["popular_words_pipeline"],
    "stream_collect_first_n": tw.ORACLES["collect_first_n"],
}

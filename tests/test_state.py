"""Stateful steps, chained aggregations and exactly-once files of streams, over several micro-batches and restarts."""

import datetime as dt
import random
import time
from bisect import bisect_right
from collections import Counter

from pyspark.sql import functions as F

from rivulet.operators import bursts, control, words
from rivulet.plans import jobs
from rivulet.runtime import fresh_path
from rivulet.streaming import queries as sq
from rivulet.streaming import state
from rivulet.streaming.sinks import BatchTable, CollectedLines, LateDropWindows, LineFiles, ReportSink

START = 1_340_000_000
ROWS = "event_id BIGINT, ts TIMESTAMP, friends_count INT, note STRING"
MARKS = "generation_s BIGINT, thresholds ARRAY<INT>"
FAR = START + 10_000_000


def when(second):
    return dt.datetime.fromtimestamp(second, dt.timezone.utc)


class Folder:
    """A folder that grows by one file at a time, and the stream over it."""

    def __init__(self, spark, path, schema):
        self.spark, self.path, self.schema = spark, str(path), schema

    def add(self, rows):
        self.spark.createDataFrame(rows, self.schema).coalesce(1).write.mode("append").parquet(self.path)

    def stream(self):
        return self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1).parquet(self.path)


def asof(rows, marks):
    """``event_id, generation`` by looking every row up."""
    ticks = sorted(t for t, v in marks if v is not None)
    value = dict(marks)
    out = []
    for i, ts, friends, note in rows:
        if i is None or ts is None:
            continue
        at = ticks[max(0, bisect_right(ticks, int(ts.timestamp())) - 1)]
        out.append((i, ts, friends, note, at, value[at]))
    return sorted(out)


def batches(seed):
    """Four batches of rows and irregular control rows in order of time; the first control row comes late."""
    rng = random.Random(seed)
    rows, marks = [], []
    for k in range(4):
        seconds = [START + 1000 * k + s for s in range(0, 1000, 7)]
        part = [(1000 * k + n, when(s), rng.choice([None, n % 50]), rng.choice([None, "a|b\n\"", "é"])) for n, s in enumerate(seconds)]
        rng.shuffle(part)
        rows.append(part)
        first = 400 if k == 0 else 0
        ticks = sorted(rng.sample(range(first, 1000), [3, 0, 1, 5][k]))
        marks.append([(START + 1000 * k + t, [rng.randint(5, 45)]) for t in ticks])
    rows[2].append((9999, None, 1, "no time"))
    rows.append([(None, when(FAR), None, None)])
    marks.append([(FAR, None)])
    return rows, marks


def test_asof_over_micro_batches_with_a_restart(spark, tmp_path):
    rows, marks = batches(1)
    events, control = Folder(spark, tmp_path / "rows", ROWS), Folder(spark, tmp_path / "marks", MARKS)
    checkpoint, sink = fresh_path(spark, "ckpt"), None
    for upto in ((0, 2), (2, 5)):  # stops after two batches and resumes
        for k in range(*upto):
            events.add(rows[k])
            control.add(marks[k])
        found = state.asof_latest(events.stream(), control.stream(), "thresholds", salts=3)
        sink = sink or BatchTable(fresh_path(spark, "rows"), ROWS + ", " + MARKS)
        sq.run(found, "append", sink, checkpoint)
    got = sink.rows(spark)
    assert got.select("batch_id").distinct().count() >= 4
    plain = [tuple(r)[:6] for r in got.where("event_id IS NOT NULL").collect()]
    as_utc = sorted((i, t.astimezone(dt.timezone.utc), f, n, g, list(v)) for i, t, f, n, g, v in plain)
    assert as_utc == asof(sum(rows, []), sum(marks, []))


def test_accepted_rows_filter_and_pass_heartbeats(spark, tmp_path):
    rows, marks = batches(2)
    events, control = Folder(spark, tmp_path / "rows", ROWS), Folder(spark, tmp_path / "marks", MARKS)
    for r, m in zip(rows, marks, strict=True):
        events.add(r)
        control.add(m)
    found = sq.accepted_rows(events.stream(), control.stream(), salts=2)
    path = fresh_path(spark, "published")
    sq.publish(found, path).awaitTermination()
    got = spark.read.parquet(path)
    assert [r["generation_s"] for r in got.where("event_id IS NULL").collect()] == [FAR]
    want = [(i, g) for i, _, f, _, g, v in asof(sum(rows, []), sum(marks, [])) if f is not None and f < v[0]]
    assert sorted((r["event_id"], r["generation_s"]) for r in got.where("event_id IS NOT NULL").collect()) == want


def test_queues_pair_in_order_whichever_comes_first(spark, tmp_path):
    rows = Folder(spark, tmp_path / "rows", "event_id BIGINT, generation_s BIGINT")
    offers = Folder(spark, tmp_path / "offers", "generation_s BIGINT, tags ARRAY<STRING>")
    checkpoint, sink = fresh_path(spark, "ckpt"), BatchTable(fresh_path(spark, "rows"), "generation_s BIGINT, tick_s BIGINT, tags ARRAY<STRING>")

    def run():
        pairs = state.pair_generations(rows.stream(), offers.stream(), salts=2)
        sq.run(pairs, "append", sink, checkpoint)
        return sorted((r["generation_s"], r["tick_s"], r["tags"]) for r in sink.rows(spark).collect())

    rows.add([(i, 10 * (i % 3)) for i in range(50)])  # generations 0, 10, 20 before any offer
    offers.add([(7, ["a"])])
    assert run() == [(0, 7, ["a"])]
    offers.add([(9, ["c"]), (8, ["b"]), (11, [])])  # one more than there are generations
    rows.add([(99, 20), (None, 500)])
    assert run() == [(0, 7, ["a"]), (10, 8, ["b"]), (20, 9, ["c"]), (500, 500, None)]
    rows.add([(100, 40), (101, 30)])
    assert run()[3:] == [(30, 11, []), (500, 500, None)]


def test_flushes_first_then_each_generation_once(spark, tmp_path):
    tweets = Folder(spark, tmp_path / "rows", "ts TIMESTAMP, text STRING")
    rng, truth = random.Random(4), Counter()
    begin = START // 600 * 600
    for k in range(4):
        part = [(when(begin + 450 * k + rng.randrange(450)), rng.choice(["one two", "two the", "three"])) for _ in range(60)]
        tweets.add(part)
        for ts, text in part:
            truth.update((int(ts.timestamp()) // 600 * 600, w) for w in text.split() if w != "the")
    tweets.add([(when(begin + 36_000), None)])
    totals = sq.flushed_totals(tweets.stream(), ["the"], "60 seconds", "600 seconds", "100 seconds")
    sink = sq.run(totals, "append", BatchTable(fresh_path(spark, "rows"), "generation_s BIGINT, word STRING, cnt BIGINT"))
    rows = sink.rows(spark).collect()
    assert {(r["generation_s"], r["word"]): r["cnt"] for r in rows} == truth and len(rows) == len(truth)
    assert max(Counter(g for g, _ in {(r["generation_s"], r["batch_id"]) for r in rows}).values()) == 1
    assert len({r["batch_id"] for r in rows}) > 1
    flushes = sq.flushed_totals(tweets.stream(), ["the"], "60 seconds", "600 seconds", count_flushes=True)
    counted = sq.run(flushes, "append", BatchTable(fresh_path(spark, "rows"), "generation_s BIGINT, word STRING, cnt BIGINT"))
    assert max(r["cnt"] for r in counted.rows(spark).collect()) <= 10


def test_topology_over_several_micro_batches(spark, tmp_path):
    accepted = Folder(spark, tmp_path / "rows", "event_id BIGINT, ts TIMESTAMP, doc_id BIGINT, generation_s BIGINT")
    pairs = Folder(spark, tmp_path / "pairs", "generation_s BIGINT, tick_s BIGINT, tags ARRAY<STRING>")
    texts = spark.createDataFrame([(0, "Click one"), (1, "view two two"), (2, "nothing")], "doc_id BIGINT, text STRING")
    for k in range(3):
        accepted.add([(100 * k + i, when(START + 100 * k + i), i % 3, START + 100 * k) for i in range(30)])
    pairs.add([(START, 7, ["cli"])])
    pairs.add([(START + 100, 8, ["vie", "view"]), (START + 200, 9, ["zzz"])])
    accepted.add([(None, when(FAR), -1, FAR)])
    pairs.add([(FAR, FAR, None)])
    counts = sq.tagged_words(accepted.stream(), pairs.stream(), texts, [], 10, salts=2)
    sink = sq.run(counts, "append", BatchTable(fresh_path(spark, "rows"), "generation_s BIGINT, word STRING, cnt BIGINT"))
    got = sorted((r["generation_s"], r["word"], r["cnt"]) for r in sink.rows(spark).collect())
    assert got == [(7, "click", 10), (7, "one", 10), (8, "two", 20), (8, "view", 10)]


# --- late rows ---------------------------------------------------------------------------------------

ARRIVALS = "event_id BIGINT, action STRING, ts_s BIGINT, arrival BIGINT"


def arrivals(seed, n=400):
    rng = random.Random(seed)
    return [(i, rng.choice("ab"), 5000 + i * 3 - rng.choice([0, 0, 50, 200, 900]), i // 2) for i in range(n)]


def test_late_rows_are_told_record_by_record_across_batches(spark, tmp_path):
    rows = arrivals(1)
    folder = Folder(spark, tmp_path / "rows", ARRIVALS)
    for k in range(4):
        folder.add(rows[100 * k : 100 * (k + 1)])
    sink = LateDropWindows(fresh_path(spark, "late"), 100, 60, ["arrival", "event_id"])
    sq.run(folder.stream(), "append", sink)
    table = spark.createDataFrame(rows, ARRIVALS)
    whole = bursts.late_drop_windows(table, 100, 60, ["arrival", "event_id"])
    want = sorted(map(tuple, whole.collect()))
    assert sorted(map(tuple, sink.windows(spark).collect())) == want
    assert sum(r[3] for r in want) < len(rows)
    last = max(r[2] for r in rows)
    closed = [w for w in want if (w[0] + 60) * 1000 - 1 <= (last - 100) * 1000]
    assert sorted(map(tuple, sink.windows(spark, closed=True).collect())) == closed and len(closed) < len(want)
    sink(spark.createDataFrame(rows[300:], ARRIVALS), 3)  # the batch runs again after a failure
    assert sorted(map(tuple, sink.windows(spark).collect())) == want


def test_panes_are_built_before_rows_are_copied(spark):
    rows = spark.range(1000).select(F.timestamp_seconds(F.col("id") + START).alias("ts"), F.lit("MT").alias("action"))
    found = sq.bursts(rows, "60 seconds", "0 seconds", 59, "1 second")
    lines = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
    expands = [i for i, line in enumerate(lines) if "Expand" in line or "Generate" in line]
    aggregates = [i for i, line in enumerate(lines) if "Aggregate" in line]
    assert len(aggregates) == 2 and expands and max(expands) < aggregates[-1]  # plans are printed from the top
    assert {r["cnt"] for r in found.collect()} == {60} and found.count() == 1000 - 59


# --- files ---------------------------------------------------------------------------------------------

def test_lines_roll_over_by_bytes_and_reruns_leave_none_double(spark):
    sink = LineFiles(fresh_path(spark, "lines"), ["id"], max_bytes=100)
    batch = spark.range(50).select("id", F.concat(F.lit("text\n|"), F.repeat(F.lit("x"), (F.col("id") % 7).cast("int"))).alias("text"))
    assert sink.lines(spark).count() == 0
    sink(batch, 0)
    sink(batch.where("id < 20"), 0)
    sink(batch.where("id >= 20"), 1)
    sink(batch.limit(0), 2)
    rows = sink.lines(spark).collect()
    assert sorted(int(r["value"].split("|")[0]) for r in rows) == list(range(50))
    assert all(r["value"].split("|")[1] == "text " for r in rows)
    for batch_id in (0, 1):
        files = {}
        for r in rows:
            if r["batch_id"] == batch_id:
                files.setdefault(r["file"], []).append(r["value"])
        assert len(files) > 2 and sorted(files) == list(range(len(files)))
        sizes = [sum(len(v) + 1 for v in files[f]) for f in sorted(files)]
        assert all(size < 100 + 20 for size in sizes) and all(size >= 80 for size in sizes[:-1])
        assert [int(v.split("|")[0]) for f in sorted(files) for v in files[f]] == sorted(int(v.split("|")[0]) for f in files.values() for v in f)
    assert sorted((c["batch_id"], c["n_lines"]) for c in sink.commits(spark).collect()) == [(0, 20), (1, 30), (2, 0)]


def test_a_batch_without_its_commit_does_not_count(spark):
    path = fresh_path(spark, "lines")
    sink = LineFiles(path, ["id"])
    sink(spark.range(5), 0)
    spark.range(3).selectExpr("cast(id as string) AS value", "0 AS file").write.partitionBy("file").text(f"{path}/lines/batch_id=1")
    assert sink.lines(spark).count() == 5


def test_collected_lines_stop_at_n_and_survive_a_rerun(spark):
    sink = CollectedLines(fresh_path(spark, "lines"), 12)

    def batch(first, n):
        return spark.range(first, first + n).select(F.col("id").alias("event_id"), F.timestamp_seconds(F.col("id") + START).alias("ts"))

    sink(batch(0, 8), 0)
    assert not sink.full
    sink(batch(100, 8), 1)
    sink(batch(100, 8), 1)
    assert sink.full
    sink(batch(200, 8), 2)
    got = sorted((int(p), int(i)) for p, i in (r["value"].split("|")[:2] for r in sink.lines(spark).collect()))
    assert got == list(enumerate([*range(8), 100, 101, 102, 103], 1)) and sink.full


def test_reports_know_reruns_after_a_restart(spark):
    path = fresh_path(spark, "report")
    ReportSink(path, "id BIGINT")(spark.range(3), 0)
    again = ReportSink(path, "id BIGINT")
    again(spark.range(2), 0)
    again(spark.range(2), 1)
    assert sorted((r["batch_id"], r["rerun"]) for r in again.reports(spark).collect()) == [(0, True), (1, False)]


# --- jobs ------------------------------------------------------------------------------------------------

TWEETS = "event_id BIGINT, ts TIMESTAMP, text STRING, friends_count INT, lang STRING"


def tweet_folders(spark, tmp_path):
    rng = random.Random(11)
    tweets, levels, tags = (Folder(spark, tmp_path / n, s) for n, s in (("tweets", TWEETS), ("levels", MARKS), ("tags", "generation_s BIGINT, tags ARRAY<STRING>")))
    rows = []
    for k in range(4):
        part = [(100 * k + i, when(START + 100 * k + i), f"Click word{rng.randrange(4)} view w{i % 3}", rng.randrange(50), "en") for i in range(60)]
        rows += part
        tweets.add(part)
        levels.add([(START + 100 * k, [25])])
        tags.add([(START + 100 * k, [["cli"], ["zzz"], ["word1", "w2"], ["view"]][k])])
    tweets.add([(None, when(FAR), None, None, None)])
    levels.add([(FAR, None)])
    return rows, tweets, levels, tags


def test_popular_words_job_runs_side_by_side_and_goes_on(spark, tmp_path):
    rows, tweets, levels, tags = tweet_folders(spark, tmp_path)
    offered = [["cli"], ["zzz"], ["word1", "w2"], ["view"]]
    folder = fresh_path(spark, "topology")

    def want():
        table = spark.createDataFrame(rows, TWEETS).withColumn("ts_s", F.unix_seconds("ts"))
        times = sorted({r[1].timestamp() // 100 * 100 for r in rows})
        marks = spark.createDataFrame([(int(t), [25]) for t in times], MARKS)
        offers = spark.createDataFrame([(int(t), tags) for t, tags in zip(times, offered)], "generation_s BIGINT, tags ARRAY<STRING>")
        popular, _ = words.popular_words_pipeline(control.asof_latest(table, marks, "thresholds"), offers, ["view"])
        return sorted((r["generation_s"], r["place"], r["word"], r["cnt"]) for r in popular.collect())

    def run_until(expected):
        queries = jobs.popular_words_stream_job(
            tweets.stream(), levels.stream(), tags.stream(), ["view"], folder, 30, trigger={"processingTime": "100 milliseconds"}
        )
        deadline, got = time.time() + 240, []
        while len(got) < len(expected) and time.time() < deadline and all(q.isActive for q in queries):
            time.sleep(1)
            got = jobs.popular_table(folder).rows(spark).collect()
        for query in queries:
            query.stop()
        assert sorted((r["generation_s"], r["place"], r["word"], r["cnt"]) for r in got) == expected

    run_until(want())
    late = FAR + 1000  # a generation after the heartbeat, and a second heartbeat
    part = [(900 + i, when(late + i), "word9 one", 3, "en") for i in range(5)]
    rows.extend(part)
    offered.append(["ord9"])
    tweets.add(part)
    levels.add([(late, [25])])
    tags.add([(late, ["ord9"])])
    tweets.add([(None, when(late + 9000), None, None, None)])
    levels.add([(late + 9000, None)])
    run_until(want())


def test_collect_job_stops_when_it_has_enough(spark, tmp_path):
    rows, tweets, _, _ = tweet_folders(spark, tmp_path)
    query, sink = jobs.collect_stream_job(tweets.stream(), fresh_path(spark, "collected"), ["click word1"], 20, 200, trigger={"processingTime": "100 milliseconds"})
    sink.drain(query)
    assert not query.isActive
    wanted = [r[0] for r in rows if "word1" in r[2]][:20]
    lines = sink.lines(spark).collect()
    assert sorted(int(r["value"].split("|")[1]) for r in lines) == wanted and len({(r["batch_id"], r["file"]) for r in lines}) > 2

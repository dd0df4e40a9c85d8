import datetime as dt
import os
import random

from pyspark.sql import functions as F

from rivulet.operators import bursts
from rivulet.plans import frames as fr
from rivulet.plans import streams
from rivulet.runtime import fresh_path
from rivulet.sources.files import action_stream, id_list
from rivulet.streaming import queries as sq
from rivulet.streaming.sinks import BatchTable, FirstRows, ReportSink

START = dt.datetime(2012, 7, 1)
COUNTS = "window_start TIMESTAMP, window_end TIMESTAMP, action STRING, cnt BIGINT"


def lines(first, n, seed):
    rng = random.Random(seed)
    out = []
    for i in range(first, first + n):
        when = START + dt.timedelta(seconds=i * 20)
        out.append(f"{rng.randrange(5)},{i},{when:%Y-%m-%d %H:%M:%S},{rng.choice(['MT', 'RT', 'RE'])}")
    return out


def add_file(folder, name, first, n, seed=1):
    (folder / name).write_text("\n".join(lines(first, n, seed)) + "\n")


def actions(spark, folder, per_trigger=None):
    stream = action_stream(spark, str(folder), per_trigger)
    return stream.select(
        F.col("userA").alias("user_a"), F.col("userB").alias("user_b"), F.col("timestamp").alias("ts"), "action"
    )


def batch_actions(spark, folder):
    rows = spark.read.schema("user_a BIGINT, user_b BIGINT, ts TIMESTAMP, action STRING").csv(str(folder))
    return rows


def test_checkpointed_counts_resume_after_new_files(spark, tmp_path):
    add_file(tmp_path, "a.csv", 0, 300)
    checkpoint, path = fresh_path(spark, "ckpt"), fresh_path(spark, "rows")
    sink = ReportSink(path, COUNTS)
    sq.run(sq.sliding_counts(actions(spark, tmp_path)), "complete", sink, checkpoint)
    add_file(tmp_path, "b.csv", 300, 200, seed=2)
    sq.run(sq.sliding_counts(actions(spark, tmp_path)), "complete", sink, checkpoint)
    got = sorted(map(tuple, sink.latest(spark).collect()))
    expected = sq.sliding_counts(batch_actions(spark, tmp_path)).collect()
    assert got == sorted(map(tuple, expected))
    assert sum(r[3] for r in got) == 2 * 500
    reports = sink.reports(spark).orderBy("batch_id").collect()
    assert [(r.batch_id, r.rerun) for r in reports] == [(0, False), (1, False)]
    assert reports[-1].total_size == len(got)


def test_rerun_of_a_batch_replaces_its_rows(spark):
    sink = ReportSink(fresh_path(spark, "rows"), "id BIGINT")
    sink(spark.range(5), 0)
    sink(spark.range(3), 0)
    assert sink.rows(spark).count() == 3
    (report,) = sink.reports(spark).collect()
    assert (report.batch_id, report.rerun, report.total_size) == (0, True, 3)


def test_append_filter_gives_every_row_once(spark, tmp_path):
    for k in range(3):
        add_file(tmp_path, f"{k}.csv", k * 50, 50, seed=k)
    chosen = sq.filter_project(actions(spark, tmp_path, 1))
    sink = sq.run(chosen, "append", BatchTable(fresh_path(spark, "rows"), "user_b BIGINT"))
    rows = sink.rows(spark)
    assert rows.select("batch_id").distinct().count() == 3
    expected = [r.user_b for r in batch_actions(spark, tmp_path).where("action = 'MT'").collect()]
    assert sorted(r.user_b for r in rows.collect()) == sorted(expected)


def test_static_join_repeats_listed_users(spark, tmp_path):
    (tmp_path / "in").mkdir()
    add_file(tmp_path / "in", "a.csv", 0, 100)
    (tmp_path / "ids.txt").write_text("1\n3\n3\n")
    counts = sq.static_join_counts(actions(spark, tmp_path / "in"), id_list(spark, str(tmp_path / "ids.txt")))
    sink = sq.run(counts, "complete", BatchTable(fresh_path(spark, "rows"), "user_a BIGINT, cnt BIGINT"))
    got = {r.user_a: r.cnt for r in sink.latest(spark).collect()}
    users = [r.user_a for r in batch_actions(spark, tmp_path / "in").collect()]
    assert got == {1: users.count(1), 3: 2 * users.count(3)}


def test_closed_bursts_equal_the_batch_result(spark, tmp_path):
    for k in range(3):
        add_file(tmp_path, f"{k}.csv", k * 60, 60, seed=k)
    schema = "window_s BIGINT, start_s BIGINT, end_s BIGINT, cnt BIGINT, action STRING, interval BIGINT, line STRING"
    closed = sq.bursts(actions(spark, tmp_path, 1), "10 minutes", "5 minutes", 5)
    sink = sq.run(closed, "append", BatchTable(fresh_path(spark, "rows"), schema))
    rows = batch_actions(spark, tmp_path).withColumn("ts_s", F.unix_seconds("ts"))
    newest = rows.agg(F.max("ts_s")).first()[0]
    batch = bursts.tumbling_bursts(rows, 600, 5).where(F.col("window_s") + 600 <= newest - 300)
    got = sorted(map(tuple, sink.rows(spark).drop("batch_id").collect()))
    assert got == sorted(map(tuple, batch.collect())) and got


def test_generations_are_reported_once_and_whole(spark, tmp_path):
    for k in range(3):
        add_file(tmp_path, f"{k}.csv", k * 60, 60, seed=k)
    tweets = actions(spark, tmp_path, 1).select("ts", F.concat_ws(" ", "action", F.lit("word the")).alias("text"))
    counts = sq.generation_counts(tweets, ["the"], "10 minutes")
    sink = sq.run(counts, "append", BatchTable(fresh_path(spark, "rows"), "generation_s BIGINT, word STRING, cnt BIGINT"))
    rows = sink.rows(spark)
    per_word = rows.groupBy("generation_s").agg(
        F.sum(F.when(F.col("word") == "word", F.col("cnt"))).alias("n"), F.countDistinct("batch_id").alias("batches")
    )
    got = [(r.n, r.batches) for r in per_word.collect()]
    assert got and all(n == 30 and batches == 1 for n, batches in got)


def test_stream_of_control_rows_joins_by_tick(spark, tmp_path):
    tweets, control = tmp_path / "tweets", tmp_path / "control"
    tweets.mkdir(), control.mkdir()
    add_file(tweets, "a.csv", 0, 90)
    first = int(START.replace(tzinfo=dt.timezone.utc).timestamp())
    ticks = [first + 30 * k for k in range(40)]
    (control / "c.csv").write_text("\n".join(f"{t},{t % 7}" for t in ticks) + "\n")
    levels = spark.readStream.schema("generation_s BIGINT, threshold INT").csv(str(control))
    joined = sq.control_join(actions(spark, tweets).select("user_b", "ts"), levels)
    joined = joined.select("user_b", "generation_s", "threshold")
    schema = "user_b BIGINT, generation_s BIGINT, threshold INT"
    rows = sq.run(joined, "append", BatchTable(fresh_path(spark, "rows"), schema)).rows(spark).drop("batch_id")
    expected = [(i, first + i * 20 // 30 * 30) for i in range(90) if i * 20 < 40 * 30]
    assert sorted(map(tuple, rows.collect())) == [(i, g, g % 7) for i, g in expected]


def test_stream_stops_after_n_rows(spark, tmp_path):
    for k in range(4):
        add_file(tmp_path, f"{k}.csv", k * 50, 50, seed=k)
        os.utime(tmp_path / f"{k}.csv", (1_000_000_000 + k, 1_000_000_000 + k))  # the order files are read in
    stream = actions(spark, tmp_path, 1).select(F.col("user_b").alias("event_id"), "ts")
    sink = FirstRows(fresh_path(spark, "rows"), "event_id BIGINT, ts TIMESTAMP", 70)
    query = sq.start(stream, "append", sink, trigger={"processingTime": "200 milliseconds"})
    sink.drain(query)
    assert not query.isActive and sink.full
    assert sorted(r.event_id for r in sink.rows(spark).collect()) == list(range(70))


def test_events_without_a_time_and_several_files(spark, tmp_path):
    rows = [(i, None if i % 5 == 0 else START + dt.timedelta(hours=i), i % 3, ["click", "view"][i % 2], 1.0, "{}") for i in range(200)]
    # nearly all in a short time, so that some slices hold fewer rows than there are files
    rows += [(200 + i, START + dt.timedelta(hours=4, seconds=i), i % 3, "click", 1.0, "{}") for i in range(300)]
    rows += [(500, START + dt.timedelta(hours=2000), 1, "click", 1.0, "{}")]
    for k in range(3):
        spark.createDataFrame(rows[k::3], fr.EVENTS_SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/events.parquet")
    customers = [(1, 4000.0, "BUILDING"), (2, 1.0, "BUILDING")]
    spark.createDataFrame(customers, "c_custkey BIGINT, c_acctbal DOUBLE, c_mktsegment STRING").write.parquet(f"{tmp_path}/customer.parquet")
    chosen = [r["user_b"] for r in streams.stream_filter_project(spark, str(tmp_path)).collect()]
    assert sorted(chosen) == [r[0] for r in rows if r[3] == "click"]
    counts = {r["user_a"]: r["cnt"] for r in streams.stream_static_join(spark, str(tmp_path)).collect()}
    assert counts == {1: 2 * sum(r[2] == 1 for r in rows), 2: sum(r[2] == 2 for r in rows)}
    assert [r["batch_id"] for r in streams.stream_batch_report(spark, str(tmp_path)).orderBy("batch_id").collect()] == [0, 1, 2, 3]

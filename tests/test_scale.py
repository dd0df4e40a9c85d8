"""What findings about time, disk and memory asked for: properties of plans and of what a step holds."""

import datetime as dt
import pickle
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from oracle import connect, differences
from rivulet.operators import graph, linalg, overlap
from rivulet.plans import frames as fr
from rivulet.plans import streams
from rivulet.plans import tweets as tw
from rivulet.runtime import fresh_path, shared_folder, subfolders
from rivulet.streaming import queries as sq
from rivulet.streaming.sinks import BatchTable
from rivulet.streaming.state import LatestControl


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_bitmap_of_neighbours_is_shuffled(spark):
    rows = [(i, [f"w{i % 3}", "hot", f"own{i}"]) for i in range(0, 400, 10)]
    members = overlap.word_sets(spark.createDataFrame(rows, "id BIGINT, words ARRAY<STRING>"))
    degrees = overlap.overlap_degrees(members)
    assert "bitmap" not in plan_of(degrees)
    assert {r.id: r.degree for r in degrees.collect()} == {i: 39 for i in range(0, 400, 10)}


def test_a_text_is_cut_before_its_words_are_given_out(spark, tmp_path):
    spark.createDataFrame([(1, "a b a")], "doc_id BIGINT, text STRING").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1)], "doc_id BIGINT, quality INT").write.parquet(f"{tmp_path}/labels.parquet")
    examples = fr.word_examples(spark, str(tmp_path))
    above, generate, below = plan_of(examples).partition("Generate explode")
    assert generate and "regexp_replace" in below and "regexp_replace" not in above
    assert sorted(examples.first().value) == pytest.approx([1 / 3, 2 / 3])


def test_strips_need_no_call_each(spark):
    rng = np.random.default_rng(4)
    matrix = np.zeros((300, 300))
    matrix[:40, :40] = rng.integers(1, 9, (40, 40))  # filled strips, beside ones with a few cells
    for _ in range(900):
        matrix[rng.integers(300), rng.integers(300)] = 1.5
    cells = [(int(i), int(j), float(matrix[i, j])) for i, j in zip(*np.nonzero(matrix))]
    df = spark.createDataFrame(cells, "i BIGINT, j BIGINT, v DOUBLE")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "17")  # strips go on in the next batch
    try:
        trace = linalg.strip_trace(df, 20, 5 * 2 * 8 * 20)
        assert "InPandas" not in plan_of(trace)
        assert trace.first().trace == pytest.approx(np.trace(matrix @ matrix))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_a_strip_with_a_null_adds_nothing(spark):
    df = spark.createDataFrame([(0, 0, 2.0), (5, 5, None), (5, 6, 1.0), (6, 5, 1.0), (9, 9, 3.0)], "i BIGINT, j BIGINT, v DOUBLE")
    assert linalg.strip_trace(df, 4, 2 * 8 * 4).first().trace == pytest.approx(2.0 * 2.0 + 3.0 * 3.0 + 1.0)


def test_a_rank_step_sorts_no_edges(spark):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    prepared = graph.RankEdges(spark.createDataFrame([(1, 2), (2, 3), (3, 2), (9, 2)], "src BIGINT, dst BIGINT"))
    try:
        ranks = prepared.table.select(F.col("src").alias("id")).distinct().withColumn("rank", F.lit(1.0))
        step = plan_of(prepared.contributions(ranks))
        assert "ShuffledHashJoin" in step and "Sort" not in step
        prepared.keep_sources(spark.createDataFrame([(2,), (3,)], "id BIGINT"))
        assert sorted(r.src for r in prepared.table.collect()) == [2, 3]
    finally:
        prepared.close()
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


class _Value:
    def __init__(self):
        self.row = None

    def exists(self):
        return self.row is not None

    def get(self):
        return self.row

    def update(self, row):
        self.row = row


class _Map(dict):
    def getValue(self, key):
        return self[key]

    def updateValue(self, key, value):
        self[key] = value

    def removeKey(self, key):
        del self[key]


def test_waiting_rows_are_read_piece_by_piece():
    timers = []
    handle = SimpleNamespace(
        getMapState=lambda *_: _Map(), getValueState=lambda *_: _Value(), registerTimer=timers.append, getListState=lambda *_: None
    )
    frame = lambda us, control: pd.DataFrame({"us": us, "is_control": control, "packed": [f"r{u}" for u in us]})
    at = lambda ms: SimpleNamespace(getCurrentWatermarkInMs=lambda: ms)
    state = LatestControl()
    state.init(handle)
    rows = [frame([5000, 1000], False), frame([2000, 900_000], False), frame([1500, 4000], True), frame([4000], True).assign(packed="new")]
    list(state.handleInputRows((0,), iter(rows), at(0)))
    assert len(state.waiting) == 2 and max(len(pickle.loads(v[0])[0]) for v in state.waiting.values()) == 2
    given = list(state.handleExpiredTimer((0,), at(10), None))
    assert [g["packed"].tolist() for g in given] == [["r5000", "r1000"], ["r2000"]]
    assert [g["held"].tolist() for g in given] == [["new", "r1500"], ["r1500"]]
    assert [k[0] for k in state.waiting] == [900_000] and timers[-1] == 900
    assert list(state._controls()[0]) == [4000]


@pytest.mark.parametrize("key", ["generation_word_counts", "generation_word_totals", "popular_words", "popular_words_pipeline"])
def test_words_are_counted_where_they_are_cut(spark, tmp_path, key):
    texts = ["cli view the storm Storm", "view vie http://x @cli view", None, "cli  é b-2 cli\tview"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING").selectExpr("*", "'en' AS lang").write.parquet(f"{tmp_path}/documents.parquet")
    start = dt.datetime(2024, 1, 1)
    events = [(i, start + dt.timedelta(hours=i), 1, ["click", "view", "view"][i % 3], float(i % 7), "{}") for i in range(240)]
    spark.createDataFrame(events, fr.EVENTS_SCHEMA).write.parquet(f"{tmp_path}/events.parquet")
    found = tw.QUERIES[key](spark, str(tmp_path))
    if key in ("generation_word_counts", "generation_word_totals"):
        assert plan_of(found).count("ArrowEvalPython [_word_times") == 1 and "explode(split" not in plan_of(found)
    assert differences(found, connect(str(tmp_path)), tw.ORACLES[key]) is None


def test_streams_count_words_where_they_are_cut(spark, tmp_path):
    def stream(name, schema):
        (tmp_path / name).mkdir()
        return spark.readStream.schema(schema).parquet(str(tmp_path / name))

    tweets = stream("tweets", "ts TIMESTAMP, text STRING")
    rows = stream("rows", "event_id BIGINT, ts TIMESTAMP, text STRING, generation_s BIGINT")
    pairs = stream("pairs", "generation_s BIGINT, tick_s BIGINT, tags ARRAY<STRING>")
    for counts in (sq.generation_counts(tweets, []), sq.flushed_totals(tweets, []), sq.tagged_words(rows, pairs, None, [])):
        plan = counts._jdf.queryExecution().analyzed().toString()
        assert "_word_times(" in plan and "explode(split" not in plan


def test_tweets_of_a_task_come_in_order_of_time(spark, tmp_path):
    spark.range(40).selectExpr("id AS doc_id", "concat('w', id) AS text", "'en' AS lang").write.parquet(f"{tmp_path}/documents.parquet")
    start = dt.datetime(2024, 1, 1)
    events = [(i, start + dt.timedelta(hours=i * 67 % 240), 1, "view", 1.0, "{}") for i in range(240)]
    spark.createDataFrame(events, fr.EVENTS_SCHEMA).write.parquet(f"{tmp_path}/events.parquet")
    tweets = fr.tweets(spark, str(tmp_path))
    tasks = tweets.groupBy(F.spark_partition_id()).agg(F.collect_list("ts_s").alias("t")).collect()
    assert sum(len(r.t) for r in tasks) == 240 and max(len(r.t) for r in tasks) > 6  # a document comes six times
    assert all(r.t == sorted(r.t) for r in tasks)


def test_words_of_generations_are_shuffled_once(spark, tmp_path):
    spark.createDataFrame([(0, "storm rain storm", "en")], "doc_id BIGINT, text STRING, lang STRING").write.parquet(f"{tmp_path}/documents.parquet")
    events = [(i, dt.datetime(2024, 1, 1 + i), 1, "view", float(i % 2), "{}") for i in range(9)]
    spark.createDataFrame(events, fr.EVENTS_SCHEMA).write.parquet(f"{tmp_path}/events.parquet")
    totals = tw.generation_word_totals(spark, str(tmp_path))
    shuffles = [line for line in plan_of(totals).splitlines() if "Exchange hashpartitioning(generation_s" in line]
    assert len(shuffles) == 1 and "flush" not in shuffles[0]
    assert differences(totals, connect(str(tmp_path)), tw.ORACLES["generation_word_totals"]) is None


def test_neighbours_meet_without_a_shuffle_of_their_words(spark):
    df = spark.createDataFrame([(i, [f"w{i % 3}", f"own{i}"]) for i in range(40)], "id BIGINT, words ARRAY<STRING>")
    sums = plan_of(overlap._tiles(overlap.word_sets(df), "word", overlap._Sums))
    assert "CartesianProduct" in sums and "Exchange" not in sums
    assert {r.avg_words for r in overlap.neighborhood_avg_words(df).collect()} == {2.0}


def test_degrees_shuffle_their_sums_only(spark):
    df = spark.createDataFrame([(i, [f"w{i % 3}", "hot", "hot"][: 1 + i % 3]) for i in range(30)], "id BIGINT, words ARRAY<STRING>")
    degrees = overlap.overlap_degrees(overlap.word_sets(df))
    assert "CartesianProduct" in plan_of(degrees) and plan_of(degrees).count("Exchange") == 1
    assert overlap.most_popular_vertex(df).first()[:] == (2, 19, 3)


def test_chunks_of_any_kind_link_as_pairs_do():
    rng = np.random.default_rng(7)

    def chunk(first, size, words):
        always = [[0, 1], [0], [2]] if first == 0 else [[0], [1]]
        nos = [np.unique([*rng.integers(3, 4000, words), *always[i % len(always)]]) for i in range(size)]
        ids, values = np.arange(first, first + size), rng.integers(0, 300, size)
        batch = overlap._packed(ids, values, np.array([len(n) for n in nos]), np.concatenate(nos).astype(np.int32))
        columns = [np.frombuffer(c[0].as_buffer(), t) for c, t in zip(batch.columns, overlap._TYPES)]
        return overlap._Chunk(*columns), [set(n.tolist()) for n in nos]

    (a, a_sets), (b, b_sets) = chunk(0, 150, 3), chunk(1000, 700, 60)
    expected = np.array([[bool(x & y) for y in b_sets] for x in a_sets])
    assert 0.1 < expected.mean() < 1 and expected.all(axis=1).any()
    for light in (None, 0, 3, 10_000):
        found = np.zeros_like(expected)
        for places, bits in overlap._linked(a, b, light):
            found[places] = np.unpackbits(bits.view(np.uint8), axis=1, bitorder="little")[:, :700]
        assert (found == expected).all()
        sums = overlap._Sums()
        assert not list(sums.add((1, 2), (a, b), light))
        mine, theirs = sums.end()
        assert mine.column("n").to_pylist() == expected.sum(axis=1).tolist()
        assert mine.column("total").to_pylist() == (expected @ b.values).tolist()
        assert theirs.column("n").to_pylist() == expected.sum(axis=0).tolist()
        assert theirs.column("total").to_pylist() == (a.values @ expected).tolist()


def test_a_stream_run_to_its_end_leaves_no_state(spark, tmp_path):
    start = dt.datetime(2024, 1, 1)
    rows = [(i, start + dt.timedelta(hours=i), 1, "view", 1.0, "{}") for i in range(60)]
    spark.createDataFrame(rows, fr.EVENTS_SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    stream = streams.event_stream(spark, str(tmp_path), True, per_slice=8)
    before = set(subfolders(spark, shared_folder(spark)))
    keys = ["spark.sql.classic.shuffleDependency.fileCleanup.enabled", "spark.sql.streaming.minBatchesToRetain"]
    held = [spark.conf.get(key) for key in keys]
    counts = stream.withWatermark("ts", "0 seconds").groupBy(F.window("ts", "1 day").alias("w")).count().select("count")
    sink = sq.run(counts, "append", BatchTable(fresh_path(spark, "rows"), "count BIGINT"))
    assert sorted(r["count"] for r in sink.rows(spark).collect()) == [12, 24, 24]
    assert len(sink.batches(spark)) >= 9  # eight slices of eight events at most, and the heartbeats
    left = set(subfolders(spark, shared_folder(spark))) - before
    assert not [name for name in left if name.startswith(("stream-state", "event-dealt"))]
    assert [spark.conf.get(key) for key in keys] == held

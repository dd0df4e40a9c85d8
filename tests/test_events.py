import random

import pytest

from rivulet.operators import bursts, control, counters


def arrivals(spark, n=400, seed=2):
    rng = random.Random(seed)
    rows = [(i, i, max(0, i * 3 - rng.randrange(400)), rng.choice("ab")) for i in range(n)]
    return rows, spark.createDataFrame(rows, "arrival BIGINT, event_id BIGINT, ts_s BIGINT, action STRING")


def kept_rows(rows, delay, size):
    """Record by record: the watermark is the largest time so far less the delay."""
    watermark, kept = None, []
    for _, _, ts, action in rows:
        start = ts // size * size
        if watermark is None or (start + size) * 1000 - 1 > watermark:
            kept.append((start, action, ts))
        mark = (ts - delay) * 1000
        watermark = mark if watermark is None else max(watermark, mark)
    return kept


@pytest.mark.parametrize("delay", [0, 60, 200, 5000])
def test_late_rows_are_dropped_record_by_record(spark, delay):
    rows, df = arrivals(spark)
    groups = {}
    for start, action, ts in kept_rows(rows, delay, 60):
        groups.setdefault((start, action), []).append(ts)
    expected = {(w, a, min(t), max(t), len(t)) for (w, a), t in groups.items()}
    got = bursts.late_drop_windows(df, delay, 60, ["arrival", "event_id"]).collect()
    assert {(r.window_s, r.action, r.start_s, r.end_s, r.cnt) for r in got} == expected


def test_completeness_grows_with_the_delay(spark):
    rows, df = arrivals(spark)
    report = bursts.lateness_completeness(df, [30, 60, 100, 500], 60, ["arrival", "event_id"], 3)
    kept = [(r.windows_kept, r.rows_kept, r.windows_in_order) for r in report.orderBy("delay_s").collect()]
    assert kept == sorted(kept) and all(k[0] <= k[2] for k in kept)
    assert kept[-1][1] == report.first().rows_in_order


def test_sliding_equals_copying_every_row(spark):
    rows, df = arrivals(spark, 200)
    groups = {}
    for _, _, ts, action in rows:
        for start in range(ts - 59, ts + 1):
            groups.setdefault((start, action), []).append(ts)
    expected = {(w, a, min(t), max(t), len(t)) for (w, a), t in groups.items() if len(t) > 8}
    got = bursts.sliding_bursts(df, 60, 1, 8).collect()
    assert {(r.window_s, r.action, r.start_s, r.end_s, r.cnt) for r in got} == expected


def test_burst_line(spark):
    df = spark.createDataFrame([(1341377580, "RT"), (1341377639, "RT")], "ts_s BIGINT, action STRING")
    row = bursts.tumbling_bursts(df, 60, 1).first()
    assert row.line == "TimeWindow{start=1341377580, end=1341377639} interval=0 Count: 2 Type: (RT)"
    assert bursts.tumbling_bursts(df, 60, 2).count() == 0


def test_irregular_asof_join(spark):
    rng = random.Random(8)
    marks = sorted(rng.sample(range(50, 1000), 25))
    rows = [(i, rng.randrange(0, 1100)) for i in range(300)]
    control_df = spark.createDataFrame([(m, m * 2) for m in marks], "generation_s BIGINT, level BIGINT")
    df = spark.createDataFrame(rows, "event_id BIGINT, ts_s BIGINT")
    got = {r.event_id: (r.generation_s, r.level) for r in control.asof_latest(df, control_df, "level").collect()}
    latest = {i: max((m for m in marks if m <= ts), default=marks[0]) for i, ts in rows}
    assert got == {i: (m, m * 2) for i, m in latest.items()}


def test_regular_asof_join_uses_the_first_tick_for_early_rows(spark):
    ticks = spark.createDataFrame([(60, [5]), (90, [1])], "generation_s BIGINT, thresholds ARRAY<INT>")
    df = spark.createDataFrame([(1, 10, 4), (2, 95, 1), (3, 89, None), (4, 91, 0)],
                               "event_id INT, ts_s BIGINT, friends_count INT")
    joined = control.asof_regular(df, ticks, 30)
    assert sorted((r.event_id, r.generation_s) for r in joined.collect()) == [(1, 60), (2, 90), (3, 60), (4, 90)]
    assert sorted(r.event_id for r in control.threshold_filter(joined).collect()) == [1, 4]


def test_regular_asof_join_keeps_rows_after_the_last_tick(spark):
    df = spark.createDataFrame([(1, 10), (2, 95)], "event_id BIGINT, ts_s BIGINT")
    ticks = spark.createDataFrame([(0, [1]), (30, [2])], "generation_s BIGINT, thresholds ARRAY<INT>")
    got = {r.event_id: (r.generation_s, r.thresholds) for r in control.asof_regular(df, ticks, 30).collect()}
    assert got == {1: (0, [1]), 2: (30, [2])}


def test_generations_pair_in_order_and_wait(spark):
    generations = spark.createDataFrame([(30,), (10,), (10,), (20,)], "generation_s BIGINT")
    tags = spark.createDataFrame([(5, ["a"]), (7, ["b"])], "generation_s BIGINT, tags ARRAY<STRING>")
    got = control.pair_generations(generations, tags).collect()
    assert sorted((r.generation_s, r.tick_s, r.tags) for r in got) == [(10, 5, ["a"]), (20, 7, ["b"])]


def test_counters(spark):
    rows = [("h1", "cpu", 1, 5.0), ("h1", "cpu", 2, 9.0), ("h2", "cpu", 1, 1.0), ("h2", "cpu", 4, 2.5)]
    df = spark.createDataFrame(rows, "host STRING, metric STRING, t INT, value DOUBLE")
    deltas = counters.counter_deltas(df, ["t"]).orderBy("host", "t").collect()
    assert [r.delta for r in deltas] == [None, 4.0, None, 1.5]
    assert tuple(counters.counter_totals(df, ["t"]).first()) == ("cpu", 5.5, 2)

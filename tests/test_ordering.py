import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from rivulet.operators.lists import counted_values
from rivulet.operators.ordering import (
    first_rows, last_known, previous_value, running_max_before, with_position,
)


def skewed(n=900, seed=1):
    """Two thirds of the rows share the key 'hot'."""
    rng = random.Random(seed)
    return [(i, "hot" if i % 3 else f"k{rng.randrange(7)}", rng.randrange(40)) for i in range(n)]


def test_positions_equal_row_numbers_across_slices(spark):
    rows = skewed()
    df = spark.createDataFrame(rows, "id BIGINT, key STRING, v INT")
    got = {
        r.id: (r.place, r.n)
        for r in with_position(df, [F.desc("v"), "id"], ["key"], "place", size="n").collect()
    }
    expected = {}
    for key in {r[1] for r in rows}:
        group = sorted((r for r in rows if r[1] == key), key=lambda r: (-r[2], r[0]))
        expected |= {r[0]: (k, len(group)) for k, r in enumerate(group, 1)}
    assert got == expected


def test_positions_without_group(spark):
    df = spark.range(100).select((99 - F.col("id")).alias("id"))
    rows = with_position(df, ["id"], size="n").collect()
    assert sorted((r.id, r.pos, r.n) for r in rows) == [(i, i + 1, 100) for i in range(100)]


def test_running_max_before(spark):
    rows = skewed()
    df = spark.createDataFrame(rows, "id BIGINT, key STRING, v INT")
    got = {r.id: r.before for r in running_max_before(df, "v", ["id"], "before").collect()}
    best, expected = None, {}
    for i, _, v in rows:
        expected[i] = best
        best = v if best is None else max(best, v)
    assert got == expected


def test_last_known_and_previous_value(spark):
    rows = [(i, key, v if v % 11 == 0 else None, v) for i, key, v in skewed()]
    df = spark.createDataFrame(rows, "id BIGINT, key STRING, mark INT, v INT")
    got = {r.id: r.known for r in last_known(df, "mark", ["id"], "known").collect()}
    last, expected = None, {}
    for i, _, mark, _ in rows:
        last = mark if mark is not None else last
        expected[i] = last
    assert got == expected

    got = {r.id: r.prev for r in previous_value(df, "v", ["key"], ["id"], "prev").collect()}
    seen, expected = {}, {}
    for i, key, _, v in rows:
        expected[i] = seen.get(key)
        seen[key] = v
    assert got == expected


@pytest.mark.parametrize("n", [0, 1, 17, 60, 1000])
def test_first_rows(spark, n):
    df = spark.range(60).select(
        F.col("id").alias("event_id"), F.timestamp_seconds((F.col("id") * 37 % 60) * 900).alias("ts")
    )
    got = {r.event_id for r in first_rows(df, n, "ts", ["event_id"]).collect()}
    ordered = sorted(range(60), key=lambda i: (i * 37 % 60, i))
    assert got == set(ordered[:n])


def test_first_rows_takes_rows_without_a_time(spark):
    rows = [(1, None), (2, datetime(2024, 1, 1)), (3, None), (4, datetime(2024, 1, 2))]
    df = spark.createDataFrame(rows, "event_id BIGINT, ts TIMESTAMP")
    for n in range(1, 6):
        got = [r.event_id for r in first_rows(df, n, "ts", ["event_id"]).orderBy("pos").collect()]
        assert got == [1, 3, 2, 4][:n]


def test_hot_key_stays_in_long_form(spark):
    rows = [("hot", i % 50) for i in range(500)] + [("cold", 1), ("cold", 1)]
    counted = counted_values(spark.createDataFrame(rows, "key STRING, value INT"), "key", "value").collect()
    hot = [r for r in counted if r.key == "hot"]
    assert sorted((r.value, r.times, r.n_rows, r.n_values) for r in hot) == [(i, 10, 500, 50) for i in range(50)]
    assert [tuple(r)[1:] for r in counted if r.key == "cold"] == [(1, 2, 2, 1)]

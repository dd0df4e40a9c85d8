"""The complete jobs on small files."""

import pytest
from pyspark.sql import functions as F

from rivulet.plans import jobs
from rivulet.runtime import fresh_path
from rivulet.sources.files import activity, id_list
from rivulet.streaming.sinks import BatchTable


def read_lines(spark, path):
    return [r.value for r in spark.read.text(path).collect()]


def test_anagram_job(spark, tmp_path):
    (tmp_path / "w.txt").write_text("abroad\nearly\nnatured\nunrated\nlayer\naboard\nuntread\nleary\nrelay\n")
    jobs.anagram_job(spark, str(tmp_path / "w.txt"), str(tmp_path / "out"))
    lines = [
        line for part in sorted((tmp_path / "out").glob("part-*")) for line in part.read_text().splitlines()
    ]
    assert lines == ["early layer leary relay", "natured unrated untread", "aboard abroad"]


def test_pagerank_jobs(spark, tmp_path):
    (tmp_path / "e.txt").write_text("# links\n1 2\n2 3\n3 2\n")
    path = str(tmp_path / "e.txt")
    ranks = {r.id: r["rank"] for r in jobs.pagerank_job(spark, path, 2).collect()}
    assert ranks["1"] == 1.0 and set(ranks) == {"1", "2", "3"}
    rows = jobs.graph_pagerank_job(spark, path, 2).collect()
    assert len(rows) == 3 and {r.src_out_degree for r in rows} == {1}


def test_word_graph_jobs(spark, tmp_path):
    (tmp_path / "v.txt").write_text("1 apple pear fig\n2 apple\n3 plum\n")
    path = str(tmp_path / "v.txt")
    assert jobs.word_compare_job(spark, path).first().n_edges == 1
    assert jobs.most_popular_job(spark, path).first().id == 0
    assert {r.id: r.avg_words for r in jobs.average_words_job(spark, path).collect()} == {0: 1.0, 1: 3.0}
    assert {r.id: r.avg_words for r in jobs.average_words_job(spark, path, True).collect()} == {0: 2.0, 1: 4.0}


def test_action_queries(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("1,2,2012-07-01 00:02:52,MT\n1,3,2012-07-01 00:12:52,RT\n")
    (tmp_path / "ids.txt").write_text("1\n")
    schemas = {
        "sliding": "window_start TIMESTAMP, window_end TIMESTAMP, action STRING, cnt BIGINT",
        "mentions": "user_b BIGINT",
        "targets": "user_a BIGINT, cnt BIGINT",
    }
    sizes = {}
    for query, schema in schemas.items():
        sink = BatchTable(fresh_path(spark, "rows"), schema)
        jobs.action_query_job(
            spark, str(tmp_path / "in"), query, sink, fresh_path(spark, "ckpt"),
            str(tmp_path / "ids.txt"), {"availableNow": True},
        ).awaitTermination()
        sizes[query] = sink.rows(spark).count()
    assert sizes == {"sliding": 4, "mentions": 1, "targets": 1}


def test_burst_jobs(spark, tmp_path):
    rows = [f"1 {i} {1341377580 + i} RT" for i in range(60)] + ["1 99 1341377581 RT"]
    (tmp_path / "act.txt").write_text("\n".join(rows) + "\n")
    path = str(tmp_path / "act.txt")
    assert jobs.sliding_burst_job(spark, path, 60).count() == 1
    (kept,) = jobs.tumbling_burst_job(spark, path, ["user_b"], 500, 50).collect()
    assert kept.cnt == 61


def test_bad_lines_fail(spark, tmp_path):
    (tmp_path / "act.txt").write_text("1 2 x RT\n")
    (tmp_path / "ids.txt").write_text("12\nabc\n")
    with pytest.raises(Exception):
        activity(spark, str(tmp_path / "act.txt")).collect()
    with pytest.raises(Exception):
        id_list(spark, str(tmp_path / "ids.txt")).collect()


def test_tweet_jobs(spark, tmp_path):
    rows = [
        (1, 5, "storm at the #pool\nnow", "en", 10),
        (2, 6, "storm storm @x #pool", "en", 10),
        (3, 7, "calm #pool", "en", 10),
        (4, 40, "storm #pool again", "en", 100000),
        (5, 41, "storm #pool again", "fr", 1),
    ]
    df = spark.createDataFrame(rows, "event_id BIGINT, ts_s BIGINT, text STRING, lang STRING, friends_count INT")
    df = df.withColumn("ts", F.timestamp_seconds("ts_s"))
    out = {k: str(tmp_path / k) for k in ("c", "w", "t")}
    jobs.collect_tweets_job(df, out["c"], ["storm"], n=2)
    assert sorted(read_lines(spark, out["c"])) == ["storm at the #pool now", "storm storm @x #pool"]
    thresholds = spark.createDataFrame([(0, [1000]), (30, [500])], "generation_s BIGINT, thresholds ARRAY<INT>")
    tags = spark.createDataFrame([(0, ["#pool"])], "generation_s BIGINT, tags ARRAY<STRING>")
    jobs.popular_words_job(df, ["the", "at"], out["w"], out["t"], ["storm"], thresholds, tags)
    assert read_lines(spark, out["w"]) == ["0 storm"]
    assert sorted(read_lines(spark, out["t"])) == ["0|storm at the #pool now", "0|storm storm @x #pool"]


def test_logistic_job(spark, tmp_path):
    rows = [(i, 1 if i % 2 else -1, [0, 1 + i % 3], [1.0 if i % 2 else -1.0, 0.1]) for i in range(40)]
    df = spark.createDataFrame(rows, "example_id BIGINT, label BIGINT, index ARRAY<BIGINT>, value ARRAY<FLOAT>")
    df.write.parquet(str(tmp_path / "ex"))
    result = jobs.logistic_job(spark, str(tmp_path / "ex"), str(tmp_path / "ex"), 2, 2, 0.1, 0.0).first()
    assert (result.n_rows, result.n_errors) == (40, 0)

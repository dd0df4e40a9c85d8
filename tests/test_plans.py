"""Properties of physical plans and of the work folder that results cannot show."""

import re
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from rivulet import runtime
from rivulet.operators import bursts, graph, linalg
from rivulet.plans import frames as fr
from rivulet.plans import tweets as tw

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def read_columns(df):
    return set(re.findall(r"ReadSchema: struct<([^>]*)>", plan_of(df)))


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_rank_step_shuffles_only_the_contributions(spark, no_broadcast):
    prepared = graph.RankEdges(fr.links(spark, SF_DIR))
    ranks = prepared.table.select(F.col("src").alias("id")).distinct().withColumn("rank", F.lit(1.0))
    for steps in (1, 2, 3):
        ranks = graph._damped(prepared.contributions(ranks))
        assert plan_of(ranks).count("Exchange") == steps
    prepared.close()


def test_scans_read_only_what_a_query_needs(spark):
    assert read_columns(fr.links(spark, SF_DIR)) == {"l_partkey:bigint,l_suppkey:bigint,l_linenumber:int"}
    accepted = tw.accepted_without_text(spark, SF_DIR).select("generation_s")
    assert not any("text" in columns or "props" in columns for columns in read_columns(accepted))
    signups = fr.events(spark, SF_DIR).where("action = 'signup'")
    assert "EqualTo(event_type,signup)" in plan_of(signups)


def test_single_exchange_aggregations(spark):
    cells = fr.cells(spark, SF_DIR)
    assert plan_of(linalg.trace_of_square(cells)).count("Exchange") == 2  # by cell, then the one sum
    assert plan_of(bursts.tumbling_bursts(fr.events(spark, SF_DIR), 60)).count("Exchange") == 1
    assert plan_of(bursts.sliding_bursts(fr.events(spark, SF_DIR), 60, 1)).count("Exchange") == 2


def session(master, folder=None, set_later=None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: folder if key == "spark.checkpoint.dir" else default),
        sparkContext=SimpleNamespace(master=master, applicationId=f"app-{master}", getCheckpointDir=lambda: set_later),
    )


def test_work_folder_comes_from_the_session():
    assert runtime.shared_folder(session("yarn", "hdfs://x/work")) == "hdfs://x/work"
    assert runtime.fresh_path(session("yarn", "hdfs://x/work/"), "rows").startswith("hdfs://x/work/rows-")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        runtime.shared_folder(session("yarn"))
    assert runtime.shared_folder(session("yarn", set_later="hdfs://x/set")) == "hdfs://x/set"
    assert runtime.shared_folder(session("local[2]")) == runtime.shared_folder(session("local[2]"))


def test_broadcast_needs_a_counted_side(spark):
    short, long = spark.range(5), spark.range(50)
    other = spark.range(3).withColumnRenamed("id", "k")
    hinted = other.join(runtime.broadcast_if_small(short, 10), F.col("k") == F.col("id"))
    plain = other.join(runtime.broadcast_if_small(long, 10), F.col("k") == F.col("id"))
    assert "broadcast" in hinted._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" not in plain._jdf.queryExecution().logical().toString().lower()

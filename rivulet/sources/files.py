"""Scans: text and delimited files, tables and streams, as DataFrames with fixed schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.functions.text import tokens
from rivulet.operators.ordering import with_position

ACTION_SCHEMA = "userA BIGINT, userB BIGINT, timestamp TIMESTAMP, action STRING"
ACTIVITY_SCHEMA = "user_a INT, user_b INT, ts_s BIGINT, action STRING"


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """One untrimmed row ``value`` per line."""
    return spark.read.text(path)


def line_count(lines: DataFrame) -> DataFrame:
    return lines.agg(F.count(F.lit(1)).alias("n_lines"))


def parse_edges(lines: DataFrame) -> DataFrame:
    """Edges ``(src, dst)`` as strings from lines ``value``.

    Comment lines, lines without exactly two tokens and self-loops are dropped; repeats are kept.
    """
    parts = tokens("value")
    return (
        lines.where(~F.startswith("value", F.lit("#")))
        .select(parts.alias("parts"))
        .where((F.size("parts") == 2) & (F.col("parts")[0] != F.col("parts")[1]))
        .select(F.col("parts")[0].alias("src"), F.col("parts")[1].alias("dst"))
    )


def edge_list(spark: SparkSession, path: str, min_partitions: int | None = None) -> DataFrame:
    """Edge-list files. Spark splits them by bytes; ``min_partitions`` spreads few large splits further."""
    lines = spark.read.text(path)
    if min_partitions and lines.rdd.getNumPartitions() < min_partitions:
        lines = lines.repartition(min_partitions)
    return parse_edges(lines)


def id_list(spark: SparkSession, path: str, column: str = "target_user") -> DataFrame:
    """One long per line, repeats kept; a line that is no number fails the job."""
    return spark.read.schema(f"{column} BIGINT").option("mode", "FAILFAST").csv(path)


def activity(spark: SparkSession, path: str) -> DataFrame:
    """``user_a user_b seconds action`` separated by one space; a bad line fails the job."""
    reader = spark.read.schema(ACTIVITY_SCHEMA).option("sep", " ").option("mode", "FAILFAST")
    return reader.csv(path)


def parse_vertex_words(lines: DataFrame) -> DataFrame:
    """``(…, words)`` from lines ``value``; the first token is a timestamp and no word."""
    parts = tokens("value")
    return lines.withColumn("words", F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))))


def vertex_words(spark: SparkSession, path: str) -> DataFrame:
    """``(id, words)``: one vertex per line, numbered from 0 by line position over the files in name order."""
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
    )
    # Within one scan task the row id follows the line; blocks and files order the tasks.
    placed = with_position(lines, ["_file", "_block", "_row"], name="id")
    return parse_vertex_words(placed).select((F.col("id") - 1).alias("id"), "words")


def sparse_examples(spark: SparkSession, path: str) -> DataFrame:
    """Parquet rows ``(example_id, label, index, value)``; index and value must have the same length."""
    rows = spark.read.parquet(path)
    checked = F.assert_true(F.size("index") == F.size("value"), "index and value differ in length")
    return rows.where(checked.isNull()).select(
        F.col("example_id").cast("bigint").alias("example_id"),
        F.col("label").cast("double").alias("label"),
        F.col("index").cast("array<bigint>").alias("index"),
        F.col("value").cast("array<double>").alias("value"),
    )


def stop_words(spark: SparkSession, path: str) -> DataFrame:
    """One word per line, as it stands."""
    return spark.read.text(path).withColumnRenamed("value", "word")


def action_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Streaming CSV folder: every new file is new input."""
    reader = spark.readStream.schema(ACTION_SCHEMA).option("sep", ",")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.csv(path)


def parquet_stream(
    spark: SparkSession, path: str, schema: str, pattern: str | None = None, files_per_trigger: int | None = None
) -> DataFrame:
    """Streaming parquet folder with an explicit schema."""
    reader = spark.readStream.schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)

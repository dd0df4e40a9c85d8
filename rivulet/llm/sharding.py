"""Shards that all hold the mixture of the sources, by proportional stratified interleaving.

Inside each source the rows are shuffled by a seeded digest of their id and ranked; row r of n gets
the fraction (2r - 1) / 2n. In the order of these fractions every stretch holds each source in
proportion, so the order is cut into shards whose row counts are at most one apart. Both orders are
range-partitioned, so neither a hot source nor the whole table passes through one task, and only ids,
sources and digests of the rows are shuffled.

Rows without a source and with an empty one are one source. A null text has no bytes. Rows without an
id take part. Rows with the same id, source and text are ordered among each other by all their columns.
An empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.operators.ordering import with_position
from rivulet.runtime import cut_lineage

SHARDS, SEED = 24, 7
#: Bytes that a row needs besides its text.
ROW_BYTES = 8
LAW = "rows"
_KEYS = ("_id", "_source", "_turn", "_crc", "_bytes")


def _slim(id: str, text: str, source: str, seed: int) -> list[Column]:
    body = F.coalesce(F.col(text), F.lit(""))
    turn = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id).cast("string"), F.lit(""))).cast("binary"))
    return [
        F.col(id).alias("_id"),
        F.coalesce(F.col(source).cast("string"), F.lit("")).alias("_source"),
        turn.alias("_turn"),
        F.crc32(body.cast("binary")).alias("_crc"),
        (F.octet_length(body) + ROW_BYTES).cast("long").alias("_bytes"),
    ]


def interleave(
    docs: DataFrame, shards: int = SHARDS, seed: int = SEED, id: str = "doc_id", text: str = "text", source: str = "source"
) -> DataFrame:
    """A row per row of ``docs``: ``id, source, size, text_crc32, shard, slot``; slots count from 0 in each shard.

    With fewer rows than shards the first shards hold one row each.
    """
    slim = cut_lineage(docs.select(*_slim(id, text, source, seed)))  # texts are read once
    placed = _positions(slim, shards)
    return placed.select(
        F.col("_id").alias(id), F.col("_source").alias(source), F.col("_bytes").alias("size"),
        F.col("_crc").alias("text_crc32"), "shard", "slot",
    )


def _positions(slim: DataFrame, shards: int) -> DataFrame:
    ties = ["_turn", "_id", "_crc", "_bytes"]
    ranked = with_position(slim, ties, ["_source"], "_rank", size="_n")
    ordered = ranked.withColumn("_fraction", (2 * F.col("_rank") - 1) / (2 * F.col("_n")))
    total = slim.agg(F.count(F.lit(1)).alias("_total"))
    placed = with_position(ordered, ["_fraction", *ties, "_source"], name="_place").withColumn(
        "_total", total.scalar()
    )
    # place p (from 0) lies in shard floor(p * shards / total), which opens at ceil(shard * total / shards)
    shard = F.expr(f"(_place - 1) * {shards} div _total")
    opens = F.expr(f"(shard * _total + {shards - 1}) div {shards}")
    return placed.withColumn("shard", shard.cast("int")).withColumn("slot", F.col("_place") - 1 - opens)


def write_shards(
    docs: DataFrame, folder: str, shards: int = SHARDS, seed: int = SEED,
    id: str = "doc_id", text: str = "text", source: str = "source", files_per_shard: int = 4,
) -> DataFrame:
    """Write whole rows to ``folder/shard=…`` in slot order and read them back with ``shard`` and ``slot``.

    Each row is found by its id, source and text digests, and a number among those that have these in
    common. Columns of ``docs`` named shard or slot are replaced. A shard is cut by slots into
    ``files_per_shard`` files, each written by one task.
    """
    spark = docs.sparkSession
    kept = [c for c in docs.columns if c not in ("shard", "slot")]
    whole = docs.select(F.struct(*kept).alias("_row"), *_slim(id, text, source, seed))
    twin = Window.partitionBy(*_KEYS)
    rows = whole.withColumn("_twin", F.row_number().over(twin.orderBy(F.xxhash64(F.to_json("_row")))))
    spots = _positions(cut_lineage(whole.select(*_KEYS)), shards)
    spots = spots.withColumn("_twin", F.row_number().over(twin.orderBy("shard", "slot")))
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in (*_KEYS, "_twin")]
    found = rows.alias("l").join(spots.alias("r"), same)
    placed = found.select("_row.*", "r.shard", "r.slot")
    (
        placed.repartitionByRange(shards * files_per_shard, "shard", "slot")
        .sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard")
        .parquet(folder)
    )
    return spark.read.schema(placed.schema).parquet(folder)


def assignments(docs: DataFrame) -> DataFrame:
    """The shards of ``docs`` in the form of the registered query."""
    return interleave(docs).select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


#: CRC-32 (reflected polynomial) byte by byte over a table that the SQL builds itself.
SQL = f"""WITH RECURSIVE bits AS (
  SELECT n, 0 AS k, n::BIGINT AS c FROM range(256) t(n)
  UNION ALL
  SELECT n, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY n) AS t FROM bits WHERE k = 8),
body AS (
  SELECT doc_id, coalesce(source, '') AS src, encode(coalesce(text, '')) AS b FROM documents),
d AS (
  SELECT doc_id, src, md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')) AS turn, octet_length(b) + {ROW_BYTES} AS size,
    xor(4294967295, list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(b), '..'), lambda x: ('0x' || x)::BIGINT)),
      lambda a, x: xor(a >> 8, t[1 + (xor(a, x) & 255)]))) AS text_crc32
  FROM body, crc),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY src ORDER BY turn, doc_id, text_crc32, size) AS r,
    count(*) OVER (PARTITION BY src) AS n FROM d),
placed AS (
  SELECT *, count(*) OVER () AS total, row_number() OVER (
    ORDER BY (2 * r - 1)::DOUBLE / (2 * n)::DOUBLE, turn, doc_id, text_crc32, size, src) - 1 AS place FROM ranked),
cut AS (SELECT *, place * {SHARDS} // total AS shard FROM placed)
SELECT doc_id, size, text_crc32, '{LAW}' AS law, shard::INT AS shard,
  place - (shard * total + {SHARDS - 1}) // {SHARDS} AS slot, NULL::INT AS grown_shard FROM cut"""

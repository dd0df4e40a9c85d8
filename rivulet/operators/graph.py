"""Graphs as plain edge and vertex tables: degrees, messages, PageRank."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.operators.lists import counted_values
from rivulet.runtime import BucketedCopy, cut_lineage, shuffle_width


def edge_vertices(edges: DataFrame) -> DataFrame:
    """Every endpoint once, with start rank 1.0."""
    ends = edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    return ends.withColumn("rank", F.lit(1.0))


def adjacency_lists(edges: DataFrame) -> DataFrame:
    """``(src, dst, times, n_out)``: each neighbour with the number of parallel edges to it."""
    return counted_values(edges, "src", "dst").select("src", "dst", "times", F.col("n_rows").alias("n_out"))


def out_degrees(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Every vertex with its out-degree, 0 when it has no out-edge."""
    degrees = edges.groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("out_degree"))
    return vertices.join(degrees, "id", "left").withColumn(
        "out_degree", F.coalesce("out_degree", F.lit(0)).cast("bigint")
    )


def triplets(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Edges with the attributes of both ends, prefixed ``src_`` and ``dst_``."""
    attrs = [c for c in vertices.columns if c != "id"]
    source = vertices.select(F.col("id").alias("src"), *[F.col(c).alias(f"src_{c}") for c in attrs])
    target = vertices.select(F.col("id").alias("dst"), *[F.col(c).alias(f"dst_{c}") for c in attrs])
    return edges.join(source, "src").join(target, "dst")


def aggregate_messages(
    vertices: DataFrame, edges: DataFrame, to: str, message: Column, **aggs: Callable[[Column], Column]
) -> DataFrame:
    """Send ``message`` along every edge to its ``src`` or ``dst`` and aggregate per receiver.

    Vertices that receive nothing are absent.
    """
    sent = triplets(vertices, edges).select(F.col(to).alias("id"), message.alias("_message"))
    return sent.groupBy("id").agg(*[agg(F.col("_message")).alias(name) for name, agg in aggs.items()])


class RankEdges:
    """Edges ready for repeated rank steps: written once, bucketed by source, with their share.

    Parallel edges become one row with ``share = times / out_degree``. A source with more than
    ``max_fanout`` edges is spread over several salts and its rank is sent once per salt; without such
    a source the edges lie by ``src`` alone, as the ranks do after their aggregation, so a step
    shuffles only the partly summed contributions. The ``range`` layout gives the same ranks, but a
    join cannot reuse it and moves the edges in every step.
    """

    def __init__(self, edges: DataFrame, layout: str = "hash", max_fanout: int = 200_000):
        # all that follows is worked out from this copy, so the source of the edges is read once
        self.merged = cut_lineage(edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("_times")))
        degrees = self.merged.groupBy("src").agg(F.sum("_times").alias("_out"))
        salts = F.ceil(F.col("_out") / max_fanout).cast("bigint")
        hot = degrees.where(F.col("_out") > max_fanout).select("src", salts.alias("_salts"))
        hot = cut_lineage(hot)
        self.hot = None if hot.isEmpty() else hot
        shared = self.merged.join(degrees, "src").select(
            "src",
            F.pmod(F.xxhash64("dst"), salts).alias("salt"),
            "dst",
            (F.col("_times") / F.col("_out")).alias("share"),
        )
        if self.hot is None:
            shared = shared.drop("salt")
        self.keys = [c for c in ("src", "salt") if c in shared.columns]
        self._copy = None
        if layout == "range":
            ranged = shared.repartitionByRange(shuffle_width(edges.sparkSession), *self.keys)
            self.table = cut_lineage(ranged.sortWithinPartitions(*self.keys))
        else:
            self._copy = BucketedCopy(shared, *self.keys)
            self.table = self._copy.table

    def keep_sources(self, ids: DataFrame) -> None:
        """From now on only the edges whose source is in ``ids(id)``, in a smaller copy."""
        some = self.table.join(ids.select(F.col("id").alias("src")), "src", "left_semi")
        fewer = BucketedCopy(some, *self.keys)
        self.close()
        self._copy, self.table = fewer, fewer.table

    def close(self) -> None:
        if self._copy is not None:
            self._copy.drop()

    def contributions(self, ranks: DataFrame) -> DataFrame:
        """``(dst, amount)`` for every edge whose source is in ``ranks(id, rank)``."""
        senders = ranks.select(F.col("id").alias("src"), "rank")
        if self.hot is not None:
            last = F.coalesce("_salts", F.lit(1).cast("bigint")) - 1
            senders = senders.join(self.hot, "src", "left").select(
                "src", "rank", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("salt")
            )
        # the ranks of a bucket are fewer than its edges: hashed, so that no step sorts the edges
        return self.table.join(senders.hint("shuffle_hash"), self.keys).select(
            "dst", (F.col("share") * F.col("rank")).alias("amount")
        )


def _damped(messages: DataFrame) -> DataFrame:
    return messages.groupBy(F.col("dst").alias("id")).agg(
        (F.lit(0.15) + F.lit(0.85) * F.sum("amount")).alias("rank")
    )


def _completed(edges: DataFrame, ranks: DataFrame) -> DataFrame:
    """All vertices of ``edges``; one without a computed rank keeps 1.0."""
    start = edge_vertices(edges).select("id")
    return start.join(ranks, "id", "left").select("id", F.coalesce("rank", F.lit(1.0)).alias("rank"))


def pagerank(
    edges: DataFrame,
    iterations: int = 10,
    layout: str = "hash",
    cache: bool = False,
    checkpoint_every: int = 5,
    max_fanout: int = 200_000,
) -> DataFrame:
    """PageRank in which a vertex that receives nothing drops out of the next iteration.

    Ranks start at 1.0 and are not divided by the number of vertices. A vertex without in-edges
    contributes once and ends with 1.0. At least one iteration runs.
    """
    prepared = RankEdges(edges, layout, max_fanout)
    try:
        if cache:
            prepared.table.persist(StorageLevel.MEMORY_AND_DISK)
        ranks = prepared.table.select(F.col("src").alias("id")).distinct().withColumn("rank", F.lit(1.0))
        for step in range(1, max(iterations, 1) + 1):
            ranks = _damped(prepared.contributions(ranks))
            if step % checkpoint_every == 0 or step >= iterations:
                ranks = cut_lineage(ranks)
    finally:
        if cache:
            prepared.table.unpersist()
        prepared.close()
    return _completed(prepared.merged, ranks)


def pagerank_graph(
    edges: DataFrame, iterations: int = 20, checkpoint_every: int = 5, max_fanout: int = 200_000
) -> DataFrame:
    """PageRank in which a vertex without messages keeps its rank and keeps contributing.

    Only vertices without in-edges get no messages, so what they send never changes: it is summed
    once, and the loop follows the other vertices and reads their edges only.
    """
    prepared = RankEdges(edges, "hash", max_fanout)
    try:
        sources = prepared.table.select(F.col("src").alias("id")).distinct()
        receivers = cut_lineage(prepared.table.select(F.col("dst").alias("id")).distinct())
        one = F.lit(1.0).alias("rank")
        constant = cut_lineage(
            prepared.contributions(sources.join(receivers, "id", "left_anti").select("id", one))
            .groupBy("dst")
            .agg(F.sum("amount").alias("amount"))
        )
        if iterations < 1:
            targets_only = receivers.join(sources, "id", "left_anti").select("id", F.lit(0.0).alias("rank"))
            ranks = cut_lineage(sources.join(receivers, "id", "left_semi").select("id", one).unionByName(targets_only))
        else:
            prepared.keep_sources(receivers)
            ranks = prepared.table.select(F.col("src").alias("id")).distinct().select("id", one)
        for step in range(1, iterations + 1):
            ranks = _damped(prepared.contributions(ranks).unionByName(constant))
            if step % checkpoint_every == 0 or step == iterations:
                ranks = cut_lineage(ranks)
    finally:
        prepared.close()
    return _completed(prepared.merged, ranks)


def rank_preview(ranks: DataFrame, n: int = 100) -> DataFrame:
    """The ``n`` highest ranks, ties by id."""
    return ranks.orderBy(F.desc("rank"), "id").limit(n)

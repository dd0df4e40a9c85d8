"""Logistic and softmax regression by gradient steps.

Binary examples are ``(example_id, label ±1, index ARRAY<BIGINT>, value ARRAY<DOUBLE>)``. A model is the
table ``(index, weight)`` of the indexes touched so far plus one start value for all others, so its width
costs nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.operators.linalg import nonzeros, sparse_dot
from rivulet.runtime import BucketedCopy, cut_lineage, delete_folder, fresh_path, shuffle_width


def minibatch_assign(
    examples: DataFrame, n_batches: int, epoch: int = 0, seed: int = 0, hash_of: Column | None = None
) -> DataFrame:
    """``examples`` with the ``batch`` each row has in this epoch, by a hash of its id."""
    mixed = F.xxhash64("example_id", F.lit(epoch), F.lit(seed)) if hash_of is None else hash_of
    return examples.withColumn("batch", F.pmod(mixed, F.lit(n_batches)).cast("bigint"))


class BatchedTable:
    """``examples`` written once by ``batch``, so that a step reads its own batch only.

    The files are balanced by size at run time: a small batch is one file, a large one many. ``drop`` deletes them.
    """

    def __init__(self, examples: DataFrame):
        self.spark = examples.sparkSession
        self.path = fresh_path(self.spark, "batches")
        examples.hint("rebalance", "batch").write.partitionBy("batch").parquet(self.path)
        self.table = self.spark.read.schema(examples.schema).parquet(self.path)

    def drop(self) -> None:
        delete_folder(self.spark, self.path)


def empty_model(spark: SparkSession) -> DataFrame:
    return spark.range(0).select(F.col("id").alias("index"), F.lit(0.0).alias("weight"))


def _sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def scored(examples: DataFrame, model: DataFrame, init: float) -> DataFrame:
    """``examples`` with ``dot``; 0 for an example without entries."""
    dots = sparse_dot(examples, model, init)
    return examples.join(dots, "example_id", "left").withColumn("dot", F.coalesce("dot", F.lit(0.0)))


def gradient(examples: DataFrame, model: DataFrame, init: float) -> DataFrame:
    """``(index, gradient)`` summed over ``examples``."""
    margin = F.col("label") * F.col("dot")
    factored = scored(examples, model, init).withColumn("_factor", F.col("label") * (_sigmoid(margin) - 1))
    return nonzeros(factored, "_factor").groupBy("index").agg(
        F.sum(F.col("_factor") * F.col("value")).alias("gradient")
    )


def apply_gradient(model: DataFrame, grads: DataFrame, eta: float, init: float) -> DataFrame:
    """``weight - eta * gradient`` for touched indexes; the others keep their weight."""
    step = F.coalesce("gradient", F.lit(0.0)) * eta
    return model.join(grads, "index", "full").select(
        "index", (F.coalesce("weight", F.lit(init)) - step).alias("weight")
    )


def sync_sgd(
    examples: DataFrame, steps: int, n_batches: int, eta: float = 0.01, init: float = 1.0
) -> DataFrame:
    """Synchronous SGD: each step adds up the gradients of one batch over all workers.

    ``examples`` carry ``batch``; step ``s`` takes batch ``s % n_batches``. The model is written after
    every step because the next one reads it twice.
    """
    batches = BatchedTable(examples)
    model = empty_model(examples.sparkSession)
    try:
        for step in range(steps):
            rows = batches.table.where(F.col("batch") == step % n_batches)
            model = cut_lineage(apply_gradient(model, gradient(rows, model, init), eta, init))
    finally:
        batches.drop()
    return model


class WideBatches:
    """Batches of sparse examples laid out twice, for models of any width.

    ``cold`` holds the entries by feature, bucketed as the model is, so that weights and entries meet without
    moving either; ``rows`` holds the examples with their arrays, bucketed by example, for the way back.
    A batch is a range of row groups of each. Features with an equal share of the entries or more
    are ``hot``: there are at most as many as buckets, their weights are broadcast and their entries
    stay where they are.
    """

    def __init__(self, examples: DataFrame):
        self.width = shuffle_width(examples.sparkSession)
        self._rows = BucketedCopy(examples.select("example_id", "label", "batch", "index", "value"), "example_id", first=("batch",))
        self.rows = self._rows.table
        entries = nonzeros(self.rows, "batch")
        counts = entries.groupBy("index").agg(F.count(F.lit(1)).alias("_n"))
        total = entries.agg(F.count(F.lit(1))).scalar()
        self.hot_index = cut_lineage(counts.where(F.col("_n") * self.width >= total).select("index"))
        self._cold = BucketedCopy(entries.join(F.broadcast(self.hot_index), "index", "left_anti"), "index", first=("batch",))
        self.cold = self._cold.table
        self.hot = cut_lineage(entries.join(F.broadcast(self.hot_index), "index", "left_semi"))

    def dots(self, batch: int, model: DataFrame, init: float) -> DataFrame:
        """``(example_id, dot)`` of a batch; only the partial sums per example are shuffled."""
        here = F.col("batch") == batch
        hot_weights = F.broadcast(model.join(F.broadcast(self.hot_index), "index", "left_semi"))
        met = self.cold.where(here).join(model, "index", "left").select("example_id", "value", "weight")
        met = met.unionByName(self.hot.where(here).join(hot_weights, "index", "left").select("example_id", "value", "weight"))
        return met.groupBy("example_id").agg(F.sum(F.col("value") * F.coalesce("weight", F.lit(init))).alias("dot"))

    def gradient(self, batch: int, model: DataFrame, init: float) -> DataFrame:
        """``(index, gradient)`` of a batch: factors come to the examples, partial sums go to the features."""
        rows = self.rows.where(F.col("batch") == batch).join(self.dots(batch, model, init), "example_id", "left")
        factor = F.col("label") * (_sigmoid(F.col("label") * F.coalesce("dot", F.lit(0.0))) - 1)
        entries = nonzeros(rows.withColumn("_factor", factor), "_factor")
        return entries.groupBy("index").agg(F.sum(F.col("_factor") * F.col("value")).alias("gradient"))

    def drop(self) -> None:
        self._rows.drop()
        self._cold.drop()


def wide_sgd(examples: DataFrame, steps: int, n_batches: int, eta: float = 0.01, init: float = 1.0) -> DataFrame:
    """As ``sync_sgd``, for models with very many features: a step moves partial sums and never the entries.

    The model is a bucketed table, written anew by each step where its rows lie; the one before is dropped.
    """
    layout = WideBatches(examples)
    copy = BucketedCopy(empty_model(examples.sparkSession), "index")
    try:
        for step in range(steps):
            grads = layout.gradient(step % n_batches, copy.table, init)
            moved = BucketedCopy(apply_gradient(copy.table, grads, eta, init), "index", spread=False)
            copy.drop()
            copy = moved
        return cut_lineage(copy.table)
    finally:
        copy.drop()
        layout.drop()


def error_counts(examples: DataFrame, model: DataFrame, init: float, by: str) -> DataFrame:
    """Per value of ``by``: rows and how many the sign of the score gets wrong."""
    wrong = F.signum("dot") != F.col("label")
    return scored(examples, model, init).groupBy(by).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(wrong).alias("n_errors")
    )


def abs_error(examples: DataFrame, model: DataFrame, init: float, by: str) -> DataFrame:
    """Per value of ``by``: mean of ``|label - dot|``."""
    return scored(examples, model, init).groupBy(by).agg(
        F.count(F.lit(1)).alias("n_rows"), F.avg(F.abs(F.col("label") - F.col("dot"))).alias("mean_abs_error")
    )


class _Shard:
    """The weights that one shard's rows have touched, in a growing array with a slot per index."""

    def __init__(self, shard: int, eta: float):
        self.shard, self.eta = shard, eta
        self.slots: dict[int, int] = {}
        self.weights = np.empty(1024)
        self.pending: list[tuple[np.ndarray, np.ndarray, float]] = []

    def places(self, index: np.ndarray, start: np.ndarray) -> np.ndarray:
        """The slots of ``index``; new ones begin with ``start``. Each distinct index is looked up once."""
        distinct, first, back = np.unique(index, return_index=True, return_inverse=True)
        found = np.empty(len(distinct), dtype=np.int64)
        for at, (key, begin) in enumerate(zip(distinct.tolist(), start[first].tolist())):
            slot = self.slots.get(key)
            if slot is None:
                slot = self.slots[key] = len(self.slots)
                if slot == len(self.weights):
                    self.weights = np.concatenate((self.weights, np.empty(slot)))
                self.weights[slot] = begin
            found[at] = slot
        return found[back]

    def flush(self) -> None:
        """One update by the pending rows, all judged by the weights from before it."""
        moves = []
        for where, value, label in self.pending:
            factor = label * (1.0 / (1.0 + np.exp(-label * (self.weights[where] @ value))) - 1.0)
            moves.append((where, self.eta * factor * value))
        for where, move in moves:
            np.subtract.at(self.weights, where, move)
        self.pending.clear()

    def result(self) -> pd.DataFrame:
        self.flush()
        return pd.DataFrame({"shard": self.shard, "index": list(self.slots), "weight": self.weights[: len(self.slots)]})


def _row_updates(eta: float, batch_size: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Updates in row order inside each shard; rows of a shard arrive together. Linear in the entries."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state: _Shard | None = None
        for frame in frames:
            for shard, rows in frame.groupby("shard", sort=False):
                if state is None or state.shard != shard:
                    if state is not None and state.slots:
                        yield state.result()
                    state = _Shard(shard, eta)
                sizes = rows["index"].map(len).to_numpy()
                where = state.places(np.concatenate(rows["index"].to_list()), np.concatenate(rows["start"].to_list()))
                parts = np.split(where, np.cumsum(sizes)[:-1])
                for slots, value, label in zip(parts, rows["value"], rows["label"]):
                    state.pending.append((slots, np.asarray(value, dtype=float), label))
                    if len(state.pending) >= batch_size:
                        state.flush()
        if state is not None and state.slots:
            yield state.result()

    return run


def local_sgd(
    examples: DataFrame,
    rounds: int = 1,
    eta: float = 0.01,
    init: float = 1.0,
    batch_size: int = 1,
    order_of: Column | None = None,
) -> DataFrame:
    """Local SGD: shards update on their own from a shared start, then touched weights are averaged.

    ``examples`` carry ``shard``; give more shards for more data. Inside a shard rows go by ``order_of``
    (default: a hash of the id), then id. A task streams its rows and holds only the weights they touch. The start weights come by a join on ``index``, never as a whole model.
    """
    spark = examples.sparkSession
    width = shuffle_width(spark)
    model = empty_model(spark)
    update = _row_updates(eta, batch_size)
    order = F.xxhash64("example_id") if order_of is None else order_of
    for _ in range(rounds):
        start = F.coalesce("weight", F.lit(init)).alias("start")
        entries = nonzeros(examples, "label", "shard").join(model, "index", "left")
        entry = F.struct("index", "value", start)
        rows = (
            entries.groupBy("example_id", "label", "shard")
            .agg(F.sort_array(F.collect_list(entry)).alias("_e"))
            .select("shard", "example_id", "label", "_e.index", "_e.value", "_e.start")
            .repartition(width, "shard")
            .sortWithinPartitions("shard", order, "example_id")
        )
        local = rows.mapInPandas(update, "shard BIGINT, index BIGINT, weight DOUBLE")
        touched = local.groupBy("index").agg(F.avg("weight").alias("_new"))
        model = cut_lineage(
            model.join(touched, "index", "full").select("index", F.coalesce("_new", "weight").alias("weight"))
        )
    return model

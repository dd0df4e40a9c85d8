"""Softmax regression over dense feature arrays ``(example_id, label, features ARRAY<DOUBLE>)``.

A model small enough to hold in memory (checked) travels to the tasks as one matrix and each task returns
one partial sum per cell; a larger one stays a table ``(index, class, weight)`` and is joined.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rivulet.operators.sgd import BatchedTable
from rivulet.runtime import cut_lineage

SMALL_MODEL_CELLS = 1_000_000


def probabilities(examples: DataFrame, weights: DataFrame) -> DataFrame:
    """``(example_id, label, class, logit, p)`` by a join on the feature index."""
    entries = examples.select("example_id", "label", F.posexplode("features").alias("index", "value"))
    logits = (
        entries.join(weights, "index")
        .groupBy("example_id", "label", "class")
        .agg(F.sum(F.col("value") * F.col("weight")).alias("logit"))
    )
    row = Window.partitionBy("example_id")
    shifted = F.exp(F.col("logit") - F.max("logit").over(row))
    return logits.withColumn("_e", shifted).select(
        "example_id", "label", "class", "logit", (F.col("_e") / F.sum("_e").over(row)).alias("p")
    )


def evaluate(examples: DataFrame, weights: DataFrame) -> DataFrame:
    """Rows, wrong predictions (ties to the smallest class) and mean cross-entropy, from a weight table."""
    best = F.max_by("class", F.struct("logit", -F.col("class")))
    per_row = probabilities(examples, weights).groupBy("example_id", "label").agg(
        best.alias("guess"), F.max(F.when(F.col("class") == F.col("label"), F.col("p"))).alias("p")
    )
    return per_row.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("guess") != F.col("label")).alias("n_errors"),
        F.avg(-F.log("p")).alias("entropy"),
    )


def gradient_table(examples: DataFrame, weights: DataFrame) -> DataFrame:
    """``(index, class, gradient)`` of the mean cross-entropy, for models of any width."""
    residual = F.col("p") - (F.col("class") == F.col("label")).cast("double")
    errors = probabilities(examples, weights).select("example_id", "class", residual.alias("_r"))
    entries = examples.select("example_id", F.posexplode("features").alias("index", "value"))
    summed = entries.join(errors, "example_id").groupBy("index", "class").agg(
        F.sum(F.col("value") * F.col("_r")).alias("_sum")
    )
    n = examples.agg(F.count(F.lit(1))).scalar()
    return summed.select("index", "class", (F.col("_sum") / n).alias("gradient"))


def _forward(frame: pd.DataFrame, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    features = np.stack(frame["features"].to_numpy()).astype(float)
    logits = features @ weights
    shifted = np.exp(logits - logits.max(axis=1, keepdims=True))
    return features, frame["label"].to_numpy(), shifted / shifted.sum(axis=1, keepdims=True)


def _partial_gradient(weights: np.ndarray) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, rows = np.zeros_like(weights), 0
        for frame in frames:
            if len(frame):
                features, labels, p = _forward(frame, weights)
                p[np.arange(len(p)), labels] -= 1.0
                total += features.T @ p
                rows += len(p)
        if rows:
            yield pd.DataFrame({"cell": np.arange(total.size), "gradient": total.ravel(), "n": rows})

    return run


def _partial_metrics(epochs: list[np.ndarray]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for epoch, weights in enumerate(epochs, 1):
                if len(frame):
                    _, labels, p = _forward(frame, weights)
                    picked = p[np.arange(len(p)), labels]
                    yield pd.DataFrame({
                        "epoch": [epoch],
                        "n_rows": [len(p)],
                        "n_errors": [int((p.argmax(axis=1) != labels).sum())],
                        "entropy": [float(-np.log(np.maximum(picked, 1e-300)).sum())],
                    })

    return run


def _matrix_step(rows: DataFrame, weights: np.ndarray, lr: float) -> np.ndarray:
    partial = rows.select("label", "features").mapInPandas(
        _partial_gradient(weights), "cell BIGINT, gradient DOUBLE, n BIGINT"
    )
    summed = partial.groupBy("cell").agg(F.sum("gradient").alias("g"), F.sum("n").alias("n")).toPandas()
    step = np.zeros(weights.size)
    step[summed["cell"].to_numpy()] = summed["g"].to_numpy() / np.maximum(summed["n"].to_numpy(), 1)
    return weights - lr * step.reshape(weights.shape)


def train_metrics(
    examples: DataFrame,
    n_features: int,
    n_classes: int,
    n_batches: int = 10,
    epochs: int = 40,
    init_lr: float = 0.01,
    lr_decay: float = 0.99,
    small_cells: int = SMALL_MODEL_CELLS,
) -> DataFrame:
    """Train on ``examples`` (which carry ``batch``) and return ``(epoch, n_rows, error_rate, entropy)``.

    The learning rate of epoch ``T`` (from 0) is ``init_lr * lr_decay ** T``. A model of up to ``small_cells``
    numbers moves between driver and tasks in every step, whatever the row count; a larger one is a table.
    """
    batches = BatchedTable(examples)
    try:
        return cut_lineage(_train(batches.table, n_features, n_classes, n_batches, epochs, init_lr, lr_decay, small_cells))
    finally:
        batches.drop()


def _train(
    table: DataFrame, n_features: int, n_classes: int, n_batches: int, epochs: int, init_lr: float, lr_decay: float, small_cells: int
) -> DataFrame:
    spark = table.sparkSession
    small = n_features * n_classes <= small_cells
    matrix = np.zeros((n_features, n_classes))
    cells = None
    if not small:
        cells = spark.range(n_features * n_classes).select(
            F.floor(F.col("id") / n_classes).alias("index"),
            (F.col("id") % n_classes).alias("class"),
            F.lit(0.0).alias("weight"),
        )
    per_epoch, matrices = [], []
    for epoch in range(epochs):
        lr = init_lr * lr_decay**epoch
        for batch in range(n_batches):
            rows = table.where(F.col("batch") == batch)
            if small:
                matrix = _matrix_step(rows, matrix, lr)
            else:
                moved = F.col("weight") - lr * F.coalesce("gradient", F.lit(0.0))
                cells = cut_lineage(
                    cells.join(gradient_table(rows, cells), ["index", "class"], "left").select(
                        "index", "class", moved.alias("weight")
                    )
                )
        if small:
            matrices.append(matrix)
        else:
            per_epoch.append(evaluate(table, cells).withColumn("epoch", F.lit(epoch + 1).cast("bigint")))
    if small:  # the metrics of all epochs come from one pass
        partial = table.select("label", "features").mapInPandas(
            _partial_metrics(matrices), "epoch BIGINT, n_rows BIGINT, n_errors BIGINT, entropy DOUBLE"
        )
        totals = partial.groupBy("epoch").agg(
            F.sum("n_rows").alias("n_rows"), F.sum("n_errors").alias("n_errors"),
            (F.sum("entropy") / F.sum("n_rows")).alias("entropy"),
        )
    else:
        totals = reduce(DataFrame.unionByName, per_epoch)
    return totals.select("epoch", "n_rows", (F.col("n_errors") / F.col("n_rows")).alias("error_rate"), "entropy")

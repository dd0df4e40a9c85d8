"""Matrices as cells or blocks, and sparse vectors as arrays."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.runtime import shuffle_width


def random_matrix(spark: SparkSession, n: int, seed: int = 1024, partitions: int | None = None) -> DataFrame:
    """``(i, j, v)``: an ``n`` by ``n`` matrix, uniform in [0, 1), the same however it is partitioned."""
    cells = spark.range(0, n * n, 1, partitions) if partitions else spark.range(n * n)
    i, j = F.floor(F.col("id") / n), F.col("id") % n
    bits = F.shiftrightunsigned(F.xxhash64(i, j, F.lit(seed)), 11)
    return cells.select(i.alias("i"), j.alias("j"), (bits / F.lit(float(1 << 53))).alias("v"))


def trace_of_square(cells: DataFrame) -> DataFrame:
    """``trace(A·A)`` as the sum of ``a_ij · a_ji``; repeated cells add up.

    Cells (i, j) and (j, i) meet under the unordered key in one aggregation; no join is needed.
    """
    i, j = F.col("i"), F.col("j")
    pairs = cells.groupBy(F.least(i, j).alias("_lo"), F.greatest(i, j).alias("_hi")).agg(
        F.coalesce(F.sum(F.when(i < j, F.col("v"))), F.lit(0.0)).alias("_upper"),
        F.coalesce(F.sum(F.when(i > j, F.col("v"))), F.lit(0.0)).alias("_lower"),
        F.coalesce(F.sum(F.when(i == j, F.col("v"))), F.lit(0.0)).alias("_diagonal"),
    )
    term = 2 * F.col("_upper") * F.col("_lower") + F.col("_diagonal") * F.col("_diagonal")
    return pairs.agg(F.sum(term).alias("trace"))


def random_blocks(spark: SparkSession, n: int, d: int, seed: int = 1024) -> DataFrame:
    """``(bi, bj, cells)``: ``d`` by ``d`` blocks of side ``n / d``, row by row, uniform in [0, 1).

    A block depends on the seed and its place only, so a lost task draws the same numbers again.
    """
    if n % d:
        raise ValueError("n must be a multiple of d")
    side = n // d

    def draw(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for bi, bj in zip(frame["bi"], frame["bj"]):
                cells = np.random.default_rng([seed, bi, bj]).random(side * side)
                yield pd.DataFrame({"bi": [bi], "bj": [bj], "cells": [cells]})

    places = spark.range(d * d).select(F.floor(F.col("id") / d).alias("bi"), (F.col("id") % d).alias("bj"))
    return places.mapInPandas(draw, "bi BIGINT, bj BIGINT, cells ARRAY<DOUBLE>")


def _paired_products(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        parts = []
        for upper, lower, twice in zip(frame["upper"], frame["lower"], frame["twice"]):
            if upper is None or lower is None:
                continue  # the missing block is zero
            side = round(len(upper) ** 0.5)
            a, b = np.reshape(upper, (side, side)), np.reshape(lower, (side, side))
            parts.append((2.0 if twice else 1.0) * float(np.einsum("ij,ji->", a, b)))
        yield pd.DataFrame({"part": parts})


def block_trace(blocks: DataFrame) -> DataFrame:
    """``trace(A·A)`` of a matrix in square blocks.

    Blocks (i, j) and (j, i) meet under the unordered place, two at most, after one exchange in which
    every block moves once; a block costs eight bytes per cell there.
    """
    bi, bj = F.col("bi"), F.col("bj")
    pairs = blocks.groupBy(F.least(bi, bj).alias("_lo"), F.greatest(bi, bj).alias("_hi")).agg(
        F.any_value(F.when(bi <= bj, F.col("cells")), True).alias("upper"),
        F.any_value(F.when(bi >= bj, F.col("cells")), True).alias("lower"),
    )
    products = pairs.select("upper", "lower", (F.col("_lo") < F.col("_hi")).alias("twice"))
    return products.mapInPandas(_paired_products, "part DOUBLE").agg(
        F.coalesce(F.sum("part"), F.lit(0.0)).alias("trace")
    )


def strip_trace(cells: DataFrame, side: int, max_bytes: int = 16 << 20) -> DataFrame:
    """``trace(A·A)`` of cells ``(i, j, v)`` as dense blocks of ``side``, multiplied strip by strip; repeated cells add up.

    Rows of block (I, J) meet the columns of block (J, I) that they are multiplied with. A strip is as many
    of them as ``max_bytes`` allow (one at least), so a task holds one pair of strips, however large a block is.
    """
    rows = max(1, min(side, max_bytes // (2 * 8 * side)))
    summed = cells.groupBy(F.col("i").cast("bigint").alias("i"), F.col("j").cast("bigint").alias("j")).agg(F.sum("v").alias("v"))
    i, j = F.col("i"), F.col("j")
    bi, bj = F.floor(i / side), F.floor(j / side)

    def half(line: Column, across: Column, lower: bool) -> Column:
        """A cell by the block above the diagonal it belongs to: as it is, or transposed."""
        low, high, inside = F.floor(line / side), F.floor(across / side), F.pmod(line, F.lit(side))
        place = F.pmod(inside, F.lit(rows)) * side + F.pmod(across, F.lit(side))
        return F.struct(low.alias("lo"), high.alias("hi"), F.floor(inside / rows).alias("strip"), place.alias("place"), F.lit(lower).alias("lower"))

    halves = F.array_compact(F.array(F.when(bi <= bj, half(i, j, False)), F.when(bj <= bi, half(j, i, True))))
    width = shuffle_width(cells.sparkSession)
    lined = (
        summed.select(F.explode(halves).alias("_h"), "v").select("_h.*", "v")
        .repartition(width, "lo", "hi", "strip")
        .sortWithinPartitions("lo", "hi", "strip")
    )
    parts = lined.mapInArrow(_strip_products(rows * side), "part DOUBLE")
    return parts.agg(F.coalesce(F.sum("part"), F.lit(0.0)).alias("trace"))


def _strip_products(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The products of the pairs of strips in rows sorted by strip ``(lo, hi, strip, place, lower, v)``.

    A strip with an eighth of its places filled or more is multiplied in one dense pair of arrays, used again for each.
    The emptier ones of a batch are multiplied together, in a pair of arrays of the places that are filled. A pair
    of strips with a cell that is no number adds nothing.
    """

    def product(strip: np.ndarray, place: np.ndarray, lower: np.ndarray, v: np.ndarray, twice: np.ndarray, dense: np.ndarray) -> float:
        total = 0.0
        starts = np.flatnonzero(np.r_[True, strip[1:] != strip[:-1]])
        counts = np.diff(np.r_[starts, len(strip)])
        full = counts * 8 >= size
        for at, n in zip(starts[full].tolist(), counts[full].tolist()):
            here = slice(at, at + n)
            dense[lower[here], place[here]] = v[here]
            part = twice[at] * float(dense[0] @ dense[1])
            total += 0.0 if np.isnan(part) else part
            dense[lower[here], place[here]] = 0.0
        thin = np.repeat(~full, counts)
        if thin.any():
            filled, at = np.unique(strip[thin] * size + place[thin], return_inverse=True)
            pair, factor = np.zeros((2, len(filled))), np.zeros(len(filled))
            pair[lower[thin], at], factor[at] = v[thin], twice[thin]
            total += float(np.nansum(np.bincount(filled // size, weights=factor * pair[0] * pair[1])))
        return total

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense, rest = np.zeros((2, size)), None
        for batch in batches:
            lo, hi, strips, place, lower, v = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            some = [lo, hi, strips, place, lower.astype(np.intp), v.astype(float)]
            some = some if rest is None else [np.concatenate(both) for both in zip(rest, some)]
            lo, hi, strips, place, lower, v = some
            new = np.r_[True, (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1]) | (strips[1:] != strips[:-1])]
            number, last = np.cumsum(new) - 1, int(np.flatnonzero(new)[-1])  # the last strip may go on in the next batch
            rest = [c[last:] for c in some]
            if last:
                twice = np.where(lo < hi, 2.0, 1.0)
                done = product(number[:last], place[:last], lower[:last], v[:last], twice[:last], dense)
                yield pa.RecordBatch.from_arrays([pa.array([done])], ["part"])
        if rest is not None:
            lo, hi, strips, place, lower, v = rest
            done = product(np.zeros(len(v), dtype=np.int64), place, lower, v, np.where(lo < hi, 2.0, 1.0), dense)
            yield pa.RecordBatch.from_arrays([pa.array([done])], ["part"])

    return run


def nonzeros(examples: DataFrame, *also: str) -> DataFrame:
    """One row ``(example_id, …, index, value)`` per stored entry of ``examples(example_id, index, value)``."""
    entries = F.explode(F.arrays_zip("index", "value"))
    return examples.select("example_id", *also, entries.alias("_e")).select(
        "example_id", *also, F.col("_e.index").alias("index"), F.col("_e.value").alias("value")
    )


def sparse_dot(examples: DataFrame, weights: DataFrame, default: float = 0.0, shared: str = "weight") -> DataFrame:
    """``(example_id, dot)`` over the stored entries only; an index without a weight has ``default``."""
    weight = F.coalesce(F.col(shared), F.lit(default)) if default else F.coalesce(F.col(shared), F.lit(0.0))
    return (
        nonzeros(examples)
        .join(weights.select("index", shared), "index", "left")
        .groupBy("example_id")
        .agg(F.sum(F.col("value") * weight).alias("dot"))
    )

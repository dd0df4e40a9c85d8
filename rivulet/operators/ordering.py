"""Work that depends on a total order, without sending the whole order through one task.

``ordered_slices`` range-partitions and sorts the rows, so each slice is a contiguous run of the order
and equal-sized whatever the skew of single keys (the order must be unique). What a slice needs from
the earlier ones is one small row per slice, folded over at most ``spark.sql.shuffle.partitions`` rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.runtime import cut_lineage, shuffle_width

SLICE, AT = "_slice", "_at"
_ROW_BITS = 33  # monotonically_increasing_id keeps the partition above this bit


def ordered_slices(df: DataFrame, *order: Column | str, slices: int | None = None) -> DataFrame:
    """``df`` plus its slice number and the row's place (from 0) inside the slice.

    The result is written once: range bounds are sampled, so a recomputation could move rows
    between slices.
    """
    width = slices or shuffle_width(df.sparkSession)
    numbered = (
        df.repartitionByRange(width, *order)
        .sortWithinPartitions(*order)
        .withColumn("_row", F.monotonically_increasing_id())
    )
    return cut_lineage(numbered).select(
        *df.columns,
        F.shiftright("_row", _ROW_BITS).alias(SLICE),
        F.col("_row").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias(AT),
    )


def slice_carry(
    sliced: DataFrame, **folds: tuple[Column, Callable[[Column], Column]]
) -> DataFrame:
    """Per slice, what the earlier slices hand over: ``name=(aggregate per slice, combining aggregate)``.

    One row per slice, so the broadcast and the window without keys are bounded by the slice count.
    """
    earlier = Window.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    per_slice = sliced.groupBy(SLICE).agg(*[agg.alias(name) for name, (agg, _) in folds.items()])
    return F.broadcast(
        per_slice.select(
            SLICE,
            *[combine(F.col(name)).over(earlier).alias(name) for name, (_, combine) in folds.items()],
        )
    )


def with_position(
    df: DataFrame,
    order: list[Column | str],
    group: list[str] | None = None,
    name: str = "pos",
    size: str | None = None,
) -> DataFrame:
    """Number the rows from 1 in ``order``, inside each ``group``; optionally add the group's size.

    Equal to ``row_number()`` over the group, but a group may span many slices.
    """
    group = group or []
    sliced = ordered_slices(df, *group, *order)
    before = slice_carry(sliced, _before=(F.count(F.lit(1)), F.sum))
    placed = sliced.join(before, SLICE).select(
        *df.columns, (F.coalesce("_before", F.lit(0)) + F.col(AT) + 1).alias(name)
    )
    if not group and not size:
        return placed
    bounds = placed.groupBy(*group).agg(
        F.min(name).alias("_first"), F.count(F.lit(1)).alias("_size")
    )
    if not group:
        return placed.select("*", bounds.select("_size").scalar().alias(size))
    placed = placed.join(bounds, group)
    extra = [F.col("_size").alias(size)] if size else []
    return placed.select(*df.columns, (F.col(name) - F.col("_first") + 1).alias(name), *extra)


def running_max_before(df: DataFrame, value: str, order: list[str], name: str) -> DataFrame:
    """Largest ``value`` among the rows strictly earlier in ``order``; null for the first row."""
    sliced = ordered_slices(df, *order)
    carry = slice_carry(sliced, _carry=(F.max(value), F.max))
    inside = Window.partitionBy(SLICE).orderBy(AT).rowsBetween(Window.unboundedPreceding, -1)
    return (
        sliced.withColumn("_inside", F.max(value).over(inside))
        .join(carry, SLICE)
        .select(*df.columns, F.greatest("_inside", "_carry").alias(name))
    )


def running_total_before(df: DataFrame, value: str, order: list[str], name: str) -> DataFrame:
    """Sum of ``value`` over the rows strictly earlier in ``order``; 0 for the first row."""
    sliced = ordered_slices(df, *order)
    carry = slice_carry(sliced, _carry=(F.sum(value), F.sum))
    inside = Window.partitionBy(SLICE).orderBy(AT).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0)
    return (
        sliced.withColumn("_inside", F.sum(value).over(inside))
        .join(carry, SLICE)
        .select(*df.columns, (F.coalesce("_inside", zero) + F.coalesce("_carry", zero)).alias(name))
    )


def last_known(df: DataFrame, value: str, order: list[str], name: str) -> DataFrame:
    """Latest non-null ``value`` at or before each row of ``order``."""
    sliced = ordered_slices(df, *order)
    seen = F.when(F.col(value).isNotNull(), F.col(AT))
    carry = slice_carry(
        sliced, _carry=(F.max_by(value, seen), lambda c: F.last(c, ignorenulls=True))
    )
    inside = Window.partitionBy(SLICE).orderBy(AT).rowsBetween(Window.unboundedPreceding, 0)
    return (
        sliced.withColumn("_inside", F.last(value, ignorenulls=True).over(inside))
        .join(carry, SLICE)
        .select(*df.columns, F.coalesce("_inside", "_carry").alias(name))
    )


def previous_value(
    df: DataFrame, value: str, keys: list[str], order: list[str], name: str
) -> DataFrame:
    """``value`` of the row before, per key; null for a key's first row. A key may span many slices."""
    sliced = ordered_slices(df, *keys, *order)
    tail = F.max_by(F.struct(*keys, value), F.col(AT))
    carry = slice_carry(sliced, _tail=(tail, lambda c: F.last(c)))
    inside = Window.partitionBy(SLICE).orderBy(AT)
    here = F.struct(*keys, value)
    before = F.coalesce("_prev", "_tail")
    same_key = F.struct(*[before[k] for k in keys]) == F.struct(*keys)
    return (
        sliced.withColumn("_prev", F.lag(here).over(inside))
        .join(carry, SLICE)
        .select(*df.columns, F.when(same_key, before[value]).alias(name))
    )


def first_rows(
    df: DataFrame, n: int, time: str, tie: list[str], bucket: str = "hour"
) -> DataFrame:
    """The first ``n`` rows by ``time`` and ``tie``.

    A histogram by ``bucket`` finds the time after which nothing can qualify; only what is left is
    numbered, and no task ever holds ``n`` rows of every partition.
    """
    counts = df.groupBy(F.date_trunc(bucket, time).alias("_bucket")).agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    enough = (
        counts.withColumn("_upto", F.sum("_n").over(upto))
        .where(F.col("_upto") >= n)
        .agg(F.min("_bucket"))
    )
    cut = F.coalesce(enough.scalar(), F.date_trunc(bucket, time))
    # rows without a time come first in the order, so they are candidates whatever the cut
    place = F.date_trunc(bucket, time)
    candidates = df.where(cut.isNull() | place.isNull() | (place <= cut))
    return with_position(candidates, [time, *tie]).where(F.col("pos") <= n)

"""Joining a stream of rows with control rows: latest value and pairing by order of arrival."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.operators.ordering import last_known, with_position
from rivulet.runtime import broadcast_if_small, cut_lineage


def asof_regular(rows: DataFrame, control: DataFrame, every_s: int, time_s: str = "ts_s") -> DataFrame:
    """Each row with the latest control row at or before it; rows before the first tick get the first.

    Ticks lie on multiples of ``every_s`` without gaps, so the as-of join is an equi-join on the tick, and
    rows after the last tick get the last. Ticks with gaps need ``asof_latest``. The control rows are written
    once and broadcast if they are few.
    """
    control = cut_lineage(control)
    first = control.agg(F.min("generation_s")).scalar()
    last = control.agg(F.max("generation_s")).scalar()
    tick = (F.floor(F.col(time_s) / every_s) * every_s).cast("bigint")
    return rows.withColumn("generation_s", F.least(F.greatest(tick, first), last)).join(
        broadcast_if_small(control), "generation_s"
    )


def asof_latest(
    rows: DataFrame, control: DataFrame, value: str, time: str = "ts_s", tie: str = "event_id"
) -> DataFrame:
    """Each row with ``control(generation_s, value)`` of the latest control row at or before it.

    For irregular ticks: both sides are put in one order and the last control row is carried forward.
    Rows before the first control row wait for it and get it.
    """
    picked = F.struct("generation_s", value)
    first = control.agg(F.min_by(picked, F.col("generation_s"))).scalar()
    empty = rows.select(*rows.columns, F.lit(None).alias("_control"), F.lit(1).alias("_side"))
    marks = control.select(
        F.col("generation_s").alias(time), picked.alias("_control"), F.lit(0).alias("_side")
    )
    both = empty.unionByName(marks, allowMissingColumns=True)
    known = last_known(both, "_control", [time, "_side", tie], "_latest").where(F.col("_side") == 1)
    latest = F.coalesce("_latest", first)
    return known.select(
        *rows.columns, latest["generation_s"].alias("generation_s"), latest[value].alias(value)
    ).where(F.col("generation_s").isNotNull())


def threshold_filter(rows: DataFrame, thresholds: str = "thresholds", friends: str = "friends_count") -> DataFrame:
    """Rows with fewer friends than any of the thresholds; a missing count is rejected."""
    return rows.where(F.exists(thresholds, lambda t: F.col(friends) < t))


def pair_generations(generations: DataFrame, tag_rows: DataFrame) -> DataFrame:
    """The k-th distinct generation gets the k-th tag row: ``(generation_s, tick_s, tags)``.

    Generations beyond the last tag row wait, so they are absent.
    """
    seen = with_position(generations.select("generation_s").distinct(), ["generation_s"], name="k")
    offered = with_position(
        tag_rows.select(F.col("generation_s").alias("tick_s"), "tags"), ["tick_s"], name="k"
    )
    return seen.join(offered, "k").select("generation_s", "tick_s", "tags")

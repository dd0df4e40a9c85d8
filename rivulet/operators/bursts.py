"""Event-time windows with observed bounds, and late-row accounting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.operators.ordering import running_max_before


def burst_columns() -> list[Column]:
    interval = F.floor((F.col("end_s") - F.col("start_s")) / 60).cast("bigint")
    # Fixed value: the text form of a window that users of burst reports parse.
    line = F.format_string(
        "TimeWindow{start=%d, end=%d} interval=%d Count: %d Type: (%s)",
        "start_s", "end_s", interval, "cnt", "action",
    )
    return [F.col("start_s"), F.col("end_s"), F.col("cnt"), F.col("action"), interval.alias("interval"), line.alias("line")]


def window_start(time_s: Column | str, size_s: int) -> Column:
    time = F.col(time_s) if isinstance(time_s, str) else time_s
    return (F.floor(time / size_s) * size_s).cast("bigint")


def tumbling_bursts(rows: DataFrame, size_s: int = 60, min_count: int = 100) -> DataFrame:
    """Windows per action with more than ``min_count`` rows; start and end are the observed times."""
    counted = rows.groupBy(window_start("ts_s", size_s).alias("window_s"), "action").agg(
        F.min("ts_s").alias("start_s"), F.max("ts_s").alias("end_s"), F.count(F.lit(1)).alias("cnt")
    )
    return counted.where(F.col("cnt") > min_count).select("window_s", *burst_columns())


def sliding_bursts(
    rows: DataFrame, size_s: int = 60, slide_s: int = 1, min_count: int = 100
) -> DataFrame:
    """As ``tumbling_bursts`` for overlapping windows.

    Rows are first reduced to one per action and slide step; only those are copied into their
    ``size_s / slide_s`` windows. ``size_s`` is a multiple of ``slide_s``.
    """
    if size_s % slide_s:
        raise ValueError("size_s must be a multiple of slide_s")
    steps = rows.groupBy(window_start("ts_s", slide_s).alias("step_s"), "action").agg(
        F.min("ts_s").alias("start_s"), F.max("ts_s").alias("end_s"), F.count(F.lit(1)).alias("cnt")
    )
    starts = F.sequence(F.col("step_s") - (size_s - slide_s), F.col("step_s"), F.lit(slide_s).cast("bigint"))
    merged = (
        steps.withColumn("window_s", F.explode(starts))
        .groupBy("window_s", "action")
        .agg(F.min("start_s").alias("start_s"), F.max("end_s").alias("end_s"), F.sum("cnt").alias("cnt"))
    )
    return merged.where(F.col("cnt") > min_count).select("window_s", *burst_columns())


def with_watermark_before(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``seen_s``, the latest event time that arrived before the row."""
    return running_max_before(rows, "ts_s", order, "seen_s")


def _on_time(delay_s: int, size_s: int) -> Column:
    """Whether the row's window is still open: its last millisecond lies after the watermark."""
    last_ms = (F.col("window_s") + size_s) * 1000 - 1
    watermark_ms = (F.col("seen_s") - delay_s) * 1000
    return F.col("seen_s").isNull() | (last_ms > watermark_ms)


def late_drop_partials(
    rows: DataFrame, delay_s: int, size_s: int, order: list[str], seen_s: Column | None = None
) -> DataFrame:
    """Per tumbling window and action ``start_s, end_s, cnt`` of the rows that arrive in time.

    The watermark follows every single row in arrival ``order``: it is the latest time seen before the
    row less ``delay_s``. A row whose window has closed by then is dropped. ``seen_s`` is the latest time
    seen before all ``rows``, where they go on from earlier ones.
    """
    judged = with_watermark_before(rows, order)
    if seen_s is not None:
        judged = judged.withColumn("seen_s", F.greatest("seen_s", seen_s))
    windowed = judged.withColumn("window_s", window_start("ts_s", size_s)).where(_on_time(delay_s, size_s))
    return windowed.groupBy("window_s", "action").agg(
        F.min("ts_s").alias("start_s"), F.max("ts_s").alias("end_s"), F.count(F.lit(1)).alias("cnt")
    )


def merged_windows(partials: DataFrame, min_count: int = 0) -> DataFrame:
    """Partial windows, put together, of more than ``min_count`` rows."""
    merged = partials.groupBy("window_s", "action").agg(
        F.min("start_s").alias("start_s"), F.max("end_s").alias("end_s"), F.sum("cnt").alias("cnt")
    )
    return merged.where(F.col("cnt") > min_count).select("window_s", *burst_columns())


def late_drop_windows(
    rows: DataFrame, delay_s: int, size_s: int, order: list[str], min_count: int = 0
) -> DataFrame:
    """Tumbling windows of more than ``min_count`` rows over the rows that arrive in time (see ``late_drop_partials``)."""
    counted = late_drop_partials(rows, delay_s, size_s, order)
    return counted.where(F.col("cnt") > min_count).select("window_s", *burst_columns())


def lateness_completeness(
    rows: DataFrame, delays_s: list[int], size_s: int, order: list[str], min_count: int = 0
) -> DataFrame:
    """Per delay: windows and rows kept, against the windows of in-order input.

    One pass over the arrivals; every delay is a conditional count of the same aggregation.
    """
    windowed = with_watermark_before(rows, order).withColumn("window_s", window_start("ts_s", size_s))
    kept = [F.count_if(_on_time(d, size_s)).alias(f"_kept_{d}") for d in delays_s]
    counted = windowed.groupBy("window_s", "action").agg(F.count(F.lit(1)).alias("_all"), *kept)
    per_delay = F.array(
        *[F.struct(F.lit(d).cast("bigint").alias("delay_s"), F.col(f"_kept_{d}").alias("cnt")) for d in delays_s]
    )
    listed = counted.select("_all", F.explode(per_delay).alias("_d")).select("_all", "_d.*")
    kept_window, full_window = F.col("cnt") > min_count, F.col("_all") > min_count
    return listed.groupBy("delay_s").agg(
        F.count_if(kept_window).alias("windows_kept"),
        F.coalesce(F.sum(F.when(kept_window, F.col("cnt"))), F.lit(0)).alias("rows_kept"),
        F.count_if(kept_window & (F.col("cnt") == F.col("_all"))).alias("windows_whole"),
        F.count_if(full_window).alias("windows_in_order"),
        F.coalesce(F.sum(F.when(full_window, F.col("_all"))), F.lit(0)).alias("rows_in_order"),
    )

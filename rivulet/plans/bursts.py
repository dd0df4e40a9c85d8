"""Burst-window and counter queries and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.operators import bursts, counters
from rivulet.plans import frames as fr
from rivulet.plans.frames import DAY, with_sql

ARRIVAL = ["arrival", "event_id"]
DELAYS_S = [0, 6 * 3600, 12 * 3600, 24 * 3600, 72 * 3600, 120 * 3600]


def burst_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bursts.tumbling_bursts(fr.events(spark, sf_dir), DAY, 65)


def burst_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bursts.sliding_bursts(fr.events(spark, sf_dir), 6 * 3600, 3600, 20)


def late_drop_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bursts.late_drop_windows(fr.arrivals(spark, sf_dir), 24 * 3600, DAY, ARRIVAL)


def lateness_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bursts.lateness_completeness(fr.arrivals(spark, sf_dir), DELAYS_S, DAY, ARRIVAL, 40)


def counter_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    deltas = counters.counter_deltas(fr.counters(spark, sf_dir), ["ts_us", "event_id"])
    return deltas.withColumn("delta", F.round("delta", 6))


def counter_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = counters.counter_totals(fr.counters(spark, sf_dir), ["ts_us", "event_id"])
    return totals.select("metric", F.round("total", 6).alias("total"), "n_hosts")


QUERIES = {
    f.__name__: f
    for f in (
        burst_tumbling, burst_sliding, late_drop_windows, lateness_completeness, counter_deltas, counter_totals,
    )
}

BURST_COLUMNS = """window_s, start_s, end_s, cnt, action, (end_s - start_s) // 60 AS interval,
  'TimeWindow{start=' || start_s || ', end=' || end_s || '} interval=' || (end_s - start_s) // 60
    || ' Count: ' || cnt || ' Type: (' || action || ')' AS line"""
_COUNTED = "min(ts_s) AS start_s, max(ts_s) AS end_s, count(*) AS cnt"
_SERIES = "(PARTITION BY host, metric ORDER BY ts_us, event_id)"
SQL_COUNTERS = f"""{fr.SQL_EVENTS},
samples AS (SELECT user_id AS host, action AS metric, ts_us, event_id, value FROM ev)"""

ORACLES = {
    "burst_tumbling": with_sql(
        fr.SQL_EVENTS,
        f"w AS (SELECT ts_s // {DAY} * {DAY} AS window_s, action, {_COUNTED} FROM ev GROUP BY ALL)",
        select=f"SELECT {BURST_COLUMNS} FROM w WHERE cnt > 65",
    ),
    "burst_sliding": with_sql(
        fr.SQL_EVENTS,
        """copies AS (
          SELECT action, ts_s, ts_s // 3600 * 3600 - 3600 * unnest(range(0, 6)) AS window_s FROM ev)""",
        f"w AS (SELECT window_s, action, {_COUNTED} FROM copies GROUP BY window_s, action)",
        select=f"SELECT {BURST_COLUMNS} FROM w WHERE cnt > 20",
    ),
    "late_drop_windows": with_sql(
        fr.SQL_ARRIVALS,
        f"""w AS (SELECT window_s, action, {_COUNTED} FROM seen
          WHERE seen_s IS NULL OR (window_s + {DAY}) * 1000 - 1 > (seen_s - {24 * 3600}) * 1000
          GROUP BY window_s, action)""",
        select=f"SELECT {BURST_COLUMNS} FROM w",
    ),
    "lateness_completeness": with_sql(
        fr.SQL_ARRIVALS,
        f"delays AS (SELECT unnest({DELAYS_S})::BIGINT AS delay_s)",
        "full_w AS (SELECT window_s, action, count(*) AS n FROM seen GROUP BY ALL)",
        f"""kept_w AS (SELECT delay_s, window_s, action, count(*) AS n FROM seen, delays
          WHERE seen_s IS NULL OR (window_s + {DAY}) * 1000 - 1 > (seen_s - delay_s) * 1000 GROUP BY ALL)""",
        """per AS (
          SELECT delays.delay_s, f.n AS n_full, coalesce(k.n, 0) AS n_kept
          FROM delays, full_w f LEFT JOIN kept_w k
            ON k.delay_s = delays.delay_s AND k.window_s = f.window_s AND k.action = f.action)""",
        select="""SELECT delay_s, count(*) FILTER (n_kept > 40) AS windows_kept,
          coalesce(sum(n_kept) FILTER (n_kept > 40), 0)::BIGINT AS rows_kept,
          count(*) FILTER (n_kept > 40 AND n_kept = n_full) AS windows_whole,
          count(*) FILTER (n_full > 40) AS windows_in_order,
          coalesce(sum(n_full) FILTER (n_full > 40), 0)::BIGINT AS rows_in_order
          FROM per GROUP BY delay_s""",
    ),
    "counter_deltas": with_sql(
        SQL_COUNTERS,
        select=f"""SELECT host, metric, ts_us, event_id, value,
          round(value - lag(value) OVER {_SERIES}, 6) AS delta FROM samples""",
    ),
    "counter_totals": with_sql(
        SQL_COUNTERS,
        f"""ends AS (
          SELECT host, metric,
            last_value(value) OVER {_SERIES.replace(')', ' ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)')}
              - first_value(value) OVER {_SERIES} AS grown,
            row_number() OVER {_SERIES} AS k
          FROM samples)""",
        select="""SELECT metric, round(sum(grown), 6) AS total, count(*) AS n_hosts FROM ends WHERE k = 1
          GROUP BY metric""",
    ),
}

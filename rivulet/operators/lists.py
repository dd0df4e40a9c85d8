"""Grouping values in long form: one row per key and value, however large a key is."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def counted_values(df: DataFrame, key: str, value: str) -> DataFrame:
    """Distinct values per ``key``: ``(key, value, times, n_rows, n_values)``.

    Repeats are counted before the shuffle by key, and no task or row ever holds a whole key. A hot key
    is a skewed join here, which adaptive execution splits.
    """
    counted = df.groupBy(key, value).agg(F.count(F.lit(1)).alias("times"))
    totals = counted.groupBy(key).agg(F.sum("times").alias("n_rows"), F.count(F.lit(1)).alias("n_values"))
    return counted.join(totals, key)

"""Counters sampled over time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.operators.ordering import previous_value


def counter_deltas(samples: DataFrame, order: list[str]) -> DataFrame:
    """Each sample of ``(host, metric, …, value)`` with its change since the series' previous sample."""
    before = previous_value(samples, "value", ["host", "metric"], order, "_before")
    return before.withColumn("delta", F.col("value") - F.col("_before")).drop("_before")


def counter_totals(samples: DataFrame, order: list[str]) -> DataFrame:
    """Per metric, last minus first value of every host, summed over the hosts."""
    when = F.struct(*order)
    grown = F.max_by("value", when) - F.min_by("value", when)
    per_host = samples.groupBy("host", "metric").agg(grown.alias("_grown"))
    return per_host.groupBy("metric").agg(F.sum("_grown").alias("total"), F.count(F.lit(1)).alias("n_hosts"))

"""Batch outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.functions.text import flatten_newlines


def text_sink(df: DataFrame, path: str, value: str, key: str | None = None) -> None:
    """``key TAB value`` per line, or the value alone."""
    line: Column = F.col(value) if key is None else F.concat_ws("\t", F.col(key), F.col(value))
    df.select(line.alias("value")).write.text(path)


def delimited_sink(df: DataFrame, path: str, sep: str = "|", max_rows_per_file: int = 50_000) -> None:
    """Delimited files that roll over after ``max_rows_per_file`` rows; newlines in text become spaces."""
    flat = [
        flatten_newlines(name).alias(name) if kind == "string" else F.col(name) for name, kind in df.dtypes
    ]
    (
        df.select(*flat)
        .write.option("sep", sep)
        .option("maxRecordsPerFile", max_rows_per_file)
        .option("emptyValue", "")
        .csv(path)
    )

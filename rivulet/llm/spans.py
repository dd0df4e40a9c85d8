"""Candidate spans of texts, found with DataFrame functions only.

A generator is a regular expression. Splitting a text by it gives what lies between the matches, extracting
gives the matches; their lengths, summed along the text, are the offsets. Offsets count code points and
ends are exclusive. Matches become rows, so nothing grows with the square of their number.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Code points of context kept on each side of a candidate.
CONTEXT = 32


@dataclass(frozen=True)
class Generator:
    """``pattern`` must match at least one character; ``hint`` is a cheap pattern without which it cannot match."""

    kind: str
    pattern: str
    hint: str


def candidates(docs: DataFrame, generators: list[Generator], id: str, text: str, *extra: str) -> DataFrame:
    """Rows ``_id, _hash, _kind, _start, _end, _value, _before, _after`` and ``extra`` columns.

    ``_hash`` tells texts of one id apart; equal rows of ``docs`` give their candidates once. Null and
    empty texts have none. A candidate of a kind never overlaps another of its kind.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(id).alias("_id"), F.xxhash64(body).alias("_hash"), body.alias("_text"), *extra)
    nothing = F.array().cast("array<string>")

    def found(generator: Generator) -> Column:
        usable = F.col("_text").rlike(generator.hint)
        matches = F.regexp_extract_all("_text", F.lit(generator.pattern), F.lit(0))
        between = F.split("_text", generator.pattern, -1)
        pieces = F.struct(
            F.when(usable, matches).otherwise(nothing).alias("values"), F.when(usable, between).otherwise(nothing).alias("gaps")
        )

        def cells(both: Column) -> Column:
            return F.transform(
                both["values"],
                lambda value, at: F.struct(
                    F.lit(generator.kind).alias("_kind"),
                    at.alias("_at"),
                    value.alias("_value"),
                    F.length(both["gaps"][at]).alias("_gap"),
                    F.right(both["gaps"][at], F.lit(CONTEXT)).alias("_before"),
                    F.left(F.coalesce(both["gaps"][at + 1], F.lit("")), F.lit(CONTEXT)).alias("_after"),
                ),
            )

        # through an array of one item, else the text would be split again for every match
        return F.transform(F.array(pieces), cells)[0]

    cells = F.concat(*[found(generator) for generator in generators])
    flat = rows.select("_id", "_hash", *extra, F.inline(cells))
    once = flat.repartition("_id", "_hash").dropDuplicates(["_id", "_hash", "_kind", "_at"])
    along = Window.partitionBy("_id", "_hash", "_kind").orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("_gap") + F.length("_value")).over(along).cast("int")
    return once.withColumn("_end", end).select(
        "_id", "_hash", *extra, "_kind", (F.col("_end") - F.length("_value")).alias("_start"), "_end", "_value", "_before", "_after"
    )


def ids(docs: DataFrame, id: str, text: str) -> DataFrame:
    """``_id`` and ``_hash`` of every row, to put results beside documents without a candidate."""
    return docs.select(F.col(id).alias("_id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("_hash"))


def beside(every: DataFrame, results: DataFrame) -> DataFrame:
    """Every row of ``every`` with its row of ``results``, also where the id is null."""
    right = results.withColumnsRenamed({"_id": "_rid", "_hash": "_rhash"})
    return every.join(right, F.col("_id").eqNullSafe(F.col("_rid")) & (F.col("_hash") == F.col("_rhash")), "left").drop("_rid", "_rhash")


def share(text: Column, pattern: str) -> Column:
    """The share of the characters of ``text`` that ``pattern`` covers; 0 for an empty text."""
    return F.when(F.length(text) > 0, 1 - F.length(F.regexp_replace(text, pattern, "")) / F.length(text)).otherwise(0.0)


def changes(text: Column) -> Column:
    """How often the kind of character (lower, upper, digit, other) changes along ``text``, per character."""
    runs = F.regexp_count(text, F.lit("[a-z]+|[A-Z]+|[0-9]+|[^a-zA-Z0-9]+"))
    return F.when(F.length(text) > 0, runs / F.length(text)).otherwise(0.0)


def variety(text: Column) -> Column:
    """Distinct characters over all characters."""
    return F.when(F.length(text) > 0, F.size(F.array_distinct(F.split(text, ""))) / F.length(text)).otherwise(0.0)

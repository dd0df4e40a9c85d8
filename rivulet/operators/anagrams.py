"""Anagram grouping: same letters, different words."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.functions.text import letter_key
from rivulet.operators.ordering import with_position
from rivulet.runtime import cut_lineage


def anagram_groups(words: DataFrame, column: str = "word") -> DataFrame:
    """Words of groups of at least two: ``(letter_key, word, n_words)``, a row per distinct word.

    Words are made distinct before their letters are sorted, so each is sorted once.
    """
    keyed = words.select(F.col(column).alias("word")).distinct().withColumn("letter_key", letter_key("word"))
    sizes = keyed.groupBy("letter_key").agg(F.count(F.lit(1)).alias("n_words")).where("n_words > 1")
    return keyed.join(sizes, "letter_key").select("letter_key", "word", "n_words")


def anagram_ranked(groups: DataFrame) -> DataFrame:
    """Groups numbered by size, largest first, ties by key: ``(place, letter_key, n_words)``."""
    sizes = groups.select("letter_key", "n_words").distinct()
    return with_position(sizes, [F.desc("n_words"), "letter_key"], name="place")


def anagram_lines(groups: DataFrame) -> DataFrame:
    """One text line per group, sorted words separated by a space, with its place in the output.

    A line holds its group, so this last step gathers a group's words; nothing before it does. The groups
    are written once, since the order of the groups is worked out from them first.
    """
    groups = cut_lineage(groups)
    placed = groups.join(anagram_ranked(groups).select("place", "letter_key"), "letter_key")
    lines = placed.groupBy("place").agg(F.sort_array(F.collect_list("word")).alias("words"))
    return lines.select("place", F.array_join("words", " ").alias("line"))

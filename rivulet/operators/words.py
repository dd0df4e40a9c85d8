"""Words of tweets per generation and their popularity."""

from __future__ import annotations

from string import ascii_letters, digits

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructType

from rivulet.functions.text import before_mention, clean_words, contains_any, flatten_newlines
from rivulet.operators.control import pair_generations, threshold_filter
from rivulet.operators.ordering import first_rows, with_position
from rivulet.runtime import broadcast_if_small, cut_lineage

#: Texts are cut and counted in pieces of so many bytes, which bounds what a worker holds.
CUT_BYTES = 16 << 20

#: What a byte of a text becomes: a sign of a word in lower case, a gap, or 0 where it is dropped.
_CLEANED = np.zeros(256, np.uint8)
_CLEANED[list((ascii_letters + digits + "-").encode())] = list((ascii_letters + digits + "-").lower().encode())
_CLEANED[list(b" \t\n\v\f\r")] = ord(" ")
_CLEANED[0xFF] = ord("\n")  # no byte of UTF-8: set after each row
_ROW_END = pa.scalar(b"\xff", pa.large_binary())
#: Of an integer of eight bytes, the first so many.
_FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def tag_filter(tweets: DataFrame, pairs: DataFrame) -> DataFrame:
    """Tweets whose text contains a tag of their generation; one row each, stamped with the tag tick.

    The pairs are written once and broadcast if they are few, so a hot generation stays spread.
    """
    tagged = tweets.join(broadcast_if_small(cut_lineage(pairs)), "generation_s").where(contains_any("text", F.col("tags")))
    return tagged.drop("generation_s", "tags").withColumnRenamed("tick_s", "generation_s")


def tweet_words(
    tweets: DataFrame, stop: DataFrame | list[str], text: str = "text", times: str | None = None
) -> DataFrame:
    """One row ``word`` per kept word, with the other columns of ``tweets``.

    Words from the first token that starts with ``@`` on are dropped, then stop words, words that start
    with ``http`` and words without a letter. With ``times`` the equal words of neighbouring rows with equal other
    columns are one row, and ``times`` says how many they are; a word may still come several times.
    """
    others = [c for c in tweets.columns if c != text]
    if times:
        alike = F.struct(*others) if others else F.struct(F.lit(0))
        cut = tweets.select(*others, _word_times(before_mention(text), alike).alias("_words"))
        found = cut.select(*others, F.explode("_words").alias("_w"))
        words = found.select(*others, F.col("_w.word").alias("word"), F.col("_w.times").alias(times))
    else:
        split = tweets.select(*others, F.explode(clean_words(before_mention(text))).alias("word"))
        has_letter = F.col("word") != F.upper("word")  # words are lower case by now
        words = split.where(has_letter & ~F.startswith("word", F.lit("http")))
    if isinstance(stop, list):
        return words.where(~F.col("word").isin(stop)) if stop else words
    return words.join(broadcast_if_small(stop.select("word").distinct()), "word", "left_anti").select(*words.columns)


def _word_times(text: pa.Array, alike: pa.Array) -> pa.Array:
    """Words with a letter, but none that start with ``http``, and how often they come in the rows with equal ``alike``.

    The first of such rows in a piece carries the counts, the others get no words.
    """
    text = pc.fill_null(text, "")
    piece = np.cumsum(pc.binary_length(text).to_numpy(zero_copy_only=False).astype(np.int64)) // CUT_BYTES
    starts = np.flatnonzero(np.diff(piece, prepend=-1)).tolist()
    parts = [_piece_times(text[i:j], _numbers(alike[i:j])) for i, j in zip(starts, [*starts[1:], len(text)])]
    return pa.concat_arrays(parts or [_piece_times(text, _numbers(alike))])


# A row's words depend on the rows beside it: Spark may neither run the step twice nor drop rows before it.
_word_times = F.arrow_udf(
    _word_times, ArrayType(StructType().add("word", StringType()).add("times", LongType()))
).asNondeterministic()


def _piece_times(text: pa.Array, alike: np.ndarray) -> pa.Array:
    """The bytes of a piece are cleaned together; words become numbers, and what is done for every word works on these."""
    words, number, found = _numbered_words(text)
    keep = pc.and_not(pc.match_substring_regex(words, "[a-z]"), pc.starts_with(words, "http")).to_numpy(zero_copy_only=False)
    words, number = words.filter(pa.array(keep)), np.where(keep, np.cumsum(keep) - 1, -1)[number]
    _, first, group = np.unique(alike, return_index=True, return_inverse=True)
    at, kept, width = np.repeat(group, found), number >= 0, max(len(words), 1)
    cells = at[kept] * width + number[kept]
    if len(first) * width <= 4 * len(cells):  # most pairs of group and word occur
        counts = np.bincount(cells)
        cells = np.flatnonzero(counts)
        counts = counts[cells]
    else:
        cells, counts = np.unique(cells, return_counts=True)
    order = np.argsort(first[cells // width], kind="stable")  # lists lie in the order of the rows
    cells, counts = cells[order], counts[order]
    sizes = np.bincount(first[cells // width], minlength=len(text))
    pairs = pa.StructArray.from_arrays([words.take(pa.array(cells % width)), pa.array(counts, pa.int64())], ["word", "times"])
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), pairs)


def _numbered_words(text: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The different lower-cased words of ``text``, the number of each word in turn, and how many a row has.

    A word of at most eight bytes is told by these bytes as one integer, longer ones as strings.
    """
    lines = pc.binary_join_element_wise(text.cast(pa.large_binary()), pa.scalar(b"", pa.large_binary()), _ROW_END)
    edges = np.frombuffer(lines.buffers()[1], np.int64)[lines.offset :][: len(lines) + 1]
    if not len(lines):
        return pa.array([], pa.string()), np.empty(0, np.int64), np.empty(0, np.int64)
    signs = _CLEANED[np.frombuffer(lines.buffers()[2], np.uint8)[edges[0] : edges[-1]]]
    signs = signs[signs != 0]
    rows = np.flatnonzero(signs == ord("\n"))
    inside = np.concatenate(([False], signs > ord(" ")))
    borders = np.flatnonzero(inside[1:] != inside[:-1])
    starts, sizes = borders[::2], borders[1::2] - borders[::2]
    found = np.diff(np.searchsorted(starts, rows), prepend=0)

    eight = np.ndarray(len(signs), "<u8", np.append(signs, np.zeros(8, np.uint8)), strides=(1,))
    long = np.flatnonzero(sizes > 8)
    coded = eight[starts] & _FIRST_BYTES[np.minimum(sizes, 8)]
    coded[long] = 0  # no word has no bytes
    short = pa.array(coded).dictionary_encode()
    number = short.indices.to_numpy().astype(np.int64)
    ends = np.cumsum(sizes[long])
    at = np.repeat(starts[long] - (ends - sizes[long]), sizes[long]) + np.arange(ends[-1] if len(long) else 0)
    offsets = pa.py_buffer(np.append(0, ends).astype(np.int64))
    strings = pa.Array.from_buffers(pa.large_string(), len(long), [None, offsets, pa.py_buffer(signs[at])]).dictionary_encode()
    number[long] = strings.indices.to_numpy().astype(np.int64) + len(short.dictionary)
    plain = pa.array(short.dictionary.to_numpy().view("S8")).cast(pa.string())
    return pa.concat_arrays([plain, strings.dictionary.cast(pa.string())]), number, found


def _numbers(column: pa.Array) -> np.ndarray:
    """A number per row, the same only for equal values: of a struct all fields; of values without an order, none are equal."""
    if not pa.types.is_struct(column.type):
        try:
            return column.dictionary_encode("encode").indices.to_numpy()
        except pa.ArrowNotImplementedError:
            return np.arange(len(column))
    numbers = column.is_valid().to_numpy(zero_copy_only=False).astype(np.int64)
    for field in column.flatten():
        inner = _numbers(field)
        _, numbers = np.unique(numbers * (inner.max(initial=0) + 1) + inner, return_inverse=True)
    return numbers


def generation_word_counts(words: DataFrame, *also: str, times: str | None = None) -> DataFrame:
    """``(generation_s, word, cnt)``, optionally per further columns such as the flush they belong to.

    A row stands for one word, or for as many as its column ``times`` says. Such rows were counted where they were cut,
    so they go by word to the task that adds them up, also over the flushes, without being added up before.
    """
    words = words.repartition("generation_s", "word") if times else words
    return words.groupBy("generation_s", "word", *also).agg((F.sum(times) if times else F.count(F.lit(1))).alias("cnt"))


def generation_word_totals(partial: DataFrame, count_flushes: bool = False) -> DataFrame:
    """Partial counts summed per word; ``count_flushes`` counts the partial rows instead."""
    total = F.count(F.lit(1)) if count_flushes else F.sum("cnt")
    return partial.groupBy("generation_s", "word").agg(total.alias("cnt"))


def popular_words(counts: DataFrame) -> DataFrame:
    """The more frequent half of each generation's words, at least one: ``(generation_s, place, word, cnt)``.

    Ties by word. Half of an odd number is rounded down.
    """
    placed = with_position(counts, [F.desc("cnt"), "word"], ["generation_s"], "place", size="_n")
    keep = F.greatest(F.floor(F.col("_n") / 2), F.lit(1))
    return placed.where(F.col("place") <= keep).select("generation_s", "place", "word", "cnt")


def popular_lines(popular: DataFrame) -> DataFrame:
    """Text lines ``generation word word …``, one per generation, in order of place."""
    lines = popular.groupBy("generation_s").agg(F.sort_array(F.collect_list(F.struct("place", "word"))).alias("_words"))
    return lines.select("generation_s", F.concat_ws(" ", F.col("generation_s"), "_words.word").alias("line"))


def popular_words_pipeline(
    tweets: DataFrame, tags: DataFrame, stop: DataFrame | list[str]
) -> tuple[DataFrame, DataFrame]:
    """From tweets with their thresholds to ``(popular words, tag-filtered tweets)``.

    The filtered tweets feed both outputs, so they are written once.
    """
    accepted = threshold_filter(tweets)
    pairs = pair_generations(accepted, tags)
    tagged = cut_lineage(tag_filter(accepted.select("generation_s", "event_id", "text"), pairs))
    words = tweet_words(tagged.select("generation_s", "text"), stop, times="times")
    return popular_words(generation_word_counts(words, times="times")), tagged


def collect_first(tweets: DataFrame, n: int = 200_000, time: str = "ts", id: str = "event_id") -> DataFrame:
    """The first ``n`` tweets by time, as single-line text."""
    flat = tweets.withColumn("text", flatten_newlines("text"))
    return first_rows(flat, n, time, [id])

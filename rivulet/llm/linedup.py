"""Removal of repeated lines through per-document keep bitmaps, with DataFrame functions only.

Lines become hashes; the rows (hash, document, position) are range-partitioned and sorted by all three,
so a line that a third of all documents hold spreads over many slices. Inside a slice the first
occurrence streams along the order; across slices one small row per slice carries the last line on.
What comes back per document is a bitmap of dropped positions in sparse 64-bit words, never text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.operators.ordering import AT, SLICE, ordered_slices, slice_carry

BLANKS = "\t\n\x0b\x0c\r "
MIN_CHARS = 10
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lines_of(text: Column) -> Column:
    """The lines between newlines; null and empty texts are one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """The line without outer blanks and with A-Z in lower case; other letters stay as they are."""
    return F.translate(F.trim(line, F.lit(BLANKS)), _UPPER, _LOWER)


def dropped_lines(docs: DataFrame, id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """Per document with something to drop: ``id``, ``n_dropped`` and ``dropped`` (map of word number to bits).

    A key of at least ``min_chars`` code points in two or more documents stays only in the smallest id
    that holds it. Keys are compared by 96 bits of hash. Rows without an id take no part: nothing
    of theirs is dropped. Repeated ids count as one document.
    """
    keyed = docs.where(F.col(id).isNotNull()).select(
        F.col(id).alias("_doc"), F.posexplode(F.transform(lines_of(F.col(text)), line_key)).alias("_pos", "_key")
    )
    hashed = keyed.where(F.length("_key") >= min_chars).select(
        F.xxhash64("_key").alias("_h1"), F.hash("_key").alias("_h2"), "_doc", "_pos"
    )
    sliced = ordered_slices(hashed, "_h1", "_h2", "_doc", "_pos").withColumn("_line", F.struct("_h1", "_h2"))
    order = Window.partitionBy(SLICE).orderBy(AT)
    # lines ascend along the order, so the newest first occurrence is also the largest one
    opens = F.when(
        F.coalesce(F.lag("_line").over(order) != F.col("_line"), F.lit(True)), F.struct("_line", "_doc")
    )
    streamed = sliced.withColumn("_opens", opens).withColumn(
        "_first", F.max("_opens").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    # of the largest line of the earlier slices, the smallest document; it may run on into this slice
    carried = slice_carry(sliced, _tail=(F.max(F.struct("_line", (-F.col("_doc")).alias("_minus"))), F.max))
    origin = F.when(F.col("_tail._line") == F.col("_line"), -F.col("_tail._minus")).otherwise(F.col("_first._doc"))
    repeated = streamed.join(carried, SLICE).where(F.col("_doc") != origin)
    words = repeated.groupBy("_doc", F.shiftright("_pos", 6).alias("_word")).agg(
        F.bit_or(F.expr("shiftleft(1L, _pos % 64)")).alias("_bits")
    )
    return words.groupBy("_doc").agg(
        F.sum(F.bit_count("_bits")).cast("long").alias("n_dropped"),
        F.map_from_entries(F.collect_list(F.struct("_word", "_bits"))).alias("dropped"),
    ).withColumnRenamed("_doc", id)


def dedup_lines(docs: DataFrame, id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` with repeated lines removed from ``text``, plus ``n_lines`` (before) and ``n_dropped``.

    All other columns stay, but columns named like the two counts are replaced. A null text becomes
    an empty one; an empty table gives an empty table.
    """
    bitmaps = dropped_lines(docs, id, text, min_chars).select(
        F.col(id).alias("_id"), F.col("n_dropped").alias("_n"), F.col("dropped").alias("_bits")
    )
    rows = docs.select(F.struct("*").alias("_row"), F.col(id).alias("_doc"))
    lines = lines_of(F.col("_row")[text])
    kept = F.filter(
        lines,
        lambda line, at: F.expr("_bits").isNull()
        | (_bit(F.coalesce(F.expr("_bits")[F.shiftright(at, 6)], F.lit(0).cast("long")), at) == 0),
    )
    others = [F.col("_row")[c].alias(c) for c in docs.columns if c not in (text, "n_lines", "n_dropped")]
    return rows.join(bitmaps, F.col("_doc") == F.col("_id"), "left").select(
        *others,
        F.array_join(kept, "\n").alias(text),
        F.size(lines).cast("long").alias("n_lines"),
        F.coalesce("_n", F.lit(0)).cast("long").alias("n_dropped"),
    )


def _bit(word: Column, at: Column) -> Column:
    return F.call_function("getbit", word, at % 64)

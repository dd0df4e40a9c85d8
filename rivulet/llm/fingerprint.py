"""Homomorphic multiset fingerprints of documents.

A text is the multiset of its units: its paragraphs (lines), inside a paragraph its sentences, and of a
sentence of many words runs of words that end where the words themselves say so, so that an edit inside a
paragraph leaves the rest of it in place, also where a text has few sentences or none. Every unit is hashed to a wide vector
of small numbers, and a fingerprint is the sum of the vectors modulo 2^32 in every lane. Order does
not matter, equal multisets give equal fingerprints, and ``combine`` inserts or deletes units without
the text. Lanes are signed and centred, so the cosine of two fingerprints estimates how much of the
two multisets is common; ``likeness`` gives it, cut to 0..1. A unit adds at most 128 to a lane, so no
lane wraps below 2^24 units.

A null text counts as empty; the empty multiset has the zero fingerprint. Repeated rows keep their
own, equal fingerprints.
"""

import base64
import hashlib
import re
from collections.abc import Iterable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.operators.ordering import SLICE, ordered_slices
from rivulet.runtime import shuffle_width

LANES = 256
SLICES_PER_PARTITION = 4
#: Sentences of more words, or words of more code points, are cut; a word in so many ends a run; pieces of a word.
LONG_SENTENCE, LONG_WORD, RUN, PIECE = 4, 64, 3, 32
_units = re.compile(r"\n+|(?<=[.!?])[ \t]+").split
_EMPTY = np.zeros(LANES, dtype="<u4")


def units(text: str | None) -> list[str]:
    """The multiset of a text; white space around a unit does not count, blank units neither."""
    found: list[str] = []
    for piece in _units(text or ""):
        words = piece.split()
        if len(words) > LONG_SENTENCE or len(piece) > LONG_WORD:
            found += _runs(words)
        elif words:
            found.append(piece.strip())
    return found


def _runs(words: list[str]) -> list[str]:
    """Runs of words, each up to a word whose checksum ends a run; a long word is a run of pieces."""
    found, open_run = [], []
    for word in words:
        if len(word) > LONG_WORD:
            found += [word[at : at + PIECE] for at in range(0, len(word), PIECE)]
            continue
        open_run.append(word)
        if crc32(word.encode()) % RUN == 0:
            found.append(" ".join(open_run))
            open_run = []
    return [*found, " ".join(open_run)] if open_run else found


def vector(members: Iterable[str]) -> np.ndarray:
    """The sum of the members' vectors modulo 2^32."""
    hashed = b"".join(hashlib.shake_128(member.encode()).digest(LANES) for member in members)
    if not hashed:
        return _EMPTY
    rows = np.frombuffer(hashed, dtype=np.int8).reshape(-1, LANES)
    return rows.sum(axis=0, dtype=np.int64).astype("<u4")


def combine(base: np.ndarray, inserted: Iterable[str] = (), deleted: Iterable[str] = ()) -> np.ndarray:
    """The fingerprint after units were inserted and deleted."""
    return base + vector(inserted) - vector(deleted)


def likeness(left: np.ndarray, right: np.ndarray) -> float:
    """1.0 for equal fingerprints, else the cosine of the signed lanes, at least 0."""
    if np.array_equal(left, right):
        return 1.0
    a, b = left.view("<i4").astype(np.float64), right.view("<i4").astype(np.float64)
    size = float(np.sqrt((a @ a) * (b @ b)))
    return min(1.0, max(0.0, float(a @ b) / size)) if size else 0.0


def to_text(fingerprint: np.ndarray) -> str:
    return base64.b64encode(fingerprint.tobytes()).decode()


def from_text(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), dtype="<u4")


def fingerprints(docs: DataFrame, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint of ``text`` in base64 as column ``name`` (replaced if it exists)."""
    kept = [c for c in docs.columns if c != name]

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            made = [to_text(vector(units(value))) for value in part.column("_text").to_pylist()]
            columns = [part.column(i) for i in range(len(kept))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(made, pa.string())], names=[*kept, name])

    fields = docs.select(*kept).withColumn(name, F.lit("")).schema
    return docs.select(*kept, F.col(text).alias("_text")).mapInArrow(batches, fields)


def in_order(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows ``_slice, _turn, _key, _id, _text``, partitioned by slice and sorted, so that each row of turn 0 is
    directly followed by the one that follows it by ``id`` in the whole table (the last by the first).

    Only the ids are sorted to find slices of equal size; texts are shuffled once, to their slice. The
    row that opens a slice is also sent to the end of the slice before it (turn 1), the first row of all
    to the end of the last (turn 2). A missing id comes first; equal ids follow each other in the order
    of their texts. A table of one row is its own successor. Ids are integers.
    """
    key = F.coalesce(F.col(id), F.lit(-(2**62))).cast("long")
    width = shuffle_width(docs.sparkSession)
    sliced = ordered_slices(docs.select(key.alias("_key")).distinct(), "_key", slices=SLICES_PER_PARTITION * width)
    # one number per slice; their count is set by the session, not by the table
    starts = np.array(sorted(row[1] for row in sliced.groupBy(SLICE).agg(F.min("_key")).collect()), dtype=np.int64)

    def place(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            keys = part.column(0).to_numpy()
            home = np.searchsorted(starts, keys, side="right") - 1
            yield _with(part, home, np.zeros_like(home))
            opens = np.flatnonzero(starts[home] == keys)
            before = home[opens] - 1
            guests = part.take(pa.array(opens))
            yield _with(guests, np.where(before < 0, len(starts) - 1, before), np.where(before < 0, 2, 1))

    kind = docs.schema[id].dataType.simpleString()
    rows = docs.select(key.alias("_key"), F.col(id).alias("_id"), F.coalesce(text, F.lit("")).alias("_text"))
    placed = rows.mapInArrow(place, f"_slice long, _turn long, _key long, _id {kind}, _text string")
    return placed.repartition(width, "_slice").sortWithinPartitions("_slice", "_turn", "_key", "_text")


def _with(part: pa.RecordBatch, slices: np.ndarray, turns: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array(slices, pa.int64()), pa.array(turns, pa.int64()), *part.columns]
    return pa.RecordBatch.from_arrays(columns, names=["_slice", "_turn", "_key", "_id", "_text"])


RESULT = {
    "n_chars": pa.int64(), "edited_sha256": pa.string(), "fingerprint": pa.string(), "edited_fingerprint": pa.string(),
    "near_edited": pa.float64(), "near_next": pa.float64(),
}


def compare_edits(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each text against itself with the second half replaced from the following text.

    Gives ``id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``. The
    last floor(n_chars / 2) code points give way to the first as many (or all) of the next document.
    """

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # slice, turn, id, text and fingerprint of the row before
        for part in parts:
            ids, out = [], []
            for slice_, turn, _, own, value in zip(*(c.to_pylist() for c in part.columns), strict=True):
                mine = vector(units(value))
                if held is not None and held[:2] == (slice_, 0):
                    ids.append(held[2])
                    out.append(_compared(held[3], held[4], value, mine))
                held = (slice_, turn, own, value, mine)
            columns = list(zip(*out, strict=True)) or [()] * len(RESULT)
            made = [pa.array(c, k) for c, k in zip(columns, RESULT.values(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, part.schema.field(3).type), *made], names=[id, *RESULT])

    kind = docs.schema[id].dataType.simpleString()
    return in_order(docs, id, text).mapInArrow(
        batches,
        f"`{id}` {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )


def _compared(text: str, own: np.ndarray, after: str, following: np.ndarray) -> tuple:
    half = len(text) // 2
    edited = text[: len(text) - half] + after[:half]
    other = own if edited == text else vector(units(edited))
    digest = hashlib.sha256(edited.encode()).hexdigest()
    return len(text), digest, to_text(own), to_text(other), likeness(own, other), likeness(own, following)

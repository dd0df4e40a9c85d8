"""Byte-level BPE encoding and decoding by longest match with backtracking.

Bytes are mapped to Latin-1 characters, so an Aho-Corasick automaton over ``str`` finds the longest
vocabulary entry at every byte of a piece. The encoder takes longest matches from the left and steps
back to a shorter entry where the new token could not stand beside the previous one after the merges.
Whether two tokens may be adjacent is decided once per pair and memoised, a byte that cannot end a
valid prefix is marked and never visited again, so the work is linear in the piece.

Rules of the batch functions: a null text counts as empty, an empty text has no ids; unknown ids fail.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.workers import tidy

#: Entries of each memo of a Python worker; a full memo forgets, which costs time only.
MEMO_ENTRIES = 400_000
#: Rows of an Arrow batch that are encoded at a time.
ROWS = 500

#: A space at an end of the text or beside more white space: such texts are split by the pattern alone.
_BLANK_BESIDE_SPACE = regex.compile(r"\A\s|\s\Z|\s |\x20\s").search


class Decoder:
    """Bytes of ids under a rank file: one line per token, its bytes in base64 and its rank."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.bytes_of = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.bytes_of[rank] = token

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))

    def decode_batch(self, ids: pa.ListArray) -> pa.Array:
        flat = ids.flatten().to_numpy(zero_copy_only=False)
        ends = np.cumsum(ids.value_lengths().to_pylist(), dtype=np.int64)
        return pa.array(map(self.decode, np.split(flat, ends[:-1])) if len(ids) else [], pa.binary())


class Codec(Decoder):
    """Ids of texts under a rank file and the pattern that cuts texts into pieces."""

    def __init__(self, path: str, pattern: str):
        super().__init__(path)
        self._pieces = regex.compile(pattern).findall
        self._split: dict[int, tuple[int, int]] = {}
        self._merged: dict[tuple[int, int], int] = {}
        self._automaton = ahocorasick.Automaton()
        for token, rank in sorted(self.ranks.items(), key=lambda entry: entry[1]):
            if len(token) > 1:
                halves = self._last_halves(token, rank)
                if halves is None:
                    continue  # no order of merges makes it; only a whole piece can be this token
                self._split[rank] = halves
                self._merged[halves] = rank
            else:
                self._split[rank] = (rank, rank)
            self._automaton.add_word(token.decode("latin-1"), rank)
        self._automaton.make_automaton()
        self._sizes = [len(token) for token in self.bytes_of]
        self._widest = max(self._sizes)
        self._first: dict[str, int] = {}
        self._shorter: dict[int, int] = {}
        self._beside: dict[tuple[int, int], bool] = {}
        self._memo: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}

    def _last_halves(self, token: bytes, rank: int) -> tuple[int, int] | None:
        """The two tokens whose merge is ``token``, or None when lower merges do not lead to two parts."""
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            best = min(
                (self.ranks.get(parts[i] + parts[i + 1], rank), i) for i in range(len(parts) - 1)
            )
            if best[0] >= rank:
                return None
            i = best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        halves = tuple(self.ranks.get(part) for part in parts)
        return None if None in halves or any(half not in self._split for half in halves) else halves

    def _adjacent(self, left: int, right: int) -> bool:
        """Whether the merges leave ``left`` and ``right`` as they are when they stand side by side.

        Undoes the later merge of the two sides step by step; if the parts that then touch would have
        merged before the undone merge took place, the two tokens never meet.
        """
        key = (left, right)
        known = self._beside.get(key)
        if known is None:
            if len(self._beside) >= MEMO_ENTRIES:
                self._beside.clear()
            known = self._beside[key] = self._never_merges(left, right)
        return known

    def _never_merges(self, left: int, right: int) -> bool:
        before = len(self.bytes_of)  # only a merge of a lower rank counts
        while True:
            joined = self._merged.get((left, right))
            if joined is not None and joined < before:
                return False
            inner_left, inner_right = self._split[left][1], self._split[right][0]
            open_left, open_right = inner_left != left, inner_right != right
            if not open_left and not open_right:
                return True
            # the later merge is undone first; at equal ranks the left one happened earlier
            if open_left and (not open_right or left > right):
                before, left = min(before, left), inner_left
            else:
                before, right = min(before, right + 1), inner_right

    def _next_shorter(self, token: int) -> int:
        """The longest token that is a proper prefix of ``token``; -1 if there is none."""
        known = self._shorter.get(token)
        if known is None:
            text, known = self.bytes_of[token], -1
            for end in range(len(text) - 1, 0, -1):
                rank = self.ranks.get(text[:end])
                if rank is not None and rank in self._split:
                    known = rank
                    break
            self._shorter[token] = known
        return known

    def _longest(self, node: str) -> int:
        """The longest token that starts ``node``, a path from the automaton's root; memoised per path."""
        token = self._first.get(node)
        if token is None:
            for end in range(len(node), 0, -1):
                token = self._automaton.get(node[:end], None)
                if token is not None:
                    break
            self._first[node] = token
        return token

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        text, size = piece.decode("latin-1"), len(piece)
        reach, known, sizes, beside = self._automaton.longest_prefix, self._first.get, self._sizes, self._beside
        widest = self._widest
        dead: set[int] = set()
        ids: list[int] = []
        at, last = 0, -1
        while at < size:
            window = text[at : at + widest]
            node = window[: reach(window)]
            token = known(node)
            if token is None:
                token = self._longest(node)
            while True:
                end = at + sizes[token]
                if last < 0:
                    fits = True
                else:
                    fits = beside.get((last, token))
                    if fits is None:
                        fits = self._adjacent(last, token)
                if fits and end not in dead:
                    ids.append(token)
                    at, last = end, token
                    break
                token = self._next_shorter(token)
                while token < 0:  # nothing fits here: no valid prefix ends at this byte
                    dead.add(at)
                    token = ids.pop()
                    at -= sizes[token]
                    last = ids[-1] if ids else -1
                    token = self._next_shorter(token)
        return ids

    def _encode_chunk(self, chunk: str) -> bytes:
        ids = array("I")
        for piece in self._pieces(chunk):
            ids.extend(self.encode_piece(piece.encode()))
        return ids.tobytes()

    def encode(self, text: str | None) -> np.ndarray:
        """The ids of a text. A space between two non-blank characters always begins a piece of the
        pattern, so the chunks between such spaces are encoded apart and memoised."""
        if not text:
            return np.empty(0, dtype="<u4")
        if _BLANK_BESIDE_SPACE(text):
            return np.frombuffer(self._encode_chunk(text), dtype="<u4")
        words = text.split(" ")
        parts = list(map(self._memo.get, words))
        parts[0] = self._encode_chunk(words[0])  # the only one without a space in front
        if None in parts:
            parts = [self._new_word(w) if p is None else p for p, w in zip(parts, words, strict=True)]
        return np.frombuffer(b"".join(parts), dtype="<u4")

    def _new_word(self, word: str) -> bytes:
        packed = self._older.get(word)
        if packed is None:
            packed = self._encode_chunk(" " + word)
        if len(word) <= 64:
            if len(self._memo) >= MEMO_ENTRIES // 2:  # words in use move on to the new half
                self._older, self._memo = self._memo, {}
            self._memo[word] = packed
        return packed

    def encode_batch(self, texts: pa.Array) -> pa.ListArray:
        rows = [self.encode(text) for text in texts.to_pylist()]
        offsets = np.zeros(len(rows) + 1, dtype=np.int64)
        np.cumsum([len(row) for row in rows], out=offsets[1:])
        flat = np.concatenate(rows) if rows else np.empty(0, dtype="<u4")
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat.astype(np.int32)))


@cache
def codec(path: str, pattern: str) -> Codec:
    """The codec of this process; a worker builds it once for all its tasks."""
    return Codec(path, pattern)


@cache
def decoder(path: str) -> Decoder:
    return Decoder(path)


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the token ids of ``text`` in a new column ``ids`` (array of int).

    The rank file must be readable under ``path`` on every executor. Nulls and empty texts have no ids.
    Repeated rows stay; a column already named ``ids`` is replaced.
    """
    kept = [c for c in docs.columns if c != ids]
    source = docs.select(*kept, F.col(text).alias("_text"))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(path, pattern)
        for part in parts:
            for at in range(0, part.num_rows, ROWS):
                some = part.slice(at, ROWS)
                columns = [some.column(i) for i in range(len(kept))]
                yield pa.RecordBatch.from_arrays(
                    [*columns, tool.encode_batch(some.column(len(kept)))], names=[*kept, ids]
                )

    fields = docs.select(*kept).withColumn(ids, F.array().cast("array<int>")).schema
    return source.mapInArrow(tidy(batches, codec), fields)


def round_trip(
    docs: DataFrame, path: str, pattern: str, text: str = "text",
    ids: str = "ids", count: str = "n_tokens", same: str = "round_trip",
) -> DataFrame:
    """``docs`` with the ids of ``text``, their number, and whether they decode to the text, in one pass.

    Rules as of ``encode``; columns already named like the new ones are replaced. The codec ends with the task.
    """
    kept = [c for c in docs.columns if c not in (ids, count, same)]
    source = docs.select(*kept, F.col(text).alias("_text"))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(path, pattern)
        for part in parts:
            for at in range(0, part.num_rows, ROWS):
                some = part.slice(at, ROWS)
                texts = some.column(len(kept))
                found = tool.encode_batch(texts)
                data = tool.decode_batch(found).to_pylist()
                whole = [d == (t or "").encode() for d, t in zip(data, texts.to_pylist(), strict=True)]
                sizes = pa.array(found.value_lengths().to_pylist(), pa.int64())
                columns = [*(some.column(i) for i in range(len(kept))), found, sizes, pa.array(whole, pa.bool_())]
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, ids, count, same])

    fields = (
        docs.select(*kept).withColumn(ids, F.array().cast("array<int>"))
        .withColumn(count, F.lit(0).cast("long")).withColumn(same, F.lit(True)).schema
    )
    return source.mapInArrow(tidy(batches, codec), fields)


def decode(encoded: DataFrame, path: str, ids: str = "ids", data: str = "data") -> DataFrame:
    """``encoded`` with the bytes of ``ids`` in a new column ``data``; a null list decodes to no bytes."""
    kept = [c for c in encoded.columns if c != data]
    source = encoded.select(*kept, F.coalesce(ids, F.array().cast("array<int>")).alias("_ids"))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = decoder(path)
        for part in parts:
            for at in range(0, part.num_rows, ROWS):
                some = part.slice(at, ROWS)
                columns = [some.column(i) for i in range(len(kept))]
                yield pa.RecordBatch.from_arrays(
                    [*columns, tool.decode_batch(some.column(len(kept)))], names=[*kept, data]
                )

    fields = encoded.select(*kept).withColumn(data, F.lit(b"")).schema
    return source.mapInArrow(tidy(batches, decoder), fields)


def digests(docs: DataFrame, path: str, pattern: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encodes and decodes in one pass: ``id, n_tokens, ids_sha256, decoded_sha256``.

    ``ids_sha256`` is over the ids as little-endian 32-bit integers, both digests are lower-case hex.
    """

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(path, pattern)
        for part in parts:
            for at in range(0, part.num_rows, ROWS):
                some = part.slice(at, ROWS)
                counts, ids_sha, data_sha = [], [], []
                for value in some.column(1).to_pylist():
                    ids = tool.encode(value)
                    counts.append(len(ids))
                    ids_sha.append(hashlib.sha256(ids.tobytes()).hexdigest())
                    data_sha.append(hashlib.sha256(tool.decode(ids)).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(data_sha, pa.string())],
                    names=[id, "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    kind = docs.schema[id].dataType.simpleString()
    return docs.select(id, text).mapInArrow(
        batches, f"`{id}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )

"""Benchmark passages in documents, found within an edit distance.

Items and documents are sequences of words. A passage within ``rate`` of an item's length in word edits
keeps a run of the item's words intact (the edits cut it into at most edits + 1 runs), so windows of
the item's size are laid only where such a run occurs; this loses nothing. Each window goes through
the CGK random walk: a pointer moves along the words and a random function of step and word decides
whether it advances, which turns few edits into a small Hamming distance. Locality-sensitive hashing
samples a few places of the walk, for many samples and several walks, and a window whose samples agree
with an item's is compared with it exactly, by the smallest edit distance of the item to any passage of
the stretch around the window.
"""

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.jaccard import _mix, word_hashes
from rivulet.llm.workers import tidy

#: Edits per item word up to which a passage counts. Shorter items than MIN_WORDS say too little to be searched for.
RATE, MIN_WORDS = 0.2, 5
#: Walks, samples per walk, and places per sample: at the rate above, recall is above 0.99 (see the tests).
WALKS, SAMPLES, PLACES = 3, 32, 3
#: Items and words of one block; larger benchmarks are searched block after block.
BLOCK_ITEMS, BLOCK_WORDS = 5_000, 1_000_000
_RUNS = np.uint64(0x9E3779B97F4A7C15)


def edit_passage(item: list, words: list) -> tuple[int, int, int]:
    """``edits, start, end`` of the passage of ``words`` nearest to ``item`` (the first of equals, the longest of those).

    Bit-parallel over the item: one bit per item word in a Python integer.
    """
    edits, end = _scan(item, words)
    back, length = _scan(item[::-1], words[:end][::-1], anchored=True, goal=edits)
    return edits, end - length, end


def _scan(item: list, words: list, anchored: bool = False, goal: int = -1) -> tuple[int, int]:
    """The smallest edit distance to a passage of ``words`` and where it ends; ``anchored`` ones begin at 0."""
    places: dict = {}
    for at, word in enumerate(item):
        places[word] = places.get(word, 0) | (1 << at)
    full, top = (1 << len(item)) - 1, 1 << (len(item) - 1)
    plus, minus, cost = full, 0, len(item)
    best, end = cost, 0
    for at, word in enumerate(words, 1):
        same = places.get(word, 0)
        diagonal = (((same & plus) + plus) ^ plus) | same | minus
        up = minus | ~(diagonal | plus) & full
        down = plus & diagonal
        cost += (1 if up & top else 0) - (1 if down & top else 0)
        up = (up << 1 | (1 if anchored else 0)) & full
        down = (down << 1) & full
        plus, minus = down | ~(diagonal | up) & full, up & diagonal
        if cost < best or (anchored and cost == best == goal):
            best, end = cost, at
    return best, end


@dataclass
class Sized:
    """Items of one word count: their walk samples, sorted, with the items they belong to."""

    places: np.ndarray  # walks x samples x places
    keys: np.ndarray
    owners: np.ndarray


class Index:
    """A block of items prepared for the scan of documents."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        self.rate = rate
        self.ids = [item for item, _ in items]
        self.words = [word_hashes(text) for _, text in items]
        self.edits = [math.floor(rate * len(w)) for w in self.words]
        by_size: dict[int, list[int]] = {}
        runs: dict[int, list[tuple[int, int, int]]] = {}
        for at, words in enumerate(self.words):
            size, edits = len(words), self.edits[at]
            by_size.setdefault(size, []).append(at)
            run = math.ceil((size - edits) / (edits + 1))
            runs.setdefault(run, []).extend((key, at, place) for place, key in enumerate(_grams(words, run).tolist()))
        self.runs = {}
        for run, found in runs.items():
            found.sort()
            keys = np.array([key for key, _, _ in found], dtype=np.uint64)
            seen = np.zeros(1 << 20, dtype=bool)
            seen[keys >> np.uint64(44)] = True
            self.runs[run] = (seen, keys, np.array([at for _, at, _ in found]), np.array([place for *_, place in found]))
        self.sized = {size: self._sized(size, members) for size, members in by_size.items()}

    def _sized(self, size: int, members: list[int]) -> Sized:
        random = np.random.default_rng(size)
        places = random.integers(0, 2 * size, (WALKS, SAMPLES, PLACES))
        keys = samples(np.array([self.words[at] for at in members]), places).reshape(-1)
        owners = np.repeat(np.array(members), WALKS * SAMPLES)
        order = np.argsort(keys, kind="stable")
        return Sized(places, keys[order], owners[order])

    def find(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """``item_id, edits, start, end`` (in words) of the nearest passage per item that the text contains."""
        words = word_hashes(text)
        windows = [self._windows(words, run) for run in self.runs]
        pairs = np.concatenate([w for w in windows if w is not None] or [np.empty((0, 2), dtype=np.int64)])
        best: dict[int, tuple[int, int, int]] = {}
        for size in np.unique(pairs[:, 1]).tolist():
            starts = np.unique(pairs[pairs[:, 1] == size, 0])
            for start, at in self._candidates(words, starts, size):
                allowed = self.edits[at]
                if at in best and best[at][0] == 0:
                    continue
                low = max(0, start - 2 * allowed)
                stretch = words[low : start + size + 2 * allowed].tolist()
                edits, first, end = edit_passage(self.words[at].tolist(), stretch)
                if edits <= allowed:
                    found = (edits, low + first, low + end)
                    best[at] = min(best.get(at, found), found)
        return [(self.ids[at], *found) for at, found in sorted(best.items())]

    def _windows(self, words: np.ndarray, run: int) -> np.ndarray | None:
        """Starts and sizes of the windows that some intact run asks for."""
        seen, keys, items, places = self.runs[run]
        grams = _grams(words, run)
        at = np.flatnonzero(seen[grams >> np.uint64(44)])
        if not len(at):
            return None
        low, high = np.searchsorted(keys, grams[at], "left"), np.searchsorted(keys, grams[at], "right")
        count = high - low
        if not count.any():
            return None
        hits = np.repeat(low - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum())
        sizes = np.array([len(w) for w in self.words])[items[hits]]
        starts = np.clip(np.repeat(at, count) - places[hits], 0, None)
        return np.unique(np.stack((starts, sizes), axis=1), axis=0)

    def _candidates(self, words: np.ndarray, starts: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
        """Windows and items that agree in a sample; windows are walked some thousands at a time."""
        group = self.sized[size]
        for part in np.array_split(starts, len(starts) // 2048 + 1):
            padded = np.concatenate((words, np.arange(size, dtype=np.uint64)))  # beyond the end: words of no item
            keys = samples(padded[part[:, None] + np.arange(size)], group.places)
            low, high = np.searchsorted(group.keys, keys, "left"), np.searchsorted(group.keys, keys, "right")
            found = {
                (int(part[window]), owner)
                for window, sample in np.argwhere(high > low).tolist()
                for owner in group.owners[low[window, sample] : high[window, sample]].tolist()
            }
            yield from sorted(found)


def _grams(words: np.ndarray, run: int) -> np.ndarray:
    """A hash of every run of so many words."""
    if len(words) < run:
        return np.empty(0, dtype=np.uint64)
    total = np.full(len(words) - run + 1, run, dtype=np.uint64)
    for k in range(run):
        total = total * _RUNS + words[k : len(words) - run + 1 + k]
    return _mix(total)


def samples(windows: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Per window (rows of equal length), a hash of the walk's words at each sample's places, for each walk."""
    count, size = windows.shape
    padded = np.concatenate((windows, np.zeros((count, 1), dtype=np.uint64)), axis=1)
    rows, found = np.arange(count), []
    for walk, chosen in enumerate(places):
        at, passed = np.zeros(count, dtype=np.int64), np.empty((2 * size, count), dtype=np.uint64)
        for step in range(2 * size):
            word = padded[rows, at]
            passed[step] = word
            coin = _mix(word ^ np.uint64((walk * 2 * size + step + 1) << 20)) & np.uint64(1)
            at = np.minimum(at + coin.astype(np.int64), size)
        for sample, where in enumerate(chosen):
            key = np.full(count, walk * len(chosen) + sample + 1, dtype=np.uint64)
            for place in where:
                key = _mix(key * _RUNS + passed[place])
            found.append(key)
    return np.stack(found, axis=1)


LEAKS = "array<struct<item_id: long, edits: long, start: long, end: long>>"
_LEAK = pa.struct([("item_id", pa.int64()), ("edits", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])


def mark_leaks(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
               rate: float = RATE, min_words: int = MIN_WORDS, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """``docs`` with ``leaks``: per item found its id, the word edits and the passage (first word, word after).

    Words are runs of non-blanks with A-Z as a-z. Items that are null or shorter than ``min_words`` are
    not searched for, items of equal text are each reported, and so is an item with a null id. Null
    and empty texts have no leaks. A column named ``leaks`` is replaced. The benchmark is read in blocks of
    a bounded size, one scan of ``docs`` each.
    """
    queries = items.select(F.col(item_id).cast("long").alias("_id"), F.col(item_text).alias("_text")).where(
        F.size(F.split(F.trim("_text"), r"[\x20\x09-\x0D]+")) >= min_words
    )
    count, words = queries.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("_text")), F.lit(0)) / 6).first()
    blocks = max(1, math.ceil(count / block_items), math.ceil(words / BLOCK_WORDS))
    kept = [c for c in docs.columns if c != "leaks"]
    found = docs.select(*kept).withColumn("leaks", F.array().cast(LEAKS))
    for block in range(blocks):
        chosen = queries.where(F.pmod(F.xxhash64("_id", "_text"), F.lit(blocks)) == block)
        index = Index([(row[0], row[1]) for row in chosen.collect() if len(word_hashes(row[1])) >= min_words], rate)
        found = _scanned(found, docs.sparkSession.sparkContext.broadcast(index), text)
    return found


def _scanned(docs: DataFrame, shared, text: str) -> DataFrame:
    names = docs.columns
    source = docs.select(*names, F.col(text).alias("_text"))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for part in parts:
            texts, before = part.column(len(names)).to_pylist(), part.column(len(names) - 1).to_pylist()
            leaks = [
                known + [dict(zip(("item_id", "edits", "start", "end"), leak, strict=True)) for leak in index.find(value)]
                for known, value in zip(before, texts, strict=True)
            ]
            columns = [part.column(i) for i in range(len(names) - 1)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(leaks, pa.list_(_LEAK))], names=names)

    return source.mapInArrow(tidy(batches), docs.schema)

"""Exact Jaccard join of documents over word shingles, in the metric space of the shingle sets.

1. A document becomes the set of its hashed shingles. Equal sets are one point from here on.
2. Routing. Nearly all pairs of documents are at distance 1, where no pivot can tell them apart and
   every triangle-inequality window covers everything. So points first meet only where they can be
   close: the shingle space is cut into more groups than two linked sets can differ in (their symmetric
   difference is bounded by their sizes), hence some group is equal in both. Points that share a group
   form regions, the connected components of that relation. Groups that hold little but common shingles
   say little, and each set may leave a few out; which shingles are common only steers that choice.
3. Pivots. Inside a region the most central point is the pivot. Points within the radius join it; points
   up to twice the radius away are the boundary and are compared with the ball members in their
   triangle-inequality window; the rest recurses without the ball. A region too large for one task is
   first split by sixteen pivots into Voronoi cells, boundary points being sent to every cell they may
   have links in; what does not shrink so is joined in pairs of blocks. Nothing is skipped.

Shingles and sets are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.components import components
from rivulet.llm.workers import tidy
from rivulet.runtime import fresh_path, shuffle_width

#: Shingles in all sets of a region that one task may hold (8 bytes each, a few copies).
REGION_SHINGLES = 2_000_000
#: Voronoi pivots of a split, and how often cells that are still too large are split again.
PIVOTS, SPLITS = 16, 3
#: Sets a task remembers so that it describes copies once; forgetting costs time only.
SEEN_SETS = 200_000
#: Common shingles: at most so many, in at least so many documents. Any choice of them gives the same result.
COMMON_SHINGLES, COMMON_DOCUMENTS = 500_000, 10
#: Sets with a signature up to which all their pairs are listed.
SHORT_RUN = 12
_COUNTED = 1_000_000  # shingles a task counts at a time
_BAND = 1.25
_ROWS = 500  # texts described at a time
#: Bands in which linked sets differ in fewer shingles are described by all shingles.
FEW_SHINGLES = 4
_NONE = np.empty(0, dtype=np.int64)
_ODD = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def _mix(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


@cache
def _byte_codes() -> np.ndarray:
    """A number per byte, the same for A-Z and a-z; 0 for white space."""
    codes = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_ODD))
    codes[65:91] = codes[97:123]
    codes[[9, 10, 11, 12, 13, 32]] = 0
    return codes


_powers_made: list[np.ndarray] = []


def _powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2^64."""
    if not _powers_made or len(_powers_made[0]) < count:
        size = 1 << max(16, (count - 1).bit_length())
        _powers_made[:] = []
        for base in (_ODD, pow(_ODD, -1, 1 << 64)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers_made.append(np.multiply.accumulate(steps))
    return _powers_made[0], _powers_made[1]


def word_hashes(text: str | None) -> np.ndarray:
    """A 64-bit hash per word ``[^\\x20\\x09-\\x0D]+``, with A-Z as a-z, computed over the whole byte string."""
    data = np.frombuffer((text or "").encode(), dtype=np.uint8)
    if not len(data):
        return np.empty(0, dtype=np.uint64)
    codes = _byte_codes()[data]
    inside = np.concatenate(([False], codes != 0, [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    up, down = _powers(len(data) + 1)
    sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(codes * up[: len(data)], dtype=np.uint64)))
    return _mix((sums[ends] - sums[starts]) * down[starts])


def shingles(text: str | None, width: int) -> np.ndarray:
    """The sorted distinct shingles of ``width`` words; fewer words are one shingle, none an empty set."""
    words = word_hashes(text)
    if not len(words):
        return words
    up, _ = _powers(width + 1)
    span = min(width, len(words))
    total = np.full(len(words) - span + 1, span * _ODD & _MASK, dtype=np.uint64)
    for k in range(span):
        total += words[k : len(words) - span + 1 + k] * up[k + 1]
    return np.unique(_mix(total))


def set_hash(members: np.ndarray) -> int:
    """A signed 64-bit hash of a set."""
    total = np.sum(_mix(members + np.uint64(_ODD)), dtype=np.uint64, keepdims=True)
    return int(_mix(total + np.uint64(len(members))).view(np.int64)[0])


@cache
def _bands(upto: int) -> tuple[int, ...]:
    """First sizes of the size bands."""
    firsts = [1]
    while firsts[-1] <= upto:
        firsts.append(max(firsts[-1] + 1, int(firsts[-1] * _BAND)))
    return tuple(firsts)


def _shared(most: int) -> int:
    """How many described groups linked sets have in common at least, if they differ in ``most`` shingles at most."""
    return 1 + min(3, (most + 1) // 4)


def _least_shared(sizes: np.ndarray, percent: int) -> np.ndarray:
    """The same by the size of the larger set."""
    firsts = np.array(_bands(int(sizes.max()) + 2)) if len(sizes) else np.array([1, 2])
    least = np.array([_shared((100 - percent) * 2 * (following - 1) // (100 + percent)) for following in firsts[1:]])
    return least[np.searchsorted(firsts, sizes, side="right") - 1]


@cache
def _groups(band: int, last_size: int, percent: int) -> tuple[int, np.ndarray, int, np.ndarray]:
    """In how many shingles linked sets of a band differ at most, lower bounds of its groups, how many groups
    a set may leave out, and a tag per group."""
    most = (100 - percent) * 2 * last_size // (100 + percent)
    spare = (most + 1) * 2 // 5
    # spare + _shared(most) groups are equal at least; the sets leave out the small ones up to some size each,
    # so of the equal groups only those left out at the larger of the two sizes are missing
    count = most + _shared(most) + spare
    bounds = np.array([(g << 64) // count for g in range(count)], dtype=np.uint64)
    tags = _mix(np.arange(1, count + 1, dtype=np.uint64) + np.uint64((band + 1) << 40))
    return most, bounds, spare, tags


def signatures(members: np.ndarray, percent: int, common: np.ndarray) -> np.ndarray:
    """Hashes of groups of shingles: two sets that link have one or, by their size, a few of them in common.

    A pair is looked for in the band of its larger set, so a set answers for its own band and for the
    next ones that a link can reach. A band is described by the uncommon shingles alone (two sets differ
    in these no more than in all), unless they are few; then by all. Where one of two linked sets is
    described by all, the other has few enough to be so as well, if need be in both ways. The groups with
    the fewest shingles say least and are left out. ``common`` is sorted.
    """
    size = len(members)
    firsts = _bands(2 * size + 2)
    rare = members
    if len(common):
        at = np.minimum(np.searchsorted(common, members), len(common) - 1)
        rare = members[common[at] != members]
    found = []
    own = int(np.searchsorted(firsts, size, side="right")) - 1
    for band in range(own, len(firsts) - 1):
        if 100 * size < percent * firsts[band]:
            break
        most, bounds, spare, tags = _groups(band, firsts[band + 1] - 1, percent)
        if most:  # else only equal sets link
            enough = most + most // 2 if most >= FEW_SHINGLES else 1 << 62
            if len(rare) >= enough:
                found.append(_described(rare, bounds, spare, tags))
            if len(rare) < enough + most:
                found.append(_described(members, bounds, spare, ~tags))
    return np.concatenate(found).view(np.int64) if found else _NONE


def _described(members: np.ndarray, bounds: np.ndarray, spare: int, tags: np.ndarray) -> np.ndarray:
    sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(_mix(members ^ np.uint64(_ODD)), dtype=np.uint64)))
    starts = np.searchsorted(members, bounds)
    ends = np.append(starts[1:], len(members))
    values, sizes = _mix((sums[ends] - sums[starts]) ^ tags), ends - starts
    # the largest size up to which there are few enough groups; equal groups are equally large in both sets
    left_out = int(np.searchsorted(np.cumsum(np.bincount(sizes)), spare, side="right")) - 1
    return values[sizes > left_out]


def region_roots(sets: list[np.ndarray], percent: int) -> list[int]:
    """For each set of a region the number of the set that stands for its component."""
    count = len(sets)
    parent = list(range(count))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    sizes = np.array([len(s) for s in sets])
    _, flat, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    members = np.split(flat.astype(np.int32), np.cumsum(sizes)[:-1])
    mark = np.zeros(len(times), dtype=bool)
    central = np.array([times[m].mean() for m in members])
    radius = 1 - percent / 100

    def against(one: int, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the others link, and all similarities."""
        mark[members[one]] = True
        joined = np.concatenate([members[x] for x in others]) if len(others) < len(left) else left_flat
        begins = np.concatenate(([0], np.cumsum(sizes[others])[:-1]))
        common = np.add.reduceat(mark[joined], begins, dtype=np.int64)
        mark[members[one]] = False
        union = sizes[one] + sizes[others] - common
        return 100 * common >= percent * union, common / union

    left = np.arange(count)
    left_flat = np.concatenate(members)
    while len(left) > 1:
        pivot = int(left[np.argmax(central[left])])
        links, likeness = against(pivot, left)
        ball, ball_likeness = left[links], likeness[links]
        for x in ball.tolist():
            parent[root(x)] = root(pivot)
        boundary = ~links & (likeness >= 1 - 2 * radius - 1e-9)
        for x, near in zip(left[boundary].tolist(), likeness[boundary].tolist(), strict=True):
            if root(x) != root(pivot):
                window = ball[ball_likeness <= near + radius + 1e-9]
                if len(window) and against(x, window)[0].any():
                    parent[root(x)] = root(pivot)
        left = left[~links]
        left_flat = np.concatenate([members[x] for x in left]) if len(left) else left_flat[:0]
    return [root(x) for x in range(count)]


def _common(docs: DataFrame, width: int) -> np.ndarray:
    """Shingles of many documents, sorted. Every document is counted, in each task and then over all."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def counted() -> pa.RecordBatch:
            values, times = np.unique(np.concatenate(held), return_counts=True)
            often = times > 2
            return pa.RecordBatch.from_arrays(
                [pa.array(values[often].view(np.int64)), pa.array(times[often])], names=["shingle", "n"]
            )

        for part in _slices(parts):
            for text in part.column(0).to_pylist():
                held.append(shingles(text, width))
                size += len(held[-1])
                if size >= _COUNTED:
                    yield counted()
                    held, size = [], 0
        if held:
            yield counted()

    counts = docs.select("_text").mapInArrow(tidy(batches), "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    most = counts.where(F.col("n") >= COMMON_DOCUMENTS).orderBy(F.desc("n"), "shingle").limit(COMMON_SHINGLES)
    return np.sort(most.select("shingle").toPandas()["shingle"].to_numpy(dtype=np.int64).view(np.uint64))


def _slices(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of few rows, so that a task holds the sets of few texts."""
    for part in parts:
        for at in range(0, part.num_rows, _ROWS):
            yield part.slice(at, _ROWS)


def _sets(docs: DataFrame, width: int) -> DataFrame:
    """``_doc, _set, _n``: per row the hash and size of its set."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(parts):
            sets = [shingles(text, width) for text in part.column(1).to_pylist()]
            hashes = pa.array([set_hash(s) if len(s) else 0 for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), hashes, pa.array([len(s) for s in sets], pa.int64())], names=["_doc", "_set", "_n"]
            )

    kind = docs.schema["_doc"].dataType.simpleString()
    return docs.select("_doc", "_text").mapInArrow(tidy(batches), f"_doc {kind}, _set long, _n long")


def _signed(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """``_sign, _n, _set``: the signatures of every set, once per task and set."""
    shared = docs.sparkSession.sparkContext.broadcast(_common(docs, width))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        common = shared.value
        for part in _slices(parts):
            rows: list[tuple[np.ndarray, int, int]] = [(_NONE, 0, 0)]
            for text in part.column(0).to_pylist():
                members = shingles(text, width)
                key = set_hash(members) if len(members) else 0
                if len(members) and key not in seen:
                    if len(seen) >= SEEN_SETS:
                        seen.clear()
                    seen.add(key)
                    rows.append((signatures(members, percent, common), len(members), key))
            times = [len(signs) for signs, *_ in rows]
            columns = [np.concatenate([signs for signs, *_ in rows])]
            columns += [np.repeat(np.array([row[k] for row in rows], dtype=np.int64), times) for k in (1, 2)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["_sign", "_n", "_set"])

    return docs.select("_text").mapInArrow(tidy(batches), "_sign long, _n long, _set long")


def _stars(signed: DataFrame, percent: int) -> DataFrame:
    """Edges ``a, b`` between sets that share signatures; runs of the sorted rows stream by.

    Within a signature the sets are sorted by size; where the next one is too large for a link with the
    one before, a new run begins. A short run gives its pairs, which must turn up often enough over all
    signatures; a long one gives edges from its first set to the others. So a pair that links either
    shares a long run, or all it shares are short ones and their number suffices.
    """
    rows = signed.repartition(shuffle_width(signed.sparkSession), "_sign").sortWithinPartitions("_sign", "_n", "_set")

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, long = np.empty((0, 3), dtype=np.int64), False  # rows of the run that may go on; only its head if long
        for part in parts:
            table = np.concatenate((held, np.stack([part.column(i).to_numpy() for i in range(3)], axis=1)))
            table = table[np.concatenate(([True], (table[1:] != table[:-1]).any(axis=1)))] if len(table) else table
            if not len(table):
                continue
            sign, size = table[:, 0], table[:, 1]
            opens = np.concatenate(([True], (sign[1:] != sign[:-1]) | (100 * size[:-1] < percent * size[1:])))
            starts = np.flatnonzero(opens)
            lengths = np.diff(np.append(starts, len(table)))
            lengths[0] += SHORT_RUN * long
            goes_on = starts[-1]
            long = lengths[-1] > SHORT_RUN
            if long:
                held = table[[goes_on]]
                held[0, 1] = size[-1]
                yield _edges(table, starts, lengths, percent)
            else:
                held = table[goes_on:]
                yield _edges(table[:goes_on], starts[:-1], lengths[:-1], percent)
        if not long and len(held):
            yield _edges(held, np.zeros(1, dtype=np.int64), np.array([len(held)]), percent)

    found = rows.mapInArrow(tidy(batches), "a long, b long, times long, least long")
    counted = found.groupBy("a", "b").agg(F.sum("times").alias("times"), F.min("least").alias("least"))
    return counted.where(F.col("times") >= F.col("least")).select("a", "b")


def _edges(table: np.ndarray, starts: np.ndarray, lengths: np.ndarray, percent: int) -> pa.RecordBatch:
    """``a, b, times, least`` of complete runs: all pairs of short ones, edges from the head of long ones."""
    run = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(table))))
    member, size, short = table[:, 2], table[:, 1], lengths[run] <= SHORT_RUN
    heads = member[starts][run] if len(starts) else member
    found = [np.stack((heads, member, np.zeros_like(member)), axis=1)[~short & (heads != member)]]
    for step in range(1, SHORT_RUN):
        first = np.flatnonzero(short[:-step] & (run[step:] == run[:-step]) & (member[step:] != member[:-step]))
        one, two = member[first], member[first + step]
        pairs = np.stack((np.minimum(one, two), np.maximum(one, two), _least_shared(size[first + step], percent)), axis=1)
        found.append(pairs)
    edges, times = np.unique(np.concatenate(found), axis=0, return_counts=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(edges[:, 0]), pa.array(edges[:, 1]), pa.array(times), pa.array(edges[:, 2])], names=["a", "b", "times", "least"]
    )


def _points(members: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """``members`` (``_region, _set, _doc``) with the shingles of one document per set, packed as bytes."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(parts):
            sets = [shingles(text, width) for text in part.column(2).to_pylist()]
            # a repeated id may bring a text of another set
            right = [len(s) > 0 and set_hash(s) == key for s, key in zip(sets, part.column(1).to_pylist(), strict=True)]
            chosen = part.select(["_region", "_set"]).filter(pa.array(right, pa.bool_()))
            packed = pa.array([s.tobytes() for s, ok in zip(sets, right, strict=True) if ok], pa.binary())
            yield pa.RecordBatch.from_arrays([*chosen.columns, packed], names=["_region", "_set", "_packed"])

    joined = members.join(docs, "_doc").select("_region", "_set", "_text")
    return joined.mapInArrow(tidy(batches), "_region long, _set long, _packed binary")


def _join_regions(points: DataFrame, percent: int) -> DataFrame:
    """Edges ``a, b`` of the components inside each region; a task holds one region at a time."""
    rows = points.repartition(shuffle_width(points.sparkSession), "_region").sortWithinPartitions("_region", "_set")

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        region, keys, sets = None, [], []

        def close() -> pa.RecordBatch:
            roots = region_roots(sets, percent) if len(sets) > 1 else [0]
            pairs = {(keys[r], keys[x]) for x, r in enumerate(roots) if keys[r] != keys[x]}
            columns = list(zip(*sorted(pairs), strict=True)) or [(), ()]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["a", "b"])

        for part in parts:
            for key, member, packed in zip(*(part.column(i).to_pylist() for i in range(3)), strict=True):
                if key != region and keys:
                    yield close()
                    keys, sets = [], []
                region = key
                if not keys or keys[-1] != member:  # visitors may arrive more than once
                    keys.append(member)
                    sets.append(np.frombuffer(packed, dtype=np.uint64))
        if keys:
            yield close()

    return rows.mapInArrow(tidy(batches), "a long, b long")


def _sized(points: DataFrame, most: int) -> DataFrame:
    """``points`` with ``_shingles``, the total of their region, only of regions above ``most``."""
    total = points.groupBy("_region").agg(F.sum(F.octet_length("_packed") / 8).cast("long").alias("_shingles"))
    return points.join(total.where(F.col("_shingles") > most), "_region")


def _voronoi(points: DataFrame, percent: int, payload: bool = True) -> DataFrame:
    """Large regions (``_old``) as cells: each point in the cell of its nearest pivot and, where the triangle
    inequality allows a link, in the cells of others. The rows of a region are spread over salts.
    Without ``payload`` the points come without their shingles, to see what a split would give."""
    salts = shuffle_width(points.sparkSession)
    slot = F.pmod(F.xxhash64("_set"), F.lit(PIVOTS))
    chosen = points.groupBy("_region", slot.alias("_slot")).agg(F.min_by("_packed", F.xxhash64("_set", F.lit(1))).alias("_pivot"))
    pivots = chosen.groupBy("_region").agg(F.sort_array(F.collect_list("_pivot")).alias("_pivots")).withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    )
    spread = points.withColumn("_salt", F.pmod(F.xxhash64("_set", F.lit(2)), F.lit(salts)).cast("int"))
    reach = 2 * (1 - percent / 100) + 1e-9

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apart: dict[int, list[np.ndarray]] = {}
        for part in parts:
            out: list[tuple] = []
            for region, key, packed, pivots in zip(*(part.column(i).to_pylist() for i in range(4)), strict=True):
                own = np.frombuffer(packed, dtype=np.uint64)
                if region not in apart:
                    apart.clear()
                    apart[region] = _apart(pivots, reach)
                far = [_distance(own, pivot) for pivot in apart[region]]
                near = min(far)
                cells = np.flatnonzero(np.array(far) <= near + reach) if near < 1 else _NONE
                if near >= 1 - reach / 2:  # a point at distance 1 from all pivots has links among such points only
                    cells = np.append(cells, PIVOTS)
                cells = cells.astype(np.uint64)
                named = _mix(np.int64(region).view(np.uint64) + (cells + np.uint64(1)) * np.uint64(_ODD)).view(np.int64)
                out += [(region, cell, key, len(own), packed if payload else b"") for cell in named.tolist()]
            columns = list(zip(*out, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["_old", "_region", "_set", "_size", "_packed"],
            )

    joined = spread.join(pivots, ["_region", "_salt"]).select("_region", "_set", "_packed", "_pivots")
    return joined.mapInArrow(tidy(batches), "_old long, _region long, _set long, _size long, _packed binary")


def _distance(one: np.ndarray, other: np.ndarray) -> float:
    common = len(np.intersect1d(one, other, assume_unique=True))
    return 1 - common / (len(one) + len(other) - common)


def _apart(pivots: list[bytes], reach: float) -> list[np.ndarray]:
    """Those pivots, in order, that are not within ``reach`` of an earlier one: their cells would be nearly the same."""
    chosen: list[np.ndarray] = []
    for pivot in pivots:
        members = np.frombuffer(pivot, dtype=np.uint64)
        if all(_distance(members, other) > reach for other in chosen):
            chosen.append(members)
    return chosen


def _worth_splitting(large: DataFrame, percent: int) -> DataFrame:
    """``_region`` of the regions whose cells would make less than half of the region's pairs."""
    cells = _voronoi(large, percent, payload=False).groupBy("_old", "_region").agg(F.sum("_size").cast("double").alias("_cell"))
    work = cells.groupBy(F.col("_old").alias("_region")).agg(F.sum(F.col("_cell") * F.col("_cell")).alias("_work"))
    whole = large.groupBy("_region").agg(F.first("_shingles").cast("double").alias("_whole"))
    return work.join(whole, "_region").where(F.col("_work") < 0.5 * F.col("_whole") * F.col("_whole")).select("_region")


def _block_pairs(points: DataFrame, most: int) -> DataFrame:
    """Regions that pivots did not shrink, as all pairs of blocks that together fit into a task."""
    blocks = F.ceil(F.col("_shingles") / F.lit(max(1, most // 2))).cast("int")
    numbered = points.withColumn("_blocks", blocks).withColumn("_block", F.pmod(F.xxhash64("_set", F.lit(3)), F.col("_blocks")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), (F.col("_blocks") - 1).cast("long")))
    return numbered.withColumn("_other", other).select(
        F.xxhash64("_region", F.least("_block", "_other"), F.greatest("_block", "_other")).alias("_region"), "_set", "_packed"
    )


def _links(points: DataFrame, percent: int, most: int) -> tuple[DataFrame, bool]:
    """Edges between sets, and whether some region was split (edges of one component may then be apart)."""
    spark = points.sparkSession

    def written(df: DataFrame, label: str) -> DataFrame:
        path = fresh_path(spark, label)
        df.write.parquet(path)
        return spark.read.parquet(path)

    edges = None
    for depth in range(SPLITS + 1):
        points = written(points, "points")
        large = _sized(points, most)
        if large.isEmpty():
            found = _join_regions(points, percent)
            return found if edges is None else edges.union(found), edges is not None
        small = points.join(large.select("_region").distinct(), "_region", "left_anti")
        found = _join_regions(small, percent)
        edges = found if edges is None else edges.union(found)
        chosen = written(_worth_splitting(large, percent), "regions") if depth < SPLITS else None
        whole = large if chosen is None else large.join(chosen, "_region", "left_anti")
        edges = edges.union(_join_regions(_block_pairs(whole, most), percent))
        if chosen is None or chosen.isEmpty():
            return edges, True
        points = _voronoi(large.join(chosen, "_region", "left_semi"), percent).select("_region", "_set", "_packed")
    return edges, True


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80,
                    region_shingles: int = REGION_SHINGLES) -> DataFrame:
    """``id, n_shingles, component_id`` per row of ``docs``.

    Two rows link when 100 * |A and B| >= percent * |A or B| for their shingle sets; ``component_id`` is
    the smallest id that links lead to. Rows without words (null or blank texts) have ``n_shingles`` 0
    and stand alone; rows without an id stand alone too, with a null component. Repeated rows link.
    """
    if not 50 < percent <= 100:
        raise ValueError("percent must be above 50 and at most 100")
    spark = docs.sparkSession
    source = docs.select(F.col(id).alias("_doc"), F.col(text).alias("_text"))
    path = fresh_path(spark, "shingle-sets")
    _sets(source, width).write.parquet(path)
    table = spark.read.parquet(path)
    stars = _stars(_signed(source, width, percent), percent)
    stars_path = fresh_path(spark, "shingle-stars")
    stars.write.parquet(stars_path)
    stars = spark.read.parquet(stars_path)
    if not stars.isEmpty():
        regions = components(stars).select(F.col("node").alias("_set"), F.col("root").alias("_region"))
        members = (
            table.where(F.col("_doc").isNotNull()).groupBy("_set").agg(F.min("_doc").alias("_doc")).join(regions, "_set")
        )
        edges, split = _links(_points(members, source, width), percent, region_shingles)
        labels = (components(edges) if split else edges.select(F.col("b").alias("node"), F.col("a").alias("root"))).select(
            F.col("node").alias("_set"), F.col("root").alias("_root")
        )
        table = table.join(labels, "_set", "left").withColumn("_root", F.coalesce("_root", "_set"))
    else:
        table = table.withColumn("_root", F.col("_set"))
    whole = table.where(F.col("_n") > 0).groupBy("_root").agg(F.min("_doc").alias("_least"))
    joined = table.withColumn("_root", F.when(F.col("_n") > 0, F.col("_root"))).join(whole, "_root", "left")
    return joined.select(
        F.col("_doc").alias(id),
        F.col("_n").alias("n_shingles"),
        F.when(F.col("_n") > 0, F.when(F.col("_doc").isNotNull(), F.col("_least"))).otherwise(F.col("_doc")).alias("component_id"),
    )

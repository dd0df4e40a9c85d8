"""Vertices that share a word, found tile by tile instead of pairwise comparison.

Vertices are packed into chunks that are written once: a posting of places per word. A tile is a pair of chunks, which
a task reads from these files, so neither lists nor postings are shuffled for the tiles and what lies on disk grows with
the vertices. Vertices with the same frequent words lie together: few words then link most of a vertex's tiles
wholly, and only what stays open takes the union of the postings of all its words. What leaves a tile is the
number and the sum asked for, or the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.runtime import broadcast_if_small, delete_folder, fresh_path, shuffle_width, write_once

BITS = 32768  # ids per bitmap of the built-in bitmap functions
CHUNK = 32768  # vertices of a chunk at most; places are 16 bits
CHUNK_NOS = 1 << 24  # numbers of a chunk, about
FREQUENT = 1 << 16  # keys that are looked up without a shuffle


def word_sets(vertices: DataFrame, id: str = "id", words: str = "words") -> DataFrame:
    """``(id, n_words, word)``: distinct words of each vertex; the length counts repeated words."""
    counted = vertices.select(F.col(id).alias("id"), F.size(words).cast("bigint").alias("n_words"), F.array_distinct(words).alias("_once"))
    # the outer form: for the other Spark would cut the text a second time, to test whether there is a word
    return counted.select("id", "n_words", F.explode_outer("_once").alias("word")).where(F.col("word").isNotNull())


def _numbered(members: DataFrame, key: str, values: DataFrame | None) -> tuple[str, int]:
    """The folder of ``(id, nos, value)``, and how many rows it has: per vertex the numbers of its keys that another row holds as well.

    Numbers are small for frequent keys: the place in the key's partition, times the number of partitions, plus its own.
    """
    spark = members.sparkSession
    shared = members.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    row = F.monotonically_increasing_id()
    number = F.col("_row").bitwiseAND(F.lit((1 << 33) - 1)) * shuffle_width(spark) + F.shiftright("_row", 33)
    placed = shared.sortWithinPartitions(F.desc("_n")).select(key, "_n", row.alias("_row")).select(key, "_n", number.cast("int").alias("_no"))
    names, lists = fresh_path(spark, "numbers"), fresh_path(spark, "numbered")
    write_once(placed, names)  # a recomputation could number them otherwise
    numbers, named = spark.read.parquet(names).select(key, "_no"), members.where(F.col("id").isNotNull()).select("id", key)
    # the most frequent keys, which hold most of the rows, are looked up where the rows are; the others meet by key
    frequent = spark.read.parquet(names).orderBy(F.desc("_n"), key).limit(FREQUENT).select(key, "_no")
    at_hand = named.join(broadcast_if_small(frequent), key).select("id", "_no").mapInArrow(_runs, "id BIGINT, _nos ARRAY<INT>")
    met = named.join(broadcast_if_small(frequent.select(key)), key, "left_anti").join(numbers, key)
    held = at_hand.unionByName(met.select("id", F.array("_no").alias("_nos"))).withColumn("_value", F.lit(0).cast("bigint"))
    if values is not None:
        none = F.array().cast("array<int>").alias("_nos")
        held = held.unionByName(values.select("id", none, F.col("value").cast("bigint").alias("_value")))
    nos = F.sort_array(F.array_distinct(F.flatten(F.collect_list("_nos")))).alias("nos")
    packed = held.groupBy("id").agg(nos, F.max("_value").alias("value"))
    write_once(packed.where(F.size("nos") > 0), lists)
    delete_folder(spark, names)
    return lists, spark.read.parquet(lists).count()


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbouring rows ``(id, no)`` of a vertex as one row; a vertex may still come several times."""
    for batch in batches:
        ids, numbers = batch.column(0).to_numpy(), batch.column(1)
        starts = np.flatnonzero(np.append(True, ids[1:] != ids[:-1])[: len(ids)])
        lists = pa.ListArray.from_arrays(pa.array(np.append(starts, len(ids)), pa.int32()), numbers)
        yield pa.RecordBatch.from_arrays([pa.array(ids[starts]), lists], ["id", "_nos"])


_PARTS = ("ids", "values", "words", "counts", "places")
_TYPES = (np.int64, np.int64, np.int32, np.int32, np.uint16)


def _chunks(members: DataFrame, key: str, values: DataFrame | None) -> DataFrame:
    """A row per chunk: the ids and values of its vertices, its words in order, how many vertices hold each, and their places by word."""
    spark = members.sparkSession
    lists, size = _numbered(members, key, values)
    ranges = max(-(-size * 4 // (CHUNK * 3)), 1)
    while ranges * ranges < shuffle_width(spark):  # a tile for each task
        ranges += 1
    alike = spark.read.parquet(lists).repartitionByRange(ranges, F.slice("nos", 1, 16), "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, vertices, numbers = [], 0, 0
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                part = batch.slice(at, _ROWS)
                lists = part.column(1)
                piece = part.column(0).to_numpy(), part.column(2).to_numpy(), np.diff(lists.offsets.to_numpy()), lists.flatten().to_numpy()
                if pieces and (vertices + len(piece[0]) > CHUNK or numbers + len(piece[3]) > CHUNK_NOS):
                    yield _packed(*map(np.concatenate, zip(*pieces)))
                    pieces, vertices, numbers = [], 0, 0
                pieces.append(piece)
                vertices, numbers = vertices + len(piece[0]), numbers + len(piece[3])
        if pieces:
            yield _packed(*map(np.concatenate, zip(*pieces)))

    path = fresh_path(spark, "chunks")
    packed = alike.mapInArrow(run, ", ".join(f"{name} BINARY" for name in _PARTS))
    write_once(packed.withColumn("chunk", F.monotonically_increasing_id()), path)
    delete_folder(spark, lists)
    return spark.read.parquet(path)


def _packed(ids: np.ndarray, values: np.ndarray, sizes: np.ndarray, nos: np.ndarray) -> pa.RecordBatch:
    order = np.argsort(nos, kind="stable")
    words, counts = np.unique(nos, return_counts=True)
    columns = ids, values, words, counts, np.repeat(np.arange(len(ids)), sizes)[order]
    return pa.RecordBatch.from_arrays([pa.array([c.astype(t).tobytes()], pa.binary()) for c, t in zip(columns, _TYPES)], list(_PARTS))


def _bitmap(places: np.ndarray, width: int) -> np.ndarray:
    flags = np.zeros(width, dtype=np.uint8)
    flags[places] = 1
    return np.packbits(flags, bitorder="little").view(np.uint64)


class _Chunk:
    """The postings of a chunk: ``places[starts[k]:ends[k]]`` are the vertices that hold ``words[k]``."""

    def __init__(self, *columns: np.ndarray):
        self.ids, self.values, self.words, self.counts, self.places = columns
        self.ends = np.cumsum(self.counts, dtype=np.int64)
        self.starts = self.ends - self.counts
        self.width = -(-len(self.ids) // 64) * 64
        self.full = self.bitmap(np.arange(len(self.ids)))

    def bitmap(self, places: np.ndarray) -> np.ndarray:
        return _bitmap(places, self.width)

    def plane(self, bit: int) -> np.ndarray:
        return self.bitmap(np.flatnonzero(self.values >> bit & 1))

    def posting(self, word: int) -> np.ndarray:
        return self.places[self.starts[word] : self.ends[word]]


def _linked(asked: _Chunk, held: _Chunk, light: int | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of ``asked`` and the bitmaps over ``held`` of the vertices that share a word; one bitmap where all are linked.

    The words that link most come first, eight at a time: a table holds the union of any of the eight, and a vertex takes
    one entry. Vertices linked with the whole chunk are done; for the others each word adds its bitmap, or its list
    if it is in few vertices (``light``).
    """
    at = np.searchsorted(held.words, asked.words)
    mine = np.flatnonzero(held.words[np.minimum(at, len(held.words) - 1)] == asked.words)
    theirs = at[mine]
    open, bits = np.arange(len(asked.ids)), np.zeros((len(asked.ids), held.width // 64), dtype=np.uint64)
    links = asked.counts[mine].astype(np.int64) * held.counts[theirs]
    first = np.argsort(-links, kind="stable")[:_FIRST] if light is None else []
    for low in range(0, len(first), 8):
        code, table = np.zeros(len(asked.ids), dtype=np.uint8), np.zeros((256, bits.shape[1]), dtype=np.uint64)
        for k, word in enumerate(first[low : low + 8]):
            code[asked.posting(mine[word])] |= 1 << k
            table[1 << k : 2 << k] = table[: 1 << k] | held.bitmap(held.posting(theirs[word]))
        code = code[open]
        for row in range(0, len(open), _ROWS):
            bits[row : row + _ROWS] |= table[code[row : row + _ROWS]]
        done = np.concatenate([(bits[row : row + _ROWS] == held.full).all(axis=1) for row in range(0, len(open), _ROWS)])
        if done.any():
            yield open[done], held.full[None]
            open, bits = open[~done], bits[~done]
            if not len(open):
                return
    rest = np.ones(len(mine), dtype=bool)
    rest[first] = False
    theirs, often = theirs[rest], held.counts[theirs[rest]] > (held.width // 128 if light is None else light)
    rows = np.full(len(theirs), -1)
    rows[often] = np.arange(often.sum())
    maps = np.array([held.bitmap(held.posting(word)) for word in theirs[often].tolist()], dtype=np.uint64).reshape(-1, bits.shape[1])
    number, is_open = np.full(len(asked.words), -1, dtype=np.int32), np.zeros(len(asked.ids), dtype=bool)
    number[mine[rest]], is_open[open] = np.arange(len(theirs), dtype=np.int32), True
    words = np.repeat(number, asked.counts)
    kept = np.flatnonzero((words >= 0) & is_open[asked.places])
    order = kept[np.argsort(asked.places[kept], kind="stable")]  # by vertex
    words, ends = words[order], np.cumsum(np.bincount(asked.places[kept], minlength=len(asked.ids)))[open]
    at = rows[words]
    cuts = np.append(0, ends)
    lows, highs = held.starts[theirs], held.ends[theirs]
    for row in range(len(open)):
        here = slice(cuts[row], cuts[row + 1])
        found = bits[row]
        common = at[here]
        if (common >= 0).any():
            found |= np.bitwise_or.reduce(maps[common[common >= 0]], axis=0)
        few = words[here][common < 0]
        if len(few):
            flags = np.unpackbits(found.view(np.uint8), bitorder="little")
            flags[np.concatenate([held.places[a:b] for a, b in zip(lows[few].tolist(), highs[few].tolist())])] = 1
            bits[row] = np.packbits(flags, bitorder="little").view(np.uint64)
    for row in range(0, len(open), _ROWS):
        yield open[row : row + _ROWS], bits[row : row + _ROWS]


def _turned(bits: np.ndarray) -> np.ndarray:
    """The bit matrix with rows and columns exchanged; both are multiples of 64."""
    words = bits.reshape(-1, 64, bits.shape[1]).copy()
    for step, mask in ((32, 0xFFFFFFFF), (16, 0xFFFF0000FFFF), (8, 0xFF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        halves = words.reshape(len(words), -1, 2, step, words.shape[2])
        low, high, by = halves[:, :, 0], halves[:, :, 1], np.uint64(step)
        other = ((low >> by) ^ high) & np.uint64(mask)
        high ^= other
        low ^= other << by
    return words.transpose(2, 1, 0).reshape(-1, len(words))


class _Sums:
    """Adds up, over the tiles of a task, how many vertices each one is linked with and the sum of their values."""

    schema = "id BIGINT, total BIGINT, n BIGINT"

    def __init__(self):
        self.sums = {}

    def add(self, names: tuple[int, int], tile: tuple[_Chunk, _Chunk], light: int | None) -> Iterator[pa.RecordBatch]:
        (asked, mine), (held, theirs) = [
            (chunk, self.sums.setdefault(name, (chunk.ids.copy(), np.zeros((2, len(chunk.ids)), dtype=np.int64)))[1])
            for name, chunk in zip(names, tile)
        ]
        once = names[0] == names[1]  # a chunk with itself
        planes = [[c.plane(k) for k in range(int(c.values.max()).bit_length())] for c in tile]
        for places, bits in _linked(asked, held, light):
            self._count(mine, places, bits, planes[1])
            if once:
                continue
            if len(bits) == 1:
                linked = np.flatnonzero(np.unpackbits(bits.view(np.uint8), bitorder="little"))
                theirs[:, linked] += np.array([[asked.values[places].sum()], [len(places)]])
                continue
            rows = np.zeros((-(-len(bits) // 64) * 64, bits.shape[1]), dtype=np.uint64)
            rows[: len(bits)] = bits
            own = [_bitmap(np.flatnonzero(asked.values[places] >> k & 1), len(rows)) for k in range(len(planes[0]))]
            self._count(theirs, np.arange(len(held.ids)), _turned(rows)[: len(held.ids)], own)
        return iter(())

    @staticmethod
    def _count(sums: np.ndarray, places: np.ndarray, bits: np.ndarray, planes: list[np.ndarray]) -> None:
        sums[1, places] += np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
        for k, plane in enumerate(planes):
            sums[0, places] += np.bitwise_count(bits & plane).sum(axis=1, dtype=np.int64) << k

    def end(self) -> Iterator[pa.RecordBatch]:
        for ids, sums in self.sums.values():
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (ids, *sums)], ["id", "total", "n"])


class _Pairs:
    """Lists the pairs of a tile, in both orders."""

    schema = "src BIGINT, dst BIGINT"

    def add(self, names: tuple[int, int], tile: tuple[_Chunk, _Chunk], light: int | None) -> Iterator[pa.RecordBatch]:
        asked, held = tile
        for places, bits in _linked(asked, held, light):
            for at in range(0, len(places), _LISTED):
                some = places[at : at + _LISTED]
                flags = np.broadcast_to(bits if len(bits) == 1 else bits[at : at + _LISTED], (len(some), bits.shape[1]))
                row, other = np.nonzero(np.unpackbits(np.ascontiguousarray(flags).view(np.uint8), axis=1, bitorder="little"))
                pair = pa.array(asked.ids[some[row]]), pa.array(held.ids[other])
                for columns in [pair] if names[0] == names[1] else [pair, pair[::-1]]:
                    yield pa.RecordBatch.from_arrays(list(columns), ["src", "dst"])

    def end(self) -> Iterator[pa.RecordBatch]:
        return iter(())


_ROWS = 512  # rows worked off at a time, a multiple of 64
_LISTED = 64  # of which the pairs are listed at a time
_FIRST = 64  # words that come first


def _tiles(members: DataFrame, key: str, kind: type[_Sums | _Pairs], values: DataFrame | None = None, light: int | None = None) -> DataFrame:
    """What ``kind`` makes of each vertex of ``members (id, key)`` and all that share a key with it, itself included.

    ``values (id, value)`` are whole numbers from 0.
    """
    chunks = _chunks(members, key, values)
    held = chunks.select(*[F.col(name).alias(f"held_{name}") for name in chunks.columns])
    # a task reads its chunks from the files; two chunks meet once
    tiles = chunks.hint("shuffle_replicate_nl").join(held, F.col("chunk") <= F.col("held_chunk"))
    parts = tiles.select("chunk", "held_chunk", *_PARTS, *[f"held_{name}" for name in _PARTS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = kind()
        for batch in batches:
            for row in range(batch.num_rows):
                columns = [np.frombuffer(c[row].as_buffer(), t) for c, t in zip(batch.columns[2:], _TYPES * 2)]
                tile = [(batch.column(k)[row].as_py(), _Chunk(*columns[5 * k : 5 * k + 5])) for k in (0, 1)]
                names, tile = zip(*sorted(tile, key=lambda side: len(side[1].places)))  # the side with fewer words asks
                yield from made.add(names, tile, light)
        yield from made.end()

    return parts.mapInArrow(run, kind.schema)


def _linked_pairs(members: DataFrame, key: str = "word", light: int | None = None) -> DataFrame:
    """``(src, dst)``: each ordered pair that shares a ``key`` once, and each vertex that shares one with itself."""
    return _tiles(members, key, _Pairs, light=light)


def neighbor_bitmaps(members: DataFrame, key: str = "word", light: int | None = None) -> DataFrame:
    """Per vertex, the ids that share a ``key`` with it, itself included: ``(id, block, bits)``.

    ``members`` holds (id, key) rows; ids are longs from 0. A key in at most ``light`` vertices of a chunk
    is taken as a list there, a more frequent one as a bitmap; by default each takes the faster form.
    """
    place = F.col("dst") + 1  # the bitmap functions count from 1
    return _linked_pairs(members, key, light).groupBy(F.col("src").alias("id"), F.bitmap_bucket_number(place).alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")
    )


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, _LISTED):
            part = batch.slice(at, _LISTED)
            ids, blocks = part.column(0).to_numpy(), part.column(1).to_numpy()
            packed = np.frombuffer(b"".join(part.column(2).to_pylist()), dtype=np.uint8).reshape(part.num_rows, -1)
            row, bit = np.nonzero(np.unpackbits(packed, axis=1, bitorder="little"))
            src, dst = ids[row], (blocks[row] - 1) * BITS + bit
            keep = src != dst
            yield pa.RecordBatch.from_arrays([pa.array(src[keep]), pa.array(dst[keep])], ["src", "dst"])


def overlap_edges(vertices: DataFrame, id: str = "id", words: str = "words") -> DataFrame:
    """``(src, dst, attr)`` for all ordered pairs with a common word.

    ``attr`` is 1 when the source has more words than the target, else 2. Each pair is produced once.
    """
    members = word_sets(vertices, id, words)
    lengths = vertices.select(F.col(id).alias("id"), F.size(words).cast("bigint").alias("n_words"))
    pairs = _linked_pairs(members).where("src <> dst")
    attr = F.when(F.col("_src_words") > F.col("_dst_words"), 1).otherwise(2).cast("bigint")
    return (
        pairs.join(lengths.select(F.col("id").alias("src"), F.col("n_words").alias("_src_words")), "src")
        .join(lengths.select(F.col("id").alias("dst"), F.col("n_words").alias("_dst_words")), "dst")
        .select("src", "dst", attr.alias("attr"))
    )


def overlap_degrees(members: DataFrame, key: str = "word") -> DataFrame:
    """Number of other vertices sharing a ``key``, without listing the pairs; vertices with none are absent."""
    counted = _tiles(members, key, _Sums).groupBy("id").agg((F.sum("n") - 1).alias("degree"))
    return counted.where(F.col("degree") > 0)


def longer_edge_count(vertices: DataFrame, id: str = "id", words: str = "words") -> DataFrame:
    """Number of overlap edges with ``attr`` 1, from degrees alone.

    Both directions of a pair exist and exactly one is 1 unless the lengths are equal, so the count is
    half of all edges less those between vertices of equal length.
    """
    members = word_sets(vertices, id, words)
    same = members.select("id", F.struct("n_words", "word").alias("word"))
    total = overlap_degrees(members).agg(F.coalesce(F.sum("degree"), F.lit(0)).alias("n"))
    equal = overlap_degrees(same).agg(F.coalesce(F.sum("degree"), F.lit(0)).alias("n"))
    signed = total.unionByName(equal.select((-F.col("n")).alias("n")))
    return signed.agg((F.sum("n") / 2).cast("bigint").alias("n_edges"))


def most_popular_vertex(vertices: DataFrame, id: str = "id", words: str = "words") -> DataFrame:
    """The vertex with most overlap edges, then most words, then smallest id."""
    members = word_sets(vertices, id, words)
    lengths = vertices.select(F.col(id).alias("id"), F.size(words).cast("bigint").alias("n_words"))
    scored = overlap_degrees(members).join(lengths, "id")
    best = F.max_by(F.struct("id", "degree", "n_words"), F.struct("degree", "n_words", -F.col("id")))
    return scored.agg(best.alias("best")).select("best.*")


def neighborhood_avg_words(
    vertices: DataFrame, id: str = "id", words: str = "words", count_timestamp: bool = False
) -> DataFrame:
    """Average number of words of a vertex's neighbours; ``count_timestamp`` adds the line's first token.

    No pair is listed: in each tile the bits of the linked vertices meet the bits of their lengths, and the sums
    of a vertex's tiles add up.
    """
    extra = 1 if count_timestamp else 0
    lengths = vertices.select(F.col(id).alias("id"), (F.size(words) + extra).cast("bigint").alias("_own"))
    sums = _tiles(word_sets(vertices, id, words), "word", _Sums, lengths.withColumnRenamed("_own", "value"))
    totals = sums.groupBy("id").agg(F.sum("total").alias("_total"), F.sum("n").alias("_n"))
    others = totals.join(lengths, "id").where(F.col("_n") > 1)  # a vertex is in its own tiles
    return others.select("id", ((F.col("_total") - F.col("_own")) / (F.col("_n") - 1)).alias("avg_words"))

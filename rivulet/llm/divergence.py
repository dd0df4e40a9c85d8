"""Which sources of a language use other words than its other sources: an audit over the group-term matrix.

A group is a source of a language. Per language the matrix has a row per group and a column per kept
term, and most of it is zero. It is cut into tiles of columns; each tile is a K-squared quadtree (K = 2):
a quadrant without a count is not stored, and only nonzero leaves are. All pairs of groups walk the
trees of a tile together from the root: where both quadrants are empty nothing is opened, since every
column there adds the same difference of the two smoothed floors, priced by the number of columns; where
one is not, the walk descends, and at the leaves the difference of the two shares is added.

Shares are whole: ``p = 1 + floor(1000000000 * (count + 5) / (N + 5 * V))``. All sums are sums of longs,
so neither the cut into tiles nor the order of tasks changes them.

Missing text, language and source are empty strings; every row counts as a document, also repeated ones.
An empty table gives an empty table. A language without kept terms still has its pairs, with value 0.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.runtime import broadcast_if_small, cut_lineage

MIN_DOCS = 30
TOP_TERMS = 50
UNIT, SMOOTHING = 1_000_000_000, 5
#: Columns and rows of a tile; a task holds the cells of two bands of rows over these columns.
TILE_COLUMNS, BAND_ROWS = 2048, 64
#: Open quadrant pairs and partial counts that a task holds at once.
WALK, HELD_TERMS = 2_000_000, 200_000

#: Bytes of UTF-8 that end a term become blanks, A-Z become lower case; all of a letter beyond ASCII stays.
_TERM_BYTES = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)
)


def terms(data: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, in order."""
    return data.translate(_TERM_BYTES).split()


_COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("_term", pa.binary()), ("n", pa.int64()), ("d", pa.int64())])


def _count_batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts and document counts of the terms of each group, handed on whenever many are held."""
    counts: dict[tuple, Counter] = {}
    holders: dict[tuple, Counter] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for group, found in counts.items():
            names = list(found)
            columns = [
                pa.array([group[0]] * len(names), pa.string()), pa.array([group[1]] * len(names), pa.string()),
                pa.array(names, pa.binary()), pa.array(list(found.values()), pa.int64()),
                pa.array([holders[group][t] for t in names], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=_COUNTS)
        counts.clear()
        holders.clear()

    held = 0
    for part in parts:
        groups = zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True)
        for group, data in zip(groups, part.column(2), strict=True):
            found = terms(data.as_py())
            if not found:
                continue
            mine = counts.setdefault(group, Counter())
            held -= len(mine)
            mine.update(found)
            held += len(mine)
            holders.setdefault(group, Counter()).update(set(found))
            if held >= HELD_TERMS:
                yield from flush()
                held = 0
    yield from flush()


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``lang, source, term, n, d``: occurrences of a term in a group, and documents of the group that hold it."""
    rows = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("_data"),
    )
    partial = rows.mapInArrow(_count_batches, "lang string, source string, _term binary, n long, d long")
    summed = partial.groupBy("lang", "source", "_term").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))
    return summed.select("lang", "source", F.col("_term").cast("string").alias("term"), "n", "d")


def _share(count: Column, total: Column, size: Column) -> Column:
    """``1 + floor(UNIT * (count + 5) / (total + 5 * size))``, exact beyond the range of a long product."""
    wide = "decimal(38,0)"
    above = (count.cast("decimal(20,0)") + SMOOTHING) * F.lit(UNIT).cast("decimal(10,0)")
    below = total.cast("decimal(20,0)") + size.cast("decimal(20,0)") * SMOOTHING
    return F.call_function("div", above.cast(wide), below.cast(wide)) + 1


# --- a tile and the walk over it ------------------------------------------------------------------

def _levels(cells: np.ndarray, depth: int) -> list[np.ndarray]:
    """Per level from the root, the sorted codes ``row * 2^level + column`` of the quadrants with a count."""
    rows, columns = cells
    return [
        np.unique(((rows >> (depth - k)) << k) | (columns >> (depth - k))).astype(np.int64) for k in range(depth + 1)
    ]


def _holds(codes: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(codes, wanted), len(codes) - 1)
    return codes[at] == wanted if len(codes) else np.zeros(len(wanted), bool)


def walk_tile(
    left: tuple[np.ndarray, np.ndarray, np.ndarray], left_floor: np.ndarray,
    right: tuple[np.ndarray, np.ndarray, np.ndarray], right_floor: np.ndarray, width: int,
) -> tuple[np.ndarray, np.ndarray]:
    """For all pairs of a row of ``left`` and one of ``right``: the sum of the differences of their shares over
    the columns where not both are zero, and the number of the other columns.

    A side is ``(rows, columns, shares)`` of its nonzero cells; ``floors`` are the shares of a zero.
    """
    size = max(len(left_floor), len(right_floor), width, 1)
    depth = int(size - 1).bit_length()
    trees = [_levels(np.array(side[:2], dtype=np.int64).reshape(2, -1), depth) for side in (left, right)]
    orders = [np.argsort((side[0] << depth) | side[1]) for side in (left, right)]
    shares = [side[2][order] for side, order in zip((left, right), orders, strict=True)]
    summed = np.zeros((len(left_floor), len(right_floor)), dtype=np.int64)
    empty = np.zeros_like(summed)
    open_pairs = [(0, np.zeros((3, 1), dtype=np.int64))]  # a level, and quadrants (left row, right row, column)
    while open_pairs:
        level, quads = open_pairs.pop()
        low, high, column = quads
        mine = _holds(trees[0][level], (low << level) | column)
        other = _holds(trees[1][level], (high << level) | column)
        void = ~mine & ~other
        _price(empty, quads[:, void], depth - level, width)
        quads, mine, other = quads[:, ~void], mine[~void], other[~void]
        if not quads.size:
            continue
        if level == depth:
            low, high, column = quads
            p = _leaf(trees[0][level], shares[0], (low << level) | column, mine, left_floor[low])
            q = _leaf(trees[1][level], shares[1], (high << level) | column, other, right_floor[high])
            np.add.at(summed, (low, high), np.abs(p - q))
            continue
        step = 1 << (depth - level - 1)
        for piece in np.array_split(quads, 1 + 8 * quads.shape[1] // WALK, axis=1):
            halves = np.array([(a, b, c) for a in (0, 1) for b in (0, 1) for c in (0, 1)], dtype=np.int64).T
            below = (2 * piece[:, :, None] + halves[:, None, :]).reshape(3, -1)
            inside = (below[0] * step < len(left_floor)) & (below[1] * step < len(right_floor)) & (below[2] * step < width)
            open_pairs.append((level + 1, below[:, inside]))
    return summed, empty


def _leaf(codes: np.ndarray, shares: np.ndarray, wanted: np.ndarray, held: np.ndarray, floor: np.ndarray) -> np.ndarray:
    if not len(codes):
        return floor
    return np.where(held, shares[np.minimum(np.searchsorted(codes, wanted), len(codes) - 1)], floor)


def _price(empty: np.ndarray, quads: np.ndarray, up: int, width: int) -> None:
    """Count the columns of empty quadrants for every pair of their rows."""
    if not quads.size:
        return
    step = 1 << up
    columns = np.minimum((quads[2] + 1) * step, width) - quads[2] * step
    coarse = np.zeros(((empty.shape[0] + step - 1) >> up, (empty.shape[1] + step - 1) >> up), dtype=np.int64)
    np.add.at(coarse, (quads[0], quads[1]), columns)
    empty += np.repeat(np.repeat(coarse, step, 0)[: empty.shape[0]], step, 1)[:, : empty.shape[1]]


_TILE_RESULT = "lang string, a string, b string, summed long, touched long"


def _tile(frame: pd.DataFrame) -> pd.DataFrame:
    """One tile of a language for two bands of its rows: a row per pair of groups ``a < b``.

    Rows with a null term are the groups with their share of a zero; the others are cells.
    """
    heads = frame[frame["term"].isna()].sort_values("row")
    cells = frame[frame["term"].notna()]
    # columns held by many groups first: zeros gather in large quadrants
    held = cells.groupby("term").size()
    order = {t: i for i, t in enumerate(sorted(held.index, key=lambda t: (-held[t], t)))}
    column = cells["term"].map(order).to_numpy(dtype=np.int64)
    bands = np.sort(heads["band"].unique())
    sides = []
    for band in (bands[0], bands[-1]):
        head, mine = heads[heads["band"] == band], (cells["band"] == band).to_numpy()
        rows = cells["row"].to_numpy(dtype=np.int64)[mine] - int(head["row"].iloc[0])
        held_cells = (rows, column[mine], cells["p"].to_numpy(dtype=np.int64)[mine])
        sides.append((held_cells, head["p"].to_numpy(dtype=np.int64), head["source"].to_numpy()))
    (left, left_floor, left_names), (right, right_floor, right_names) = sides
    summed, empty = walk_tile(left, left_floor, right, right_floor, len(order))
    # two different bands are joined whole; inside one band a pair is taken once
    at = np.nonzero(np.ones_like(summed)) if bands[0] != bands[-1] else np.triu_indices(len(left_names), 1)
    return pd.DataFrame(
        {
            "lang": frame["lang"].iloc[0], "a": left_names[at[0]], "b": right_names[at[1]],
            "summed": summed[at], "touched": len(order) - empty[at],
        }
    )


# --- the audit --------------------------------------------------------------------------------------

def audit(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
    min_docs: int = MIN_DOCS, top: int = TOP_TERMS,
) -> DataFrame:
    """``lang, source, part, item, value, rank``: the distance to every other source, and the terms above their share.

    Part ``pair`` ranks the other sources of the language by the sum of the differences of the shares,
    part ``term`` the ``top`` terms whose share in the group lies above that in the language.
    """
    spark = docs.sparkSession
    groups = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"),
    ).distinct()
    counted = cut_lineage(term_counts(docs, text, lang, source))
    kept = counted.groupBy("lang", "term").agg(F.sum("d").alias("_d"), F.sum("n").alias("in_lang"))
    kept = kept.where(F.col("_d") >= min_docs).drop("_d")
    cells = cut_lineage(counted.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "in_lang"))
    sizes = cells.groupBy("lang", "term").agg(F.first("in_lang").alias("n")).groupBy("lang")
    sizes = sizes.agg(F.count(F.lit(1)).alias("width"), F.sum("n").alias("in_all"))
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("in_group"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1  # a row per source
    zero = F.lit(0).cast("long")
    rows = (
        groups.join(totals, ["lang", "source"], "left").join(sizes, "lang", "left")
        .select("lang", "source", place.alias("row"), *(F.coalesce(c, zero).alias(c) for c in ("in_group", "width", "in_all")))
        .withColumn("floor", F.when(F.col("width") > 0, _share(zero, F.col("in_group"), F.col("width"))).otherwise(zero))
    )
    rows = cut_lineage(rows)
    shared = cells.join(broadcast_if_small(rows), ["lang", "source"]).withColumn(
        "p", _share(F.col("n"), F.col("in_group"), F.col("width"))
    ).withColumn("q", _share(F.col("in_lang"), F.col("in_all"), F.col("width")))
    return _pairs(rows, shared).unionByName(_terms(shared, top))


def _terms(shared: DataFrame, top: int) -> DataFrame:
    above = shared.where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    return _ranked(above, "term").where(F.col("rank") <= top)


def _ranked(items: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return items.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))


def _pairs(rows: DataFrame, shared: DataFrame) -> DataFrame:
    tiles = F.expr(f"greatest(1, (width + {TILE_COLUMNS - 1}) div {TILE_COLUMNS})")
    band = F.expr(f"row div {BAND_ROWS}")
    heads = rows.select(
        "lang", "source", "row", F.lit(None).cast("string").alias("term"), F.col("floor").alias("p"), "width",
        F.explode(F.sequence(F.lit(0).cast("long"), tiles - 1)).alias("tile"),
    )
    cells = shared.select(
        "lang", F.lit(None).cast("string").alias("source"), "row", "term", "p", "width", F.pmod(F.xxhash64("term"), tiles).alias("tile"),
    )
    both = heads.unionByName(cells).withColumn("band", band)
    bands = rows.groupBy("lang").agg(F.max(band).alias("_bands"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), "_bands"))
    spread = both.join(broadcast_if_small(bands), "lang").withColumn("_other", other).withColumn(
        "low", F.least("band", "_other")
    ).withColumn("high", F.greatest("band", "_other"))
    walked = spread.select("lang", "source", "row", "term", "p", "tile", "band", "low", "high")
    walked = walked.groupBy("lang", "tile", "low", "high").applyInPandas(_tile, _TILE_RESULT)
    sums = walked.groupBy("lang", "a", "b").agg(F.sum("summed").alias("summed"), F.sum("touched").alias("touched"))
    floors = rows.select("lang", "source", "width", "floor")
    one = floors.select("lang", F.col("source").alias("a"), "width", F.col("floor").alias("_one"))
    two = floors.select("lang", F.col("source").alias("b"), F.col("floor").alias("_two"))
    priced = sums.join(broadcast_if_small(one), ["lang", "a"]).join(broadcast_if_small(two), ["lang", "b"])
    value = F.col("summed") + (F.col("width") - F.col("touched")) * F.abs(F.col("_one") - F.col("_two"))
    priced = cut_lineage(priced.select("lang", "a", "b", value.alias("value")))
    ways = priced.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").unionByName(
        priced.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), "value")
    )
    return _ranked(ways, "pair")


SQL = rf"""WITH docs AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
words AS (
  SELECT id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (
  SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT id) >= {MIN_DOCS}),
langs AS (SELECT lang, count(*) AS v, sum(n)::BIGINT AS total FROM kept GROUP BY lang),
grp AS (SELECT DISTINCT lang, source FROM docs),
cells AS (SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL),
totals AS (SELECT lang, source, sum(n)::BIGINT AS total FROM cells GROUP BY ALL),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + {UNIT} * (coalesce(c.n, 0) + {SMOOTHING}) // (coalesce(t.total, 0) + {SMOOTHING} * l.v) AS p,
    1 + {UNIT} * (k.n + {SMOOTHING}) // (l.total + {SMOOTHING} * l.v) AS q
  FROM grp g JOIN kept k USING (lang) JOIN langs l USING (lang)
    LEFT JOIN cells c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
    LEFT JOIN totals t ON t.lang = g.lang AND t.source = g.source),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p))::BIGINT AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
items AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM items)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= {TOP_TERMS}"""

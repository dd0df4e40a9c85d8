"""Product codes of vectors, with codebooks trained by Lloyd rounds over cover trees.

Components become whole numbers, ``floor(256 * x)``, and a vector is cut into equal parts. Each task
collects blocks of its rows and grows a cover tree for every part of a block, in whose leaf order the
parts are stored with cumulative sums; the blocks are written once and read in every round. In a round
a tree is walked from its root: by the triangle inequality an entry that is farther from a node's centre
than the nearest entry by more than twice the node's radius cannot win anywhere below. When one entry is
left, the whole subtree is assigned, and its sum is the difference of two cumulative sums; only leaves
that stay ambiguous are compared exactly, in whole numbers. Tasks hand on sums and counts per entry, so
the driver gets one row per entry and component, whatever the number of vectors.

Rows whose vector is null, or holds a null or non-finite component, are dropped; so are vectors of
another length than most (of the lengths that can be cut, the most frequent, then the smallest).
Whatever is finite as a 32-bit float is computed exactly; an error beyond a long is given as the largest
long. Rows without an id come last among the first entries. Repeated rows are coded each. With fewer
vectors than entries the codebooks are that much shorter; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.runtime import delete_folder, fresh_path, shuffle_width

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Components that a block holds at most, and points below which a node is not divided.
BLOCK_CELLS, LEAF = 1 << 19, 64
_LARGEST_FLOAT, _LARGEST_LONG = 3.4028234663852886e38, 2**63 - 1
_HALF = 1 << 60  # sums travel as two decimals of this base
_LABELS = 100_000


def whole(x: np.ndarray) -> np.ndarray:
    """``floor(256 * x)`` as longs, or as Python integers where one would not fit."""
    x = x.astype(np.float64)
    if not x.size or np.abs(x).max() < 2.0**50:
        return np.floor(SCALE * x).astype(np.int64)
    return np.array([[math.floor(v * SCALE) for v in row] for row in x.tolist()], dtype=object).reshape(x.shape)


@dataclass
class CoverTree:
    """A cover tree over points, which lie in leaf order: each node owns the range ``low`` to ``high``."""

    order: np.ndarray  # row of the block by place
    points: np.ndarray
    sums: np.ndarray  # sums[i] is the sum of the first i points
    centre: np.ndarray  # place of the centre, per node
    radius: np.ndarray
    low: np.ndarray
    high: np.ndarray
    child: np.ndarray  # first child, per node; the children of a node follow each other
    children: np.ndarray


def _apart(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    gap = points - centre
    return np.sqrt(np.einsum("ij,ij->i", gap, gap))


def grow(points: np.ndarray) -> CoverTree:
    """Each level halves the radius: children's centres are farther apart than it and cover all points of the node."""
    near = points.astype(np.float64)
    slack = 1e-9 * (1.0 + float(np.abs(near).max(initial=0.0)))
    order = np.arange(len(points))
    nodes = [[0, 0.0, 0, len(points), 0, 0]]  # centre's row, radius, low, high, first child, children
    for node in nodes:  # grows while it is worked off
        centre, _, low, high, _, _ = node
        rows = order[low:high].copy()  # the range is rewritten below
        far = _apart(near[rows], near[centre])
        node[1] = float(far.max(initial=0.0)) + slack
        if len(rows) <= LEAF or far.max() == 0.0:
            continue
        limit, at, node[4] = far.max() / 2, low, len(nodes)
        while len(rows):
            inside = far <= limit
            mine = rows[inside]
            order[at : at + len(mine)] = mine
            nodes.append([centre, 0.0, at, at + len(mine), 0, 0])
            at, rows, node[5] = at + len(mine), rows[~inside], node[5] + 1
            if len(rows):
                centre = rows[0]
                far = _apart(near[rows], near[centre])
    place = np.empty_like(order)
    place[order] = np.arange(len(order))
    points = points[order]
    addends = points.astype(object) if _wide(points) else points
    sums = np.concatenate([np.zeros_like(addends, shape=(1, points.shape[1])), np.cumsum(addends, axis=0)])
    columns = [np.array(c) for c in zip(*nodes, strict=True)]
    return CoverTree(order, points, sums, place[columns[0]], *columns[1:])


def _largest(values: np.ndarray) -> int:
    return max((abs(int(values.max())), abs(int(values.min())))) if values.size else 0


def _wide(points: np.ndarray) -> bool:
    """Whether sums of the points could leave the range of a long."""
    return _largest(points) * (len(points) + 1) >= 2**62


def _same_kind(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Longs where squared distances fit, else Python integers."""
    fits = (_largest(points) + _largest(entries)) ** 2 * max(1, points.shape[1]) < 2**62
    kind = np.int64 if fits else object
    return points.astype(kind), entries.astype(kind)


def squared(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances between rows of the two, pairwise."""
    points, entries = _same_kind(points, entries)
    return (points - entries) ** 2 @ np.ones(points.shape[1], dtype=points.dtype)


def nearest(points: np.ndarray, entries: np.ndarray, allowed: np.ndarray) -> np.ndarray:
    """The nearest allowed entry of each point, exactly; ties to the lower index."""
    points, entries = _same_kind(points, entries)
    size = (entries**2).sum(axis=1)
    gap = size[None, :] - 2 * (points @ entries.T)  # the squared distance less the square of the point
    return np.where(allowed, gap, gap.max(axis=1, keepdims=True) + 1).argmin(axis=1)


def assign(tree: CoverTree, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The entry of each place, and the sum and count of the points of each entry."""
    count = len(entries)
    points, ends = tree.points.astype(np.float64), entries.astype(np.float64)
    slack = 1e-9 * (1.0 + np.abs(points).max(initial=0.0) + np.abs(ends).max(initial=0.0))
    chosen = np.full(len(points), -1, dtype=np.int64)
    sums = np.zeros((count, points.shape[1]), dtype=tree.sums.dtype)
    nodes, allowed = np.zeros(1, dtype=np.int64), np.ones((1, count), dtype=bool)
    vague, vague_allowed = [], []
    while len(nodes):
        gap = np.zeros((len(nodes), count))
        for at in range(points.shape[1]):
            gap += np.square(points[tree.centre[nodes], at][:, None] - ends[None, :, at])
        gap = np.where(allowed, np.sqrt(gap), np.inf)
        reach = gap.min(axis=1) + 2 * tree.radius[nodes] + slack
        allowed = gap <= reach[:, None]
        sure = allowed.sum(axis=1) == 1
        winners, won = allowed[sure].argmax(axis=1), nodes[sure]
        np.add.at(sums, winners, tree.sums[tree.high[won]] - tree.sums[tree.low[won]])
        _fill(chosen, tree.low[won], tree.high[won], winners)
        nodes, allowed = nodes[~sure], allowed[~sure]
        tips = tree.children[nodes] == 0
        sizes = (tree.high - tree.low)[nodes[tips]]
        vague.append(_ranges(tree.low[nodes[tips]], sizes))
        vague_allowed.append(np.repeat(allowed[tips], sizes, axis=0))
        nodes, allowed = nodes[~tips], allowed[~tips]
        many = tree.children[nodes]
        nodes, allowed = _ranges(tree.child[nodes], many), np.repeat(allowed, many, axis=0)
    left = np.concatenate(vague)
    if len(left):
        chosen[left] = nearest(tree.points[left], entries, np.concatenate(vague_allowed))
        np.add.at(sums, chosen[left], tree.points[left])
    return chosen, sums, np.bincount(chosen, minlength=count)


def _ranges(low: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each ``low`` on, so many of each, one after the other."""
    starts = np.cumsum(sizes) - sizes
    return np.repeat(low - starts, sizes) + np.arange(int(sizes.sum()))


def _fill(chosen: np.ndarray, low: np.ndarray, high: np.ndarray, values: np.ndarray) -> None:
    chosen[_ranges(low, high - low)] = np.repeat(values, high - low)


# --- Spark -------------------------------------------------------------------------------------------

def usable(rows: DataFrame, id: str, vector: str, label: str, parts: int) -> tuple[DataFrame, int]:
    """``_id, _label, _vector`` of the rows that can be coded, and the length of their vectors (0: there is none)."""
    sound = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) <= _LARGEST_FLOAT))  # NaN is above all numbers
    kept = rows.where(F.col(vector).isNotNull() & sound).select(
        F.col(id).alias("_id"), F.col(label).alias("_label"), F.col(vector).alias("_vector")
    )
    length = F.size("_vector").alias("_length")
    usual = kept.groupBy(length).count().where((F.col("_length") > 0) & (F.col("_length") % parts == 0))
    top = usual.orderBy(F.desc("count"), "_length").limit(1).collect()
    size = top[0]["_length"] if top else 0
    return kept.where(F.size("_vector") == size), size


def _blocks(kept: DataFrame, size: int, parts: int) -> DataFrame:
    """Rows ``ids, labels, trees``: a block of rows of a task, with one tree per part."""
    limit = max(ENTRIES, BLOCK_CELLS // size)
    kinds = {f.name: f.dataType.simpleString() for f in kept.schema.fields}

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for part in stream:
            for at in range(0, len(part), limit):
                piece = part.slice(at, limit)
                if rows + len(piece) > limit:
                    yield _block(held, size, parts)
                    held, rows = [], 0
                held.append(piece)
                rows += len(piece)
        if rows:
            yield _block(held, size, parts)

    return kept.mapInArrow(batches, f"ids array<{kinds['_id']}>, labels array<{kinds['_label']}>, trees array<binary>")


def _block(held: list[pa.RecordBatch], size: int, parts: int) -> pa.RecordBatch:
    table = pa.Table.from_batches(held).combine_chunks()
    vectors = table.column("_vector").combine_chunks()
    numbers = whole(np.asarray(vectors.flatten()).reshape(-1, size))
    trees = [pickle.dumps(grow(piece)) for piece in np.split(numbers, parts, axis=1)]
    one = [0, table.num_rows]
    lists = [
        pa.ListArray.from_arrays(pa.array(one, pa.int32()), table.column(c).combine_chunks()) for c in ("_id", "_label")
    ]
    return pa.RecordBatch.from_arrays([*lists, pa.array([trees], pa.list_(pa.binary()))], names=["ids", "labels", "trees"])


def _first_codebooks(kept: DataFrame, size: int, parts: int, entries: int) -> list[np.ndarray]:
    rows = kept.orderBy(F.asc_nulls_last("_id"), "_vector").limit(entries).collect()
    numbers = whole(np.array([row["_vector"] for row in rows]).reshape(-1, size))
    return np.split(numbers, parts, axis=1)


def _sums(blocks: DataFrame, codebooks: list[np.ndarray]) -> list[tuple]:
    """``part, entry, component, high, low, count`` over all blocks: one row per number of the codebooks."""

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], tuple[np.ndarray, int]] = {}
        for batch in stream:
            for row in batch.column(0):
                for part, (tree, book) in enumerate(zip(row, codebooks, strict=True)):
                    _, sums, counts = assign(pickle.loads(tree.as_py()), book)
                    for entry in np.flatnonzero(counts):
                        before, n = total.get((part, entry), (0, 0))
                        total[part, entry] = sums[entry].astype(object) + before, n + int(counts[entry])
        made = [
            (part, int(entry), at, *map(Decimal, divmod(int(value), _HALF)), n)
            for (part, entry), (values, n) in total.items()
            for at, value in enumerate(values)
        ]
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.decimal128(38, 0), pa.decimal128(38, 0), pa.int64()]
        names = ["part", "entry", "at", "high", "low", "n"]
        columns = list(zip(*made, strict=True)) or [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    each = blocks.select("trees").mapInArrow(
        batches, "part int, entry int, at int, high decimal(38,0), low decimal(38,0), n long"
    )
    summed = each.groupBy("part", "entry", "at").agg(
        F.sum("high").alias("high"), F.sum("low").alias("low"), F.sum("n").alias("n")
    )
    return summed.collect()  # parts x entries x components, set by the parameters


def _moved(codebooks: list[np.ndarray], sums: list[tuple]) -> list[np.ndarray]:
    books = [book.astype(object) for book in codebooks]
    for part, entry, at, high, low, n in sums:
        books[part][entry, at] = (int(high) * _HALF + int(low)) // n
    return [book if _largest(book) >= 2**62 else book.astype(np.int64) for book in books]


def _codes(blocks: DataFrame, codebooks: list[np.ndarray], id_kind: str, label_kind: str) -> DataFrame:
    """``_id, _label, code, error`` of every row."""

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for ids, labels, trees in zip(*batch.columns, strict=True):
                n = len(ids)
                code, error = np.zeros((n, len(codebooks)), dtype=np.uint8), np.zeros(n, dtype=object)
                for part, (data, book) in enumerate(zip(trees, codebooks, strict=True)):
                    tree = pickle.loads(data.as_py())
                    chosen, _, _ = assign(tree, book)
                    code[tree.order, part] = chosen
                    error[tree.order] += squared(tree.points, book[chosen]).astype(object)
                text, wide = code.tobytes().hex(), 2 * len(codebooks)
                made = [text[i : i + wide] for i in range(0, n * wide, wide)]
                yield pa.RecordBatch.from_arrays(
                    [ids.values, labels.values, pa.array(made), pa.array([min(e, _LARGEST_LONG) for e in error], pa.int64())],
                    names=["_id", "_label", "code", "error"],
                )

    return blocks.mapInArrow(batches, f"_id {id_kind}, _label {label_kind}, code string, error long")


def digest(codebooks: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(int(x)) for book in codebooks for x in book.flat).encode()).hexdigest()


def compress(
    rows: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
) -> tuple[DataFrame, list[np.ndarray]]:
    """Codes of all usable rows, ``id, label, code, error``, and the codebooks: per part, a row per entry.

    ``code`` has two hex digits per part, so there are at most 256 entries. The codes lie in a table in the
    shared folder; the blocks are deleted.
    """
    spark = rows.sparkSession
    kept, size = usable(rows, id, vector, label, parts)
    kinds = [kept.schema[c].dataType.simpleString() for c in ("_id", "_label")]
    schema = f"_id {kinds[0]}, _label {kinds[1]}, code string, error long"
    if not size:
        empty = spark.createDataFrame([], schema)
        return empty.toDF(id, label, "code", "error"), [np.zeros((0, 0), dtype=np.int64)] * parts
    folder, coded = fresh_path(spark, "tree-blocks"), fresh_path(spark, "codes")
    _blocks(kept, size, parts).write.parquet(folder)
    try:
        blocks = spark.read.parquet(folder)
        codebooks = _first_codebooks(kept, size, parts, entries)
        for _ in range(rounds):
            codebooks = _moved(codebooks, _sums(blocks, codebooks))
        _codes(blocks, codebooks, *kinds).write.parquet(coded)
    finally:
        delete_folder(spark, folder)
    return spark.read.schema(schema).parquet(coded).toDF(id, label, "code", "error"), codebooks


def label_errors(codes: DataFrame, label: str = "label") -> DataFrame:
    """``codes`` with ``label_error``, the sum of ``error`` over equal labels; rows without a label are together.

    Labels that hold more than an equal share of the rows are few, by their definition, and are broadcast;
    so the join by label never sends such a label to one task.
    """
    sums = codes.groupBy(F.col(label).alias("_label")).agg(
        F.sum(F.col("error").cast("decimal(38,0)")).alias("_sum"), F.count(F.lit(1)).alias("_n")
    ).withColumn("_sum", F.least(F.col("_sum"), F.lit(_LARGEST_LONG).cast("decimal(38,0)")).cast("long"))
    width = max(shuffle_width(codes.sparkSession), 1)
    share = codes.agg(F.count(F.lit(1)).alias("_all")).scalar()
    hot = F.broadcast(sums.where(F.col("_n") * width > share).select("_label", F.col("_sum").alias("_hot")))
    rest = sums.where(F.col("_n") * width <= share).select("_label", F.col("_sum").alias("_rest"))
    same = F.col(label).eqNullSafe(F.col("_label"))
    found = codes.join(hot, same, "left").drop("_label")
    large = found.where(F.col("_hot").isNotNull()).withColumn("_rest", F.lit(None).cast("long"))
    small = found.where(F.col("_hot").isNull()).join(rest, same, "left").drop("_label")
    return large.unionByName(small).select(*codes.columns, F.coalesce("_hot", "_rest").alias("label_error"))


def coded(rows: DataFrame) -> DataFrame:
    """The codes of ``embeddings`` in the form of the registered query."""
    codes, codebooks = compress(rows.select("vec_id", "embedding", "label"))
    return label_errors(codes).select(
        "vec_id", "code", "error", "label_error", F.lit(digest(codebooks)).alias("codebooks_sha256")
    )


def _floor_div(a: str, b: str) -> str:
    return f"(({a}) - ((({a}) % ({b})) + ({b})) % ({b})) // ({b})"


def sql() -> str:
    """The same codes by comparing every part with every entry."""
    steps = []
    for k in range(ROUNDS + 1):
        steps.append(f"""near{k} AS (
  SELECT rid, p, min(struct_pack(gap := gap, j := j)) AS best FROM (
    SELECT v.rid, v.p, c.j, list_sum(list_transform(range(1, len(v.x) + 1),
      lambda i: (v.x[i] - c.e[i]) * (v.x[i] - c.e[i])))::BIGINT AS gap
    FROM parts v JOIN book{k} c ON v.p = c.p) GROUP BY rid, p)""")
        if k < ROUNDS:
            steps.append(f"""mean{k} AS (
  SELECT p, j, list(m ORDER BY i) AS e FROM (
    SELECT p, j, i, {_floor_div('sum(x)::BIGINT', 'count(*)')} AS m FROM (
      SELECT v.p, n.best.j AS j, unnest(v.x) AS x, unnest(range(len(v.x))) AS i
      FROM parts v JOIN near{k} n ON v.rid = n.rid AND v.p = n.p) GROUP BY p, j, i) GROUP BY p, j),
book{k + 1} AS (SELECT b.p, b.j, coalesce(m.e, b.e) AS e FROM book{k} b LEFT JOIN mean{k} m ON b.p = m.p AND b.j = m.j)""")
    return f"""WITH sound AS (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS rid, vec_id, label, embedding FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
usual AS (
  SELECT len(embedding) AS n FROM sound WHERE len(embedding) > 0 AND len(embedding) % {PARTS} = 0
  GROUP BY n ORDER BY count(*) DESC, n LIMIT 1),
kept AS (
  SELECT rid, vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v
  FROM sound WHERE len(embedding) = (SELECT n FROM usual)),
parts AS (
  SELECT rid, p, list_slice(v, p * (len(v) // {PARTS}) + 1, (p + 1) * (len(v) // {PARTS})) AS x
  FROM kept, range({PARTS}) r(p)),
seeds AS (SELECT rid, row_number() OVER (ORDER BY rid) - 1 AS j FROM kept),
book0 AS (SELECT p, j, x AS e FROM parts JOIN seeds USING (rid) WHERE j < {ENTRIES}),
{(","+chr(10)).join(steps)},
hash AS (
  SELECT sha256(string_agg(list_aggregate(e, 'string_agg', ','), ',' ORDER BY p, j)) AS codebooks_sha256 FROM book{ROUNDS}),
coded AS (
  SELECT rid, string_agg(printf('%02x', best.j), '' ORDER BY p) AS code, sum(best.gap)::BIGINT AS error
  FROM near{ROUNDS} GROUP BY rid)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN coded USING (rid), hash"""

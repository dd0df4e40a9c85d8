import hashlib
import math
import random

import numpy as np
import pytest

from rivulet.llm import covertree

SCHEMA = "vec_id long, embedding array<float>, label int, _id string, code string, _label string, error string"


def plain(rows, parts=16, entries=64, rounds=2):
    """Lloyd rounds over Python integers, comparing all with all."""
    rows = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    rows.sort(key=lambda r: (r[0] is None, r[0], r[1]))
    width = len(rows[0][1]) // parts
    whole = [[math.floor(float(np.float32(x)) * 256) for x in r[1]] for r in rows]
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for v in whole]
    books = [[cut[i][p] for i in range(min(entries, len(rows)))] for p in range(parts)]

    def closest(piece, book):
        return min((sum((a - b) ** 2 for a, b in zip(piece, e)), j) for j, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            homes = [closest(v[p], books[p])[1] for v in cut]
            for j in range(len(books[p])):
                mine = [v[p] for v, h in zip(cut, homes) if h == j]
                if mine:
                    books[p][j] = [sum(c) // len(mine) for c in zip(*mine)]
    found = [[closest(v[p], books[p]) for p in range(parts)] for v in cut]
    errors = [sum(g for g, _ in f) for f in found]
    by_label = {}
    for r, e in zip(rows, errors):
        by_label[r[2]] = by_label.get(r[2], 0) + e
    text = ",".join(str(x) for book in books for e in book for x in e)
    digest = hashlib.sha256(text.encode()).hexdigest()
    return sorted(
        (str(r[0]), "".join(f"{j:02x}" for _, j in f), e, by_label[r[2]], digest)
        for r, f, e in zip(rows, found, errors)
    )


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z", "w") for r in rows], SCHEMA)


def coded(spark, rows):
    found = covertree.coded(table(spark, rows)).collect()
    return sorted((str(r.vec_id), r.code, r.error, r.label_error, r.codebooks_sha256) for r in found)


def vectors(seed, n, size=32):
    rng = random.Random(seed)
    return [(i, [rng.gauss(0, 0.2) for _ in range(size)], rng.choice([None, 1, 2])) for i in range(n)]


def test_codes_equal_plain_lloyd_rounds(spark):
    rows = vectors(1, 400)
    rows += [(1000 + i, rows[0][1], 2) for i in range(200)]  # a third are copies
    rows += [(0, rows[5][1], None), (None, rows[6][1], 1), (None, rows[6][1], 1)]
    odd = [(2000, None, 1), (2001, [None] * 32, 1), (2002, [math.nan] * 32, 1), (2003, [math.inf] + [0.0] * 31, 1)]
    odd += [(2004, [], 1), (2005, [1.0] * 16, 1), (2006, [1.0] * 17, None)]
    assert coded(spark, rows + odd) == plain(rows)


def test_few_and_no_vectors(spark):
    rows = vectors(2, 3)
    assert coded(spark, rows) == plain(rows)
    assert coded(spark, []) == []
    assert coded(spark, [(1, None, None)]) == []


def test_huge_components_stay_exact(spark):
    rows = vectors(3, 70, 16)
    rows += [(100, [3e15 + 2**30 * i for i in range(16)], 1), (101, [-3e7] * 16, 2), (102, [3e38] * 16, 2)]
    got, want = coded(spark, rows), plain(rows)
    assert [g[1] for g in got] == [w[1] for w in want] and got[0][4] == want[0][4]
    assert [g[2] for g in got] == [min(w[2], 2**63 - 1) for w in want]


@pytest.mark.parametrize("spread", [1, 3, 1000])
def test_walk_assigns_as_comparing_all_does(spread):
    rng = np.random.default_rng(spread)
    points = rng.integers(-spread, spread + 1, (3000, 3))
    entries = rng.integers(-spread, spread + 1, (40, 3))
    tree = covertree.grow(points)
    chosen, sums, counts = covertree.assign(tree, entries)
    want = ((points[tree.order][:, None] - entries[None]) ** 2).sum(axis=2).argmin(axis=1)
    assert (chosen == want).all() and (counts == np.bincount(want, minlength=40)).all()
    for j in range(40):
        assert (sums[j] == points[tree.order][want == j].sum(axis=0)).all()


def test_tree_covers_and_separates():
    points = np.random.default_rng(0).integers(-500, 500, (2000, 4))
    tree = covertree.grow(points)
    near = tree.points.astype(float)
    for node in range(len(tree.centre)):
        inside = near[tree.low[node] : tree.high[node]]
        assert np.sqrt(((inside - near[tree.centre[node]]) ** 2).sum(axis=1)).max() <= tree.radius[node]
        below = range(tree.child[node], tree.child[node] + tree.children[node])
        assert not tree.children[node] or [tree.low[c] for c in below][1:] == [tree.high[c] for c in below][:-1]
        centres = near[[tree.centre[c] for c in below]]
        for i in range(1, len(centres)):
            assert np.sqrt(((centres[:i] - centres[i]) ** 2).sum(axis=1)).min() > tree.radius[node] / 2 - 1e-3


def test_subtrees_are_assigned_whole_when_entries_lie_apart(monkeypatch):
    rng = np.random.default_rng(5)
    points = np.concatenate([rng.integers(0, 50, (4000, 2)), rng.integers(5000, 5050, (4000, 2))])
    compared = []
    exact = covertree.nearest
    monkeypatch.setattr(covertree, "nearest", lambda p, *a: compared.append(len(p)) or exact(p, *a))
    chosen, _, _ = covertree.assign(covertree.grow(points), np.array([[0, 0], [5000, 5000]]))
    assert sum(compared) == 0 and np.bincount(chosen).tolist() == [4000, 4000]

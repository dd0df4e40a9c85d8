import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from cases import docs, odd_docs

from rivulet.llm import divergence

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def plain(rows, min_docs, top=50):
    """The audit over dense rows of Python integers; ``rows`` are (text, lang, source)."""
    counts, holders = defaultdict(Counter), defaultdict(Counter)
    groups = set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        found = TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        counts[lang, source].update(found)
        holders[lang].update(set(found))
    out = []
    for lang in {g[0] for g in groups}:
        kept = sorted(t for t, d in holders[lang].items() if d >= min_docs)
        members = sorted(s for a, s in groups if a == lang)

        def shares(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 5) // (total + 5 * len(kept)) for t in kept}

        whole = sum((counts[lang, s] for s in members), Counter())
        q = shares(whole)
        p = {s: shares(counts[lang, s]) for s in members}
        for s in members:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in members if o != s]
            above = [(p[s][t] - q[t], t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", above, top)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, i, v, r + 1) for r, (v, i) in enumerate(items[:most])]
    return sorted(out)


def audited(table, **options):
    return sorted(tuple(r) for r in divergence.audit(table, **options).collect())


def rows_of(table):
    return [(r.text, r.lang, r.source) for r in table.collect()]


def corpus(spark, n, sources, seed):
    rng = random.Random(seed)
    words = ["alpha", "Beta", "gamma", "été", "ÉTÉ", "x1y", "don't", "漢字", "delta", "Zeta"]
    data = []
    for i in range(n):
        source = rng.choice(sources)
        mine = words[: 3 + len(source or "") % 7]
        text = " ".join(rng.choice(mine) for _ in range(rng.randint(0, 30)))
        data.append((i, text, rng.choice(["en", None, "de"]), source, None, "x", 1, "a", "b"))
    return spark.createDataFrame(data, docs(spark).schema)


def test_equals_the_dense_computation(spark):
    table = corpus(spark, 300, ["a", "bb", "ccc", None, "", "dddddd"], 1)
    assert audited(table, min_docs=5) == plain(rows_of(table), 5)


def test_several_tiles_and_bands(spark, monkeypatch):
    monkeypatch.setattr(divergence, "TILE_COLUMNS", 3)
    monkeypatch.setattr(divergence, "BAND_ROWS", 2)
    table = corpus(spark, 200, ["a", "bb", "ccc", "e" * 4, "f" * 5], 2)
    assert audited(table, min_docs=4, top=2) == plain(rows_of(table), 4, 2)


def test_partial_counts_add_up(spark, monkeypatch):
    table = corpus(spark, 80, ["a", None], 3).selectExpr("lang", "source", "cast(text as binary) AS t").toArrow()
    batches = table.to_batches(max_chunksize=20)

    def added():
        total = Counter()
        for part in divergence._count_batches(iter(batches)):
            for lang, source, term, n, d in zip(*(c.to_pylist() for c in part.columns)):
                total[lang, source, term, "n"] += n
                total[lang, source, term, "d"] += d
        return total

    whole = added()
    monkeypatch.setattr(divergence, "HELD_TERMS", 7)
    assert added() == whole and whole


def test_odd_rows(spark):
    table = odd_docs(spark)
    for least in (1, 2, 1000):
        assert audited(table, min_docs=least) == plain(rows_of(table), least)
    assert audited(docs(spark)) == []


def test_shares_beyond_a_long_product(spark):
    n = spark.range(1).selectExpr("9000000000000L AS n", "20000000000000L AS total", "1000L AS size")
    got = n.select(divergence._share(*(n[c] for c in ("n", "total", "size")))).first()[0]
    assert got == 1 + 10**9 * (9 * 10**12 + 5) // (2 * 10**13 + 5000)


@pytest.mark.parametrize("rows, columns, fill", [(1, 1, 1.0), (7, 33, 0.1), (16, 64, 0.0), (5, 100, 0.9)])
def test_walk_equals_dense_difference(rows, columns, fill):
    rng = np.random.default_rng(rows)
    sides, dense = [], []
    for n in (rows, rows + 2):
        floor = rng.integers(1, 50, n)
        held = rng.random((n, columns)) < fill
        cells = rng.integers(50, 500, (n, columns))
        dense.append((np.where(held, cells, floor[:, None]), held))
        at = np.nonzero(held)
        sides.append(((at[0], at[1], cells[at]), floor))
    summed, empty = divergence.walk_tile(*sides[0], *sides[1], columns)
    (left, left_held), (right, right_held) = dense
    either = left_held[:, None] | right_held[None]
    assert (summed == (np.abs(left[:, None] - right[None]) * either).sum(axis=2)).all()
    assert (empty == (~either).sum(axis=2)).all()


def test_empty_quadrants_are_not_opened(monkeypatch):
    looked = []
    holds = divergence._holds
    monkeypatch.setattr(divergence, "_holds", lambda codes, wanted: looked.append(len(wanted)) or holds(codes, wanted))
    cell = (np.array([0]), np.array([0]), np.array([9]))
    _, empty = divergence.walk_tile(cell, np.ones(64, int), cell, np.ones(64, int), 1 << 12)
    assert sum(looked) < 2 * 8 * 13 * 64 and empty[5, 5] == 1 << 12 and empty[0, 5] == (1 << 12) - 1

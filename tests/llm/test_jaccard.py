import random

import numpy as np
import pytest
from cases import docs, edited, near_groups, odd_docs, prose

from rivulet.llm import jaccard
from rivulet.llm.components import components


def corpus(seed=5, groups=12):
    rng = random.Random(seed)
    texts = []
    passage = prose(rng, 60)
    for _ in range(groups):
        base = prose(rng, rng.choice([3, 8, 20, 60, 200]))
        texts += [edited(rng, base, rng.randint(0, 1 + len(base) // 120)) for _ in range(rng.randint(1, 6))]
        texts.append(prose(rng, 30) + " " + passage + " " + prose(rng, 30))
    rng.shuffle(texts)
    return texts


def result(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


@pytest.mark.parametrize("width,percent", [(4, 85), (5, 80)])
def test_groups_equal_brute_force(spark, width, percent):
    texts = corpus()
    got = result(jaccard.near_duplicates(docs(spark, *texts), width=width, percent=percent))
    assert got == near_groups(dict(enumerate(texts)), width, percent)


@pytest.mark.parametrize("most", [600, 3000])
def test_split_regions_give_the_same(spark, most):
    rng = random.Random(3)
    base = prose(rng, 120)
    texts = [edited(rng, base, rng.randint(0, 6)) for _ in range(60)] + corpus(8, 3)
    got = result(jaccard.near_duplicates(docs(spark, *texts), width=4, percent=85, region_shingles=most))
    assert got == near_groups(dict(enumerate(texts)), 4, 85)


def test_region_roots_at_the_limit():
    rng = np.random.default_rng(2)
    for _ in range(30):
        base = rng.choice(400, 40, replace=False)
        sets = []
        for _ in range(25):
            own = base.copy()
            own[rng.integers(0, 40, rng.integers(0, 5))] = rng.integers(400, 900, 1)
            sets.append(np.unique(own).astype(np.uint64))
        roots = jaccard.region_roots(sets, 85)
        near = [
            [100 * len(np.intersect1d(a, b)) >= 85 * len(np.union1d(a, b)) for b in sets] for a in sets
        ]
        reach = np.linalg.matrix_power(np.array(near, dtype=np.int64), 5) > 0
        reach = np.linalg.matrix_power(reach.astype(np.int64), 5) > 0
        assert [[x == y for y in roots] for x in roots] == reach.tolist()


def test_linked_sets_share_a_signature():
    rng = np.random.default_rng(4)
    checked = 0
    for size in [1, 2, 5, 6, 7, 12, 13, 40, 100, 101, 333]:
        for _ in range(60):
            a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
            b = a.copy()[rng.random(len(a)) > rng.random() * 0.16]
            b = np.unique(np.concatenate((b, rng.integers(0, 2**63, rng.integers(0, size // 12 + 1)).astype(np.uint64))))
            if len(b) and not np.array_equal(a, b) and 100 * len(np.intersect1d(a, b)) >= 85 * len(np.union1d(a, b)):
                checked += 1
                least = jaccard._least_shared(np.array([max(len(a), len(b))]), 85)[0]
                for share in (0, 0.3, 0.6, 0.9, 1):
                    known = np.sort(rng.choice(a, int(len(a) * share), replace=False))
                    both = jaccard.signatures(a, 85, known), jaccard.signatures(b, 85, known)
                    assert np.intersect1d(*both).size >= least
    assert checked > 200


def test_odd_rows(spark):
    got = jaccard.near_duplicates(odd_docs(spark), width=4, percent=85)
    rows = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_shingles"], r["component_id"]) for r in got.collect())
    assert [(i, n > 0, c) for _, i, n, c in rows] == [
        (0, False, 0), (1, False, 1), (2, False, 2), (3, True, 3), (4, True, 3), (5, True, 5), (5, True, 5),
        (6, True, 6), (7, True, 6), (0, True, None),
    ]
    assert jaccard.near_duplicates(odd_docs(spark).limit(0)).count() == 0
    with pytest.raises(ValueError):
        jaccard.near_duplicates(odd_docs(spark), percent=40)


def test_components_of_a_long_path(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (5, 3), (200, 200)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_a_region_of_far_clusters_is_split_into_cells(spark):
    rng = np.random.default_rng(6)
    sets = []
    for cluster in range(5):
        base = np.arange(cluster * 1000, cluster * 1000 + 60)
        for _ in range(12):
            own = base.copy()
            own[rng.integers(0, 60, rng.integers(0, 7))] = rng.integers(10_000, 90_000, 1)
            sets.append(np.unique(own).astype(np.uint64))
    points = spark.createDataFrame(
        [(1, i, bytearray(s.tobytes())) for i, s in enumerate(sets)], "_region long, _set long, _packed binary"
    )
    large = jaccard._sized(points, 1500)
    assert [r["_region"] for r in jaccard._worth_splitting(large, 85).collect()] == [1]
    edges, split = jaccard._links(points, 85, 1500)
    assert split
    found = {r["node"]: r["root"] for r in components(edges).collect()}
    roots = jaccard.region_roots(sets, 85)
    least = {r: min(i for i, x in enumerate(roots) if x == r) for r in set(roots)}
    assert {i: found.get(i, i) for i in range(len(sets))} == {i: least[r] for i, r in enumerate(roots)}

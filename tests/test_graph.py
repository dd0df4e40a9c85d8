import itertools
import random

import pytest
from pyspark.sql import functions as F

from rivulet.operators import graph, overlap
from rivulet.sources.files import edge_list, vertex_words


def edges_of(spark, pairs):
    return spark.createDataFrame(pairs, "src BIGINT, dst BIGINT")


def plain_pagerank(pairs, iterations, keep):
    out = {}
    for s, _ in pairs:
        out[s] = out.get(s, 0) + 1
    vertices = {v for p in pairs for v in p}
    ranks = {v: (0.0 if keep and v not in out else 1.0) for v in vertices}
    for _ in range(iterations):
        received = {}
        for s, d in pairs:
            if s in ranks:
                received[d] = received.get(d, 0.0) + ranks[s] / out[s]
        fresh = {v: 0.15 + 0.85 * x for v, x in received.items()}
        ranks = {**ranks, **fresh} if keep else fresh
    return {v: ranks.get(v, 1.0) for v in vertices}


def as_dict(ranks):
    return {r.id: r["rank"] for r in ranks.collect()}


CHAIN = [(1, 2), (2, 3), (3, 2)]


def test_vertices_without_in_edges_separate_the_two_pageranks(spark):
    edges = edges_of(spark, CHAIN)
    vanishing, keeping = as_dict(graph.pagerank(edges, 3)), as_dict(graph.pagerank_graph(edges, 3))
    assert vanishing == pytest.approx(plain_pagerank(CHAIN, 3, False))
    assert keeping == pytest.approx(plain_pagerank(CHAIN, 3, True))
    assert vanishing[1] == keeping[1] == 1.0 and vanishing[2] < keeping[2]


@pytest.mark.parametrize("layout,cache,fanout", [("hash", False, 10**6), ("range", True, 10**6), ("hash", False, 20)])
def test_pagerank_with_a_hot_source_and_parallel_edges(spark, layout, cache, fanout):
    rng = random.Random(3)
    pairs = [(0, rng.randrange(1, 90)) for _ in range(150)] + [
        (rng.randrange(60), rng.randrange(90)) for _ in range(300)
    ]
    pairs = [p for p in pairs if p[0] != p[1]]
    edges = edges_of(spark, pairs)
    prepared = graph.RankEdges(edges, layout, fanout)
    assert (prepared.hot is not None) == (fanout == 20)
    assert as_dict(graph.pagerank(edges, 4, layout, cache, 2, fanout)) == pytest.approx(
        plain_pagerank(pairs, 4, False)
    )
    if layout == "hash":
        assert as_dict(graph.pagerank_graph(edges, 7, 3, fanout)) == pytest.approx(plain_pagerank(pairs, 7, True))


def test_iterations_zero(spark):
    edges = edges_of(spark, CHAIN + [(3, 4)])
    assert as_dict(graph.pagerank(edges, 0)) == as_dict(graph.pagerank(edges, 1))
    assert as_dict(graph.pagerank_graph(edges, 0)) == {1: 1.0, 2: 1.0, 3: 1.0, 4: 0.0}


def test_messages_reach_receivers_only(spark):
    edges = edges_of(spark, [(1, 2), (1, 2), (3, 1)])
    vertices = spark.createDataFrame([(1, 5), (2, 6), (3, 7)], "id BIGINT, w INT")
    got = graph.aggregate_messages(vertices, edges, "dst", F.col("src_w"), total=F.sum, n=F.count)
    assert sorted((r.id, r.total, r.n) for r in got.collect()) == [(1, 7, 1), (2, 10, 2)]
    degrees = graph.out_degrees(vertices, edges)
    assert sorted((r.id, r.out_degree) for r in degrees.collect()) == [(1, 2), (2, 0), (3, 1)]
    assert graph.triplets(vertices, edges).count() == 3


def test_adjacency_keeps_parallel_edges(spark):
    rows = graph.adjacency_lists(edges_of(spark, [(1, 3), (1, 2), (1, 3)])).collect()
    assert sorted((r.src, r.dst, r.times, r.n_out) for r in rows) == [(1, 2, 1, 3), (1, 3, 2, 3)]


def test_edge_list_rules(spark, tmp_path):
    (tmp_path / "e.txt").write_text("# c\n1 2\n1\t2\n3  4  \n 5 6\n7 7\n8\n9 10 11\n\nweb page\n")
    rows = edge_list(spark, str(tmp_path), 3).collect()
    assert sorted(map(tuple, rows)) == [("1", "2"), ("1", "2"), ("3", "4"), ("web", "page")]


def test_vertex_lines_are_numbered_in_order(spark, tmp_path):
    lines = [f"{1000 + i} w{i} x y" for i in range(50)]
    (tmp_path / "a.txt").write_text("\n".join(lines[:30]) + "\n")
    (tmp_path / "b.txt").write_text("\n".join(lines[30:]) + "\n")
    rows = vertex_words(spark, str(tmp_path)).orderBy("id").collect()
    assert [(r.id, r.words) for r in rows] == [(i, [f"w{i}", "x", "y"]) for i in range(50)]


def overlaps(vertices):
    return {
        (i, j, 1 if len(a) > len(b) else 2)
        for (i, a), (j, b) in itertools.permutations(vertices.items(), 2)
        if set(a) & set(b)
    }


@pytest.mark.parametrize("light", [1, 4, 1000])
def test_overlap_equals_brute_force_over_bitmap_blocks(spark, light):
    rng = random.Random(5)
    ids = [0, 1, 2, 32766, 32767, 32768, 65535, 65536, *range(100, 130)]
    vertices = {
        i: [f"w{rng.randrange(200)}" for _ in range(rng.randrange(0, 6))] + (["hot"] if rng.random() < 0.4 else [])
        for i in ids
    }
    df = spark.createDataFrame(list(vertices.items()), "id BIGINT, words ARRAY<STRING>")
    expected = overlaps(vertices)
    members = overlap.word_sets(df)
    bits = overlap.neighbor_bitmaps(members, light=light).mapInArrow(overlap._unpack, "src BIGINT, dst BIGINT")
    assert sorted(map(tuple, bits.collect())) == sorted((i, j) for i, j, _ in expected)
    if light == 4:
        assert set(map(tuple, overlap.overlap_edges(df).collect())) == expected
        assert overlap.longer_edge_count(df).first().n_edges == sum(a == 1 for _, _, a in expected)
        degree = {i: sum(e[0] == i for e in expected) for i in ids}
        best = max(ids, key=lambda i: (degree[i], len(vertices[i]), -i))
        assert overlap.most_popular_vertex(df).first().id == best
        averages = {r.id: r.avg_words for r in overlap.neighborhood_avg_words(df).collect()}
        shifted = {r.id: r.avg_words for r in overlap.neighborhood_avg_words(df, count_timestamp=True).collect()}
        for i in averages:
            near = [len(vertices[j]) for s, j, _ in expected if s == i]
            assert averages[i] == pytest.approx(sum(near) / len(near))
            assert shifted[i] == pytest.approx(averages[i] + 1)

"""Graph queries and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.operators import graph, overlap
from rivulet.plans import frames as fr
from rivulet.plans.frames import with_sql
from rivulet.runtime import fresh_path
from rivulet.sources.files import edge_list


def edge_list_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the links as edge-list text with comments, self-loops and bad lines, and reads it back."""
    src = F.col("l_partkey").cast("string")
    other = (F.col("l_suppkey") * 20 + F.col("l_linenumber")).cast("string")
    dst = F.when(F.col("l_discount") == 0, src).otherwise(other)
    line = (
        F.when(F.col("l_linenumber") == 7, F.concat(F.lit("# "), src, F.lit(" "), dst))
        .when((F.col("l_linenumber") == 6) & (F.col("l_returnflag") == "R"), F.concat(src, F.lit(" "), dst, F.lit(" x")))
        .when(F.col("l_linenumber") == 5, F.concat(F.lit(" "), src, F.lit(" "), dst))
        .when(F.col("l_linenumber") == 4, F.concat(src, F.lit("\t"), dst, F.lit("  ")))
        .when(F.col("l_linenumber") == 3, F.concat(src, F.lit("  \t"), dst))
        .otherwise(F.concat(src, F.lit("\t"), dst))
    )
    path = fresh_path(spark, "edge-list")
    fr.table(spark, sf_dir, "lineitem").select(line.alias("value")).write.text(path)
    return edge_list(spark, path)


def edge_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.edge_vertices(fr.links(spark, sf_dir))


def adjacency_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.adjacency_lists(fr.links(spark, sf_dir))


def _degrees(edges: DataFrame) -> DataFrame:
    return graph.out_degrees(graph.edge_vertices(edges).select("id"), edges)


def graph_out_degrees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _degrees(fr.links(spark, sf_dir))


def graph_triplets(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = fr.links(spark, sf_dir)
    return graph.triplets(_degrees(edges), edges)


def aggregate_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = fr.links(spark, sf_dir)
    return graph.aggregate_messages(
        _degrees(edges), edges, "dst", F.col("src_out_degree"),
        received=F.sum, n_messages=F.count, largest=F.max,
    )


def _rounded(ranks: DataFrame) -> DataFrame:
    return ranks.select("id", F.round("rank", 6).alias("rank"))


def pagerank_rdd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(graph.pagerank(fr.links(spark, sf_dir)))


def pagerank_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(graph.pagerank(fr.links(spark, sf_dir), layout="range"))


def pagerank_cached(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(graph.pagerank(fr.links(spark, sf_dir), layout="range", cache=True))


def pagerank_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.rank_preview(pagerank_rdd(spark, sf_dir))


def pagerank_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(graph.pagerank_graph(fr.links(spark, sf_dir)))


def word_overlap_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap.overlap_edges(fr.overlap_vertices(spark, sf_dir))


def edge_compare_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap.longer_edge_count(fr.overlap_vertices(spark, sf_dir))


def most_popular_vertex(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap.most_popular_vertex(fr.overlap_vertices(spark, sf_dir))


def neighborhood_avg_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    averages = overlap.neighborhood_avg_words(fr.overlap_vertices(spark, sf_dir))
    return averages.select("id", F.round("avg_words", 6).alias("avg_words"))


def most_linked_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap.most_popular_vertex(fr.document_vertices(spark, sf_dir))


def document_neighborhood_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    averages = overlap.neighborhood_avg_words(fr.document_vertices(spark, sf_dir))
    return averages.select("id", F.round("avg_words", 6).alias("avg_words"))


QUERIES = {
    f.__name__: f
    for f in (
        edge_list_scan, edge_vertices, adjacency_lists, graph_out_degrees, graph_triplets, aggregate_messages,
        pagerank_rdd, pagerank_range, pagerank_cached, pagerank_preview, pagerank_graph,
        word_overlap_edges, edge_compare_count, most_popular_vertex, neighborhood_avg_words,
        most_linked_document, document_neighborhood_words,
    )
}

_SHARES = """deg AS MATERIALIZED (SELECT src, count(*) AS n FROM links GROUP BY src),
vs AS MATERIALIZED (SELECT id FROM vertices)"""


def _pagerank_sql(iterations: int, final: str, keep: bool) -> str:
    """One materialised step per iteration; ``keep`` lets vertices without messages stay."""
    steps = ["r0 AS MATERIALIZED (SELECT id, 1.0::DOUBLE AS rank FROM vs)"]
    if keep:
        steps = [
            "r0 AS MATERIALIZED (SELECT id, CASE WHEN id IN (SELECT src FROM links) THEN 1.0::DOUBLE ELSE 0.0 END"
            " AS rank FROM vs)"
        ]
    for k in range(1, iterations + 1):
        received = (
            "SELECT l.dst AS id, 0.15::DOUBLE + 0.85::DOUBLE * sum(r.rank / d.n) AS rank "
            f"FROM links l JOIN r{k - 1} r ON l.src = r.id JOIN deg d ON d.src = l.src GROUP BY l.dst"
        )
        if keep:
            steps.append(f"m{k} AS MATERIALIZED ({received})")
            received = f"SELECT o.id, coalesce(m.rank, o.rank) AS rank FROM r{k - 1} o LEFT JOIN m{k} m USING (id)"
        steps.append(f"r{k} AS MATERIALIZED ({received})")
    steps.append(
        f"ranks AS (SELECT id, round(coalesce(r.rank, 1.0), 6) AS rank FROM vs LEFT JOIN r{iterations} r USING (id))"
    )
    return with_sql(fr.SQL_LINKS, fr.SQL_VERTICES, _SHARES, *steps, select=final)


_RANKS = "SELECT id, rank FROM ranks"
_MOST_LINKED = """SELECT src AS id, count(*) AS degree, any_value(src_n) AS n_words FROM overlap
  GROUP BY src ORDER BY degree DESC, n_words DESC, id LIMIT 1"""
_AVERAGES = "SELECT src AS id, round(avg(dst_n), 6) AS avg_words FROM overlap GROUP BY src"
_DEGREE = "degree AS (SELECT id, (SELECT count(*) FROM links WHERE src = id) AS out_degree FROM vertices)"

ORACLES = {
    "edge_list_scan": """
      SELECT CAST(l_partkey AS VARCHAR) AS src, CAST(l_suppkey * 20 + l_linenumber AS VARCHAR) AS dst
      FROM lineitem
      WHERE l_linenumber NOT IN (5, 7) AND NOT (l_linenumber = 6 AND l_returnflag = 'R')
        AND l_discount <> 0 AND l_partkey <> l_suppkey * 20 + l_linenumber""",
    "edge_vertices": with_sql(
        fr.SQL_LINKS, fr.SQL_VERTICES, select="SELECT id, 1.0::DOUBLE AS rank FROM vertices"
    ),
    "adjacency_lists": with_sql(
        fr.SQL_LINKS,
        "counted AS (SELECT src, dst, count(*) AS times FROM links GROUP BY src, dst)",
        select="SELECT src, dst, times, sum(times) OVER (PARTITION BY src)::BIGINT AS n_out FROM counted",
    ),
    "graph_out_degrees": with_sql(
        fr.SQL_LINKS, fr.SQL_VERTICES, _DEGREE, select="SELECT id, out_degree FROM degree"
    ),
    "graph_triplets": with_sql(
        fr.SQL_LINKS, fr.SQL_VERTICES, _DEGREE,
        select="""SELECT src, dst, s.out_degree AS src_out_degree, d.out_degree AS dst_out_degree
          FROM links JOIN degree s ON s.id = src JOIN degree d ON d.id = dst""",
    ),
    "aggregate_messages": with_sql(
        fr.SQL_LINKS, fr.SQL_VERTICES, _DEGREE,
        select="""SELECT dst AS id, sum(s.out_degree)::BIGINT AS received, count(*) AS n_messages,
          max(s.out_degree) AS largest FROM links JOIN degree s ON s.id = src GROUP BY dst""",
    ),
    "pagerank_rdd": _pagerank_sql(10, _RANKS, keep=False),
    "pagerank_range": _pagerank_sql(10, _RANKS, keep=False),
    "pagerank_cached": _pagerank_sql(10, _RANKS, keep=False),
    "pagerank_preview": _pagerank_sql(10, _RANKS + " ORDER BY rank DESC, id LIMIT 100", keep=False),
    "pagerank_graph": _pagerank_sql(20, _RANKS, keep=True),
    "word_overlap_edges": with_sql(
        fr.SQL_OVERLAP,
        select="SELECT src, dst, CASE WHEN src_n > dst_n THEN 1 ELSE 2 END::BIGINT AS attr FROM overlap",
    ),
    "edge_compare_count": with_sql(
        fr.SQL_OVERLAP, select="SELECT count(*) AS n_edges FROM overlap WHERE src_n > dst_n"
    ),
    "most_popular_vertex": with_sql(fr.SQL_OVERLAP, select=_MOST_LINKED),
    "neighborhood_avg_words": with_sql(fr.SQL_OVERLAP, select=_AVERAGES),
    "most_linked_document": with_sql(fr.SQL_DOCUMENT_OVERLAP, select=_MOST_LINKED),
    "document_neighborhood_words": with_sql(fr.SQL_DOCUMENT_OVERLAP, select=_AVERAGES),
}

"""Graph and PageRank queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.common import (
    GRAPH_SQL,
    ONE_WAY_SQL,
    graph_nodes,
    part_supplier_links,
    part_supplier_pairs,
    rank_rounds_sql,
    table,
)
from corpusloom.operators import graph as G
from corpusloom.operators.pagerank import pagerank_vector, rank_pages, top_pages
from corpusloom.runtime import checkpoint

QUERIES, ORACLES = {}, {}
DIGITS = 10


def query(name, sql=None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def _edges(spark, sf, stored=False):
    return G.edges(part_supplier_links(spark, sf), stored)


def _matrix_and_vector(spark, sf):
    edge_rows = _edges(spark, sf, stored=True)  # read for degrees, cells and nodes
    return G.transition_matrix(edge_rows), G.uniform_vector(checkpoint(graph_nodes(edge_rows)))


def _rounded(df, *columns):
    for c in columns:
        df = df.withColumn(c, F.round(c, DIGITS))
    return df


@query("graph_edges", f"WITH {GRAPH_SQL} SELECT src, dst FROM edges")
def graph_edges(spark, sf):
    return _edges(spark, sf)


@query("out_degree", f"WITH {GRAPH_SQL} SELECT src, count(*) AS out_degree FROM edges GROUP BY src")
def out_degree(spark, sf):
    return G.out_degree(_edges(spark, sf))


@query("transitions", f"WITH {GRAPH_SQL} SELECT dst, src, round(p, {DIGITS}) AS p FROM trans")
def transitions(spark, sf):
    return _rounded(G.transition_matrix(_edges(spark, sf)), "p")


@query("uniform_vector", f"WITH {GRAPH_SQL} SELECT id, round(p, {DIGITS}) AS p FROM vec")
def uniform_vector(spark, sf):
    return _rounded(G.uniform_vector(graph_nodes(_edges(spark, sf))), "p")


@query("node_count", "SELECT max(doc_id) + 1 AS n_nodes FROM documents")
def node_count(spark, sf):
    return G.node_count(table(spark, sf, "documents").select(F.col("doc_id").alias("id")))


@query(
    "matvec_step",
    f"WITH {GRAPH_SQL}, {rank_rounds_sql(1)} SELECT id, round(p, {DIGITS}) AS p FROM r1",
)
def matvec_step(spark, sf):
    matrix, vector = _matrix_and_vector(spark, sf)
    return _rounded(G.add_taxation(G.matvec(matrix, vector), vector, 0.85), "p")


_RANKED = "SELECT row_number() OVER (ORDER BY round(p, 12) DESC, id) - 1 AS rank, id AS page_id, round(p, 12) AS score FROM {r}"


def _settled(vector):
    """Rounded before ranking: sums taken in another order must not swap equal scores."""
    return vector.withColumn("p", F.round("p", 12))


@query("pagerank_10", f"WITH {GRAPH_SQL}, {rank_rounds_sql(10)} " + _RANKED.format(r="r10"))
def pagerank_10(spark, sf):
    matrix, vector = _matrix_and_vector(spark, sf)
    return rank_pages(_settled(pagerank_vector(matrix, vector, epsilon=0.0, max_iter=10)))


@query(
    "pagerank_topk",
    f"WITH {GRAPH_SQL}, {rank_rounds_sql(3)} SELECT id AS page_id, round(p, 12) AS score FROM r3 "
    "ORDER BY round(p, 12) DESC, id LIMIT 20",
)
def pagerank_topk(spark, sf):
    matrix, vector = _matrix_and_vector(spark, sf)
    return top_pages(_settled(pagerank_vector(matrix, vector, epsilon=0.0, max_iter=3)), 20)


@query(
    "pagerank_delta",
    f"WITH {GRAPH_SQL}, {rank_rounds_sql(2)} "
    "SELECT round(sum(abs(a.p - b.p)) / count(*), 12) AS mean_abs_change FROM r1 a JOIN r2 b ON a.id = b.id",
)
def pagerank_delta(spark, sf):
    matrix, vector = _matrix_and_vector(spark, sf)
    one = pagerank_vector(matrix, vector, epsilon=0.0, max_iter=1)
    two = pagerank_vector(matrix, vector, epsilon=0.0, max_iter=2)
    return G.mean_abs_change(one, two).select(F.round("mean_abs_change", 12).alias("mean_abs_change"))


@query(
    "pagerank_dangling",
    f"WITH {ONE_WAY_SQL}, {rank_rounds_sql(4)} SELECT id, round(p, {DIGITS}) AS p FROM r4",
)
def pagerank_dangling(spark, sf):
    edge_rows = checkpoint(G.edges(part_supplier_pairs(spark, sf)))
    vector = G.uniform_vector(graph_nodes(edge_rows))
    return _rounded(pagerank_vector(G.transition_matrix(edge_rows), vector, epsilon=0.0, max_iter=4), "p")


_PERSONAL = GRAPH_SQL.replace(
    "vec AS (SELECT id, 1.0::DOUBLE / (SELECT count(*) FROM nodes) AS p FROM nodes)",
    "lines AS (SELECT dst AS id, count(*) AS n FROM pairs GROUP BY dst), "
    "vec AS (SELECT nodes.id, coalesce(lines.n, 0)::DOUBLE / (SELECT count(*) FROM lineitem) AS p "
    "FROM nodes LEFT JOIN lines ON nodes.id = lines.id)",
)


@query("pagerank_personal", f"WITH {_PERSONAL}, {rank_rounds_sql(5)} SELECT id, round(p, {DIGITS}) AS p FROM r5")
def pagerank_personal(spark, sf):
    edge_rows = checkpoint(_edges(spark, sf))  # read for degrees, cells and nodes
    pairs = part_supplier_pairs(spark, sf)
    lines = pairs.groupBy(F.col("dst").alias("id")).agg(F.count(F.lit(1)).alias("n"))
    total = pairs.agg(F.count(F.lit(1)).cast("double"))
    vector = graph_nodes(edge_rows).join(lines, "id", "left").select(
        "id", (F.coalesce("n", F.lit(0)).cast("double") / total.scalar()).alias("p")
    )
    return _rounded(pagerank_vector(G.transition_matrix(edge_rows), vector, epsilon=0.0, max_iter=5), "p")


# With epsilon 1e-6 this graph settles within 50 rounds on the given tables; the SQL
# twin walks 50 rounds and picks the first whose change is small enough.
_CONVERGED = (
    f"WITH {GRAPH_SQL}, {rank_rounds_sql(50)}, changes AS ("
    + " UNION ALL ".join(
        f"SELECT {i} AS i, sum(abs(a.p - b.p)) / count(*) AS d FROM r{i} a JOIN {'vec' if i == 1 else f'r{i - 1}'} b ON a.id = b.id"
        for i in range(1, 51)
    )
    + "), stop AS (SELECT coalesce(min(i) FILTER (WHERE d <= 1e-6), 50) AS i FROM changes) "
    + " UNION ALL ".join(f"SELECT id, round(p, {DIGITS}) AS p FROM r{i} WHERE (SELECT i FROM stop) = {i}" for i in range(1, 51))
)


@query("pagerank_converged", _CONVERGED)
def pagerank_converged(spark, sf):
    matrix, vector = _matrix_and_vector(spark, sf)
    return _rounded(pagerank_vector(matrix, vector), "p")


@query(
    "adjacency",
    f"WITH {GRAPH_SQL} SELECT src, string_agg(dst, ' ' ORDER BY dst) AS dsts FROM edges GROUP BY src",
)
def adjacency(spark, sf):
    return G.adjacency(_edges(spark, sf)).select("src", F.concat_ws(" ", "dsts").alias("dsts"))

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import graph as G
from corpusloom.operators.pagerank import pagerank, pagerank_vector, rank_pages
from corpusloom.operators.ranking import with_position
from corpusloom.runtime import attach_by_key, checkpoint, checkpoint_dir, parts_kept

EDGES = [(0, 1), (0, 2), (1, 2), (2, 0), (3, 2), (3, 2)]


def _graph(spark, edges=EDGES, nodes=4):
    rows = G.edges(spark.createDataFrame(edges, "src long, dst long"))
    vector = G.uniform_vector(spark.range(nodes))
    return rows, G.transition_matrix(rows), vector


def _values(vector):
    return {r["id"]: r["p"] for r in vector.collect()}


@pytest.mark.parametrize(
    "rounds, expected",
    [(1, [0.25, 0.14375, 0.56875, 0.0375]), (2, [0.5209375, 0.14375, 0.2978125, 0.0375])],
)
def test_rounds(spark, rounds, expected):
    _, matrix, vector = _graph(spark)
    got = _values(pagerank_vector(matrix, vector, epsilon=0.0, max_iter=rounds))
    assert [got[i] for i in range(4)] == pytest.approx(expected, abs=1e-12)


def test_stops_when_settled(spark):
    _, matrix, vector = _graph(spark)
    got = _values(pagerank_vector(matrix, vector))
    assert [got[i] for i in range(4)] == pytest.approx([0.37252625, 0.19582365, 0.3941501, 0.0375], abs=1e-7)
    assert sum(got.values()) == pytest.approx(1.0)


def test_dangling_mass_leaks(spark):
    _, matrix, vector = _graph(spark, [e for e in EDGES if e != (2, 0)])
    got = _values(pagerank_vector(matrix, vector))
    assert [got[i] for i in range(4)] == pytest.approx([0.0375, 0.0534375, 0.13073438, 0.0375], abs=1e-7)
    assert sum(got.values()) == pytest.approx(0.259171875)


def test_change_of_two_rounds(spark):
    _, matrix, vector = _graph(spark)
    one = pagerank_vector(matrix, vector, epsilon=0.0, max_iter=1)
    assert G.mean_abs_change(vector, one).first()[0] == pytest.approx(0.159375)


def test_hot_sources_give_the_same_ranks(spark):
    star = [(0, i) for i in range(1, 200)] + [(i, i % 7) for i in range(1, 200)]
    rows = G.edges(spark.createDataFrame(star, "src long, dst long"))
    vector = G.uniform_vector(spark.range(200))
    plain = G.transition_matrix(rows)
    split = G.transition_matrix(rows, min_hot_rows=50)
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, split.collect()))
    want = _values(pagerank_vector(plain, vector, epsilon=0.0, max_iter=4))
    got = _values(pagerank_vector(split, vector, epsilon=0.0, max_iter=4, min_hot_rows=50))
    assert got == pytest.approx(want)


def _stored_tables(spark):
    """Folders of checkpoints that hold files."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(checkpoint_dir(spark))
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return {f.getPath().getName() for f in files.listStatus(root) if f.getPath().getName().startswith("rdd-")}


@pytest.mark.parametrize("row_limit", [100_000, 20])
def test_stored_edges_give_the_same_ranks(spark, row_limit):
    links = [(0, i) for i in range(1, 200)] + [(i, i % 7) for i in range(1, 200)] + [(0, 5), (3, None), (None, 3)]
    links = spark.createDataFrame(links, "src long, dst long")
    plain, stored = G.edges(links), G.edges(links, stored=True, row_limit=row_limit)
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, plain.collect()))
    matrix, want = G.transition_matrix(stored), G.transition_matrix(plain)
    assert sorted(map(tuple, matrix.collect())) == sorted(map(tuple, want.collect()))
    vector = G.uniform_vector(spark.range(200))
    ranks = _values(pagerank_vector(matrix, vector, epsilon=0.0, max_iter=4))
    assert ranks == pytest.approx(_values(pagerank_vector(want, vector, epsilon=0.0, max_iter=4)))


def test_rounds_leave_one_table_and_move_no_edges(spark):
    matrix = G.transition_matrix(G.edges(spark.createDataFrame(EDGES, "src long, dst long"), stored=True))
    vector = checkpoint(G.uniform_vector(spark.range(4)))
    before = _stored_tables(spark)
    ranks = pagerank_vector(matrix, vector, epsilon=0.0, max_iter=5)
    assert len(_stored_tables(spark) - before) == 1
    with parts_kept(spark):
        plan = matrix._lists.join(ranks.withColumnRenamed("id", "src").hint("merge"), "src")
        assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()
    assert len(_values(ranks)) == 4


def test_attach_by_key_keeps_unmatched_and_null_keys(spark):
    rows = spark.createDataFrame([("a", 1)] * 20 + [("b", 2), ("zz", 3), (None, 4)], "k string, n int")
    lookup = spark.createDataFrame([("a", "A"), ("b", "B")], "k string, v string")
    for how in ("inner", "left"):
        want = sorted(rows.join(lookup, "k", how).collect(), key=str)
        assert sorted(attach_by_key(rows, lookup, "k", how, min_rows=5).collect(), key=str) == want


def test_attach_by_key_with_thousands_of_hot_keys(spark):
    rows = spark.range(20_000).select((F.col("id") % 4000).alias("k"), F.col("id").alias("n"))
    lookup = spark.range(3000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    for how in ("inner", "left"):
        want = rows.join(lookup, "k", how)
        got = attach_by_key(rows, lookup, "k", how, min_rows=2)
        assert got.columns == want.columns
        assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)


def test_attach_by_key_with_null_keys_only(spark):
    rows = spark.createDataFrame([(None, i) for i in range(50)], "k string, n int")
    lookup = spark.createDataFrame([("a", "A")], "k string, v string")
    assert attach_by_key(rows, lookup, "k", "inner", min_rows=5).count() == 0
    got = attach_by_key(rows, lookup, "k", "left", min_rows=5).collect()
    assert sorted(r.n for r in got) == list(range(50)) and {r.v for r in got} == {None}


def test_rank_ties_by_id_and_spans_partitions(spark):
    vector = spark.range(1000).select("id", (F.col("id") % 10).cast("double").alias("p")).repartition(7)
    got = [(r["rank"], r["page_id"]) for r in rank_pages(vector).orderBy("rank").collect()]
    ids = sorted(range(1000), key=lambda i: (-(i % 10), i))
    assert got == list(enumerate(ids))


def test_positions_of_an_empty_table(spark):
    assert with_position(spark.range(0), F.col("id")).count() == 0


def test_page_rank_rows(spark):
    _, matrix, vector = _graph(spark)
    got = [(r["rank"], r["page_id"]) for r in pagerank(matrix, vector).orderBy("rank").collect()]
    assert got == [(0, 2), (1, 0), (2, 1), (3, 3)]


def test_large_neighbourhoods_continue_on_further_rows(spark):
    rows = spark.createDataFrame([(1, i) for i in range(100)] + [(2, 5)], "src long, dst long")
    lists = G.adjacency(rows, spark.range(1, 4), row_limit=10)
    hub = [(r["part"], r["dsts"]) for r in lists.filter("src = 1").orderBy("part").collect()]
    assert hub == [(n, list(range(10 * n, 10 * n + 10))) for n in range(10)]
    assert [(r["part"], r["dsts"]) for r in lists.filter("src = 2").collect()] == [(0, [5])]
    assert G.adjacency_edges(lists).exceptAll(rows).count() == 0 and G.adjacency_edges(lists).count() == 101
    assert [r["dsts"] for r in lists.filter("src = 3").collect()] == [[]]


def test_node_count_and_no_links(spark):
    assert G.node_count(spark.createDataFrame([(0, 0.5), (7, 0.5)], "id long, p double")).first()[0] == 8
    matrix = spark.createDataFrame([], "dst long, src long, p double")
    got = _values(pagerank_vector(matrix, G.uniform_vector(spark.range(4))))
    assert got == pytest.approx({i: 0.0375 for i in range(4)})


def test_a_stored_table_is_not_stored_again(spark):
    rows = checkpoint(spark.createDataFrame([(1, 2), (1, 3), (1, 4), (2, 1)], "src long, dst long"))
    assert checkpoint(rows) is rows
    assert checkpoint(rows.filter("src = 1")) is not rows


def test_hot_keys_by_the_counts_of_the_lookup(spark):
    rows = spark.createDataFrame([(1, 2), (1, 3), (1, 4), (2, 1), (None, 5)], "src long, dst long")
    lookup = spark.createDataFrame([(1, 3), (2, 1)], "src long, n long")
    got = attach_by_key(rows, lookup, "src", "left", min_rows=1, counts="n").select("src", "dst", "n").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, [(1, 2, 3), (1, 3, 3), (1, 4, 3), (2, 1, 1), (None, 5, None)]))

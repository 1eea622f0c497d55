"""Link graph: edges, degrees, transition matrix, vectors, adjacency rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.ranking import with_position
from corpusloom.runtime import (
    attach_by_key,
    checkpoint,
    hot_keys,
    parts_kept,
    salt_rows,
    shuffles_dropped,
    sized_broadcast,
)

# Longest adjacency row; a larger neighbourhood continues on further rows.
ADJACENCY_ROW = 100_000


def edges(links: DataFrame, stored: bool = False, row_limit: int = ADJACENCY_ROW) -> DataFrame:
    """Distinct directed edges (src, dst); self-loops stay.

    ``stored`` writes them once as lists of the targets of a source, laid out by source: repeats leave before the
    only shuffle, which holds a source once a task, and whose files are deleted. Sources with more than
    ``row_limit`` links are dealt over several lists by their targets.
    """
    spark, pairs = links.sparkSession, links.select("src", "dst").filter("src IS NOT NULL AND dst IS NOT NULL")
    if not stored:
        return pairs.distinct()
    with shuffles_dropped(spark), parts_kept(spark):
        hot = hot_keys(pairs, "src", row_limit)
        dealt, keys = (pairs, ["src"]) if hot is None else (salt_rows(pairs, "src", hot), ["src", "_salt"])
        lists = checkpoint(dealt.groupBy(*keys).agg(F.collect_set("dst").alias("dsts")))
    rows = lists.select("src", F.explode("dsts").alias("dst"))
    rows._stored_rows, rows._lists = True, lists
    return rows


def out_degree(edge_rows: DataFrame) -> DataFrame:
    return edge_rows.groupBy("src").agg(F.count(F.lit(1)).alias("out_degree"))


def transition_matrix(edge_rows: DataFrame, min_hot_rows: int | None = None) -> DataFrame:
    """(dst, src, p) with p = 1 / number of distinct links of src.

    Of stored edges a list gets its p as a whole, and nothing is stored again.
    """
    if "_lists" in edge_rows.__dict__:
        lists = _weighted(edge_rows._lists)
        cells = lists.select(F.explode("dsts").alias("dst"), "src", "p")
        cells._lists = lists
        return cells
    edge_rows = checkpoint(edge_rows)  # counted and joined
    degrees = checkpoint(out_degree(edge_rows))
    return attach_by_key(edge_rows, degrees, "src", min_rows=min_hot_rows, counts="out_degree").select(
        "dst", "src", (F.lit(1.0) / F.col("out_degree")).alias("p")
    )


def _weighted(lists: DataFrame) -> DataFrame:
    """Lists of targets with their p; only sources with several lists are counted together."""
    size = F.size("dsts").cast("long")
    if "_salt" not in lists.columns:
        return lists.withColumn("p", F.lit(1.0) / size)
    several = lists.filter("_salt > 0").select("src").distinct()
    degrees = lists.join(several, "src", "left_semi").groupBy("src").agg(F.sum(size).alias("_degree"))
    counted = lists.join(sized_broadcast(checkpoint(degrees)), "src", "left")
    return counted.withColumn("p", F.lit(1.0) / F.coalesce("_degree", size)).drop("_degree")


def node_count(vector: DataFrame) -> DataFrame:
    """Size of a vector with dense ids from 0: the largest id plus one."""
    return vector.agg((F.max("id") + 1).alias("n_nodes"))


def uniform_vector(nodes: DataFrame) -> DataFrame:
    """(id, p) with p = 1/N for every node of a one-column table ``id``."""
    total = nodes.agg(F.count(F.lit(1)).cast("double").alias("n"))
    return nodes.select("id", (F.lit(1.0) / total.scalar()).alias("p"))


def adjacency(edge_rows: DataFrame, nodes: DataFrame | None = None, row_limit: int = ADJACENCY_ROW) -> DataFrame:
    """(src, part, dsts): the sorted distinct link targets of each page.

    A source with more than ``row_limit`` targets has several rows, each with so many targets at
    most; their ``part`` numbers count from 0 and their lists follow each other in order. Any other source
    has part 0 alone. The targets of large sources are placed by a distributed sort, so no task
    holds an unbounded list. Nodes without any link get one row with an empty list when ``nodes`` is given.
    """
    degrees = out_degree(edge_rows)
    large = degrees.filter(F.col("out_degree") > row_limit).select("src", F.lit(True).alias("_large"))
    # the rows of large sources are the only ones to learn that they are
    marked = checkpoint(attach_by_key(edge_rows, large, "src", "left"))
    lists = F.sort_array(F.collect_set("dst")).alias("dsts")
    found = marked.filter("_large IS NULL").groupBy("src").agg(lists).select("src", F.lit(0).cast("long").alias("part"), "dsts")
    hubs = marked.filter("_large").select("src", "dst").distinct()
    if not hubs.isEmpty():
        placed = with_position(hubs, F.col("src"), F.col("dst"), name="_place")
        firsts = placed.groupBy("src").agg(F.min("_place").alias("_first"))
        parted = attach_by_key(placed, firsts, "src").withColumn("part", F.floor((F.col("_place") - F.col("_first")) / row_limit))
        found = found.unionByName(parted.groupBy("src", "part").agg(lists))
    if nodes is None:
        return found
    empty = F.array().cast(found.schema["dsts"].dataType)
    lonely = nodes.select(F.col("id").alias("src")).join(degrees, "src", "left_anti")
    return found.unionByName(lonely.select("src", F.lit(0).cast("long").alias("part"), empty.alias("dsts")))


def adjacency_edges(rows: DataFrame) -> DataFrame:
    """Back from adjacency rows to edges."""
    return rows.select("src", F.explode("dsts").alias("dst"))


def matvec(transitions: DataFrame, vector: DataFrame) -> DataFrame:
    """(id, p): the matrix times the vector; rows without an entry are absent."""
    hits = attach_by_key(transitions, vector.select(F.col("id").alias("src"), F.col("p").alias("v")), "src")
    return hits.groupBy(F.col("dst").alias("id")).agg(F.sum(F.col("p") * F.col("v")).alias("p"))


def add_taxation(product: DataFrame, start: DataFrame, beta: float) -> DataFrame:
    """beta * product + (1 - beta) * start for every id of ``start``."""
    return start.join(product.select("id", F.col("p").alias("_m")), "id", "left").select(
        "id", (F.lit(beta) * F.coalesce("_m", F.lit(0.0)) + F.lit(1.0 - beta) * F.col("p")).alias("p")
    )


def mean_abs_change(old: DataFrame, new: DataFrame) -> DataFrame:
    """One row: sum of |new - old| over all ids, divided by the number of ids."""
    both = old.select("id", F.col("p").alias("_old")).join(new.select("id", F.col("p").alias("_new")), "id", "full")
    change = F.abs(F.coalesce("_new", F.lit(0.0)) - F.coalesce("_old", F.lit(0.0)))
    return both.agg((F.sum(change) / F.count(F.lit(1))).alias("mean_abs_change"))

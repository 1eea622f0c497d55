"""PageRank with taxation as a bounded loop of joins and sums."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.ranking import with_position
from corpusloom.runtime import (
    checkpoint,
    drop_stored,
    hot_keys,
    parts_kept,
    salt_lookup,
    salt_rows,
    shuffle_partitions,
    shuffles_dropped,
    sized_broadcast,
)


def pagerank_vector(
    transitions: DataFrame,
    vector: DataFrame,
    beta: float = 0.85,
    epsilon: float = 1e-6,
    max_iter: int = 50,
    min_hot_rows: int | None = None,
) -> DataFrame:
    """v <- beta*M*v + (1-beta)*v0, started at v0 = ``vector``, which is also the
    teleport target, so a non-uniform vector gives a personalised rank.

    Stops after ``max_iter`` rounds, or once the mean absolute change is at most
    ``epsilon`` (0 runs all rounds without looking). Mass of nodes without links leaks.

    The edges are laid out by source once, as lists of targets; those of stored edges are read where they lie.
    Each round then joins lists in place and shuffles only sums already combined per target; sources with too many
    links for one list have several, each with a copy of their rank. A round leaves its ranks and no other file.
    """
    spark = transitions.sparkSession
    n_parts = shuffle_partitions(spark)
    with shuffles_dropped(spark), parts_kept(spark):
        stored = transitions.__dict__.get("_lists")
        by_source = _lists(transitions, min_hot_rows) if stored is None else stored
        hot, keys = None, ["src"]
        if "_salt" in by_source.columns:  # a copy of the rank for each list of its source
            salts = by_source.filter("_salt > 0").groupBy("src").agg((F.max("_salt") + 1).alias("_salts"))
            hot, keys = sized_broadcast(checkpoint(salts)), ["src", "_salt"]
        # one row per page: teleport share, rank so far
        state = checkpoint(vector.select("id", F.col("p").alias("v0"), "p").repartition(n_parts, "id"))
        n_nodes = state.count() if epsilon > 0 else 0
        for _ in range(max_iter):
            rank = state.select(F.col("id").alias("src"), F.col("p").alias("v"))
            if hot is not None:
                rank = salt_lookup(rank, "src", hot)
            sent = by_source.join(rank, keys).select(F.explode("dsts").alias("dst"), (F.col("p") * F.col("v")).alias("m"))
            received = sent.groupBy(F.col("dst").alias("id")).agg(F.sum("m").alias("m"))
            new_p = F.lit(beta) * F.coalesce("m", F.lit(0.0)) + F.lit(1.0 - beta) * F.col("v0")
            change = F.abs(new_p - F.col("p")).alias("change")
            before, state = state, checkpoint(state.join(received, "id", "left").select("id", "v0", new_p.alias("p"), change))
            drop_stored(before)
            if epsilon > 0 and (state.agg(F.sum("change")).first()[0] or 0.0) / n_nodes <= epsilon:
                break
    if stored is None:
        drop_stored(by_source)
    return state.select("id", "p")


def _lists(transitions: DataFrame, min_hot_rows: int | None) -> DataFrame:
    """(src, p, dsts): the targets of each source and probability, laid out by source; with ``_salt`` if a source has several lists."""
    # counted for hot sources, then laid out: computed once
    cells = checkpoint(transitions.select("src", "dst", "p"))
    hot = hot_keys(cells, "src", min_hot_rows)
    dealt, keys = (cells, ["src"]) if hot is None else (salt_rows(cells, "src", hot), ["src", "_salt"])
    lists = dealt.repartition(shuffle_partitions(cells.sparkSession), *keys).groupBy(*keys, "p").agg(F.collect_list("dst").alias("dsts"))
    stored = checkpoint(lists)
    drop_stored(cells)
    return stored


def rank_pages(vector: DataFrame) -> DataFrame:
    """(rank from 0, page_id, score): score descending, equal scores by id."""
    scored = vector.select(F.col("id").alias("page_id"), F.col("p").alias("score"))
    ranked = with_position(scored, F.col("score").desc(), F.col("page_id").asc(), name="rank")
    return ranked.select("rank", "page_id", "score")


def top_pages(vector: DataFrame, count: int) -> DataFrame:
    """The first ``count`` pages of the ranking, without ranking the rest."""
    return (
        vector.select(F.col("id").alias("page_id"), F.col("p").alias("score"))
        .orderBy(F.col("score").desc(), F.col("page_id").asc())
        .limit(count)
    )


def pagerank(transitions: DataFrame, vector: DataFrame, beta: float = 0.85, epsilon: float = 1e-6, max_iter: int = 50) -> DataFrame:
    """Ranked pages straight from a transition matrix and a start vector."""
    return rank_pages(pagerank_vector(transitions, vector, beta, epsilon, max_iter))

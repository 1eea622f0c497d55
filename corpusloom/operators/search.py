"""Keyword search: relevance of every document, best ones in page-rank order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.terms import words


def query_terms(spark, query: str, vocab: DataFrame) -> DataFrame:
    """(pos, word, term_id) of the query words; term_id is null for unknown words."""
    asked = spark.range(1).select(F.posexplode(words(F.lit(query))).alias("pos", "word"))
    return asked.join(vocab.select(F.col("term").alias("word"), "term_id"), "word", "left").select(
        "pos", "word", "term_id"
    )


def unknown_words(terms: DataFrame) -> DataFrame:
    return terms.filter("term_id IS NULL").select("word")


def _weights_of_terms(terms: DataFrame) -> DataFrame:
    """(term_id, times): a word repeated in the query counts each time."""
    return terms.filter("term_id IS NOT NULL").groupBy("term_id").agg(F.count(F.lit(1)).alias("times"))


def tfidf_relevance(doc_ids: DataFrame, tdm: DataFrame, terms: DataFrame) -> DataFrame:
    """(doc_id, relevance) at full rank: the summed weights of the query terms.

    Documents without any of them score 0; a query without a known word gives no row.
    """
    asked = F.broadcast(_weights_of_terms(terms))  # at most one row per query word
    sums = (
        tdm.join(asked, "term_id")
        .groupBy("doc_id")
        .agg(F.sum(F.col("weight") * F.col("times")).alias("relevance"))
    )
    any_known = terms.agg(F.count("term_id").alias("n")).scalar()
    return (
        doc_ids.select("doc_id")
        .join(sums, "doc_id", "left")
        .select("doc_id", F.coalesce("relevance", F.lit(0.0)).alias("relevance"))
        .filter(any_known > 0)
    )


def sum_of_vectors(term_factors: DataFrame, terms: DataFrame) -> DataFrame:
    """One row (q): the term vectors of the query words added up; null if none is known."""
    asked = F.broadcast(_weights_of_terms(terms))
    parts = term_factors.join(asked, "term_id").select("times", F.posexplode("v").alias("i", "x"))
    added = parts.groupBy("i").agg(F.sum(F.col("x") * F.col("times")).alias("x"))
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda s: s["x"])
    return added.agg(F.nullif(in_order, F.array().cast("array<double>")).alias("q"))


def lsa_relevance(doc_factors: DataFrame, term_factors: DataFrame, terms: DataFrame) -> DataFrame:
    """(doc_id, relevance): each document's factors times the query's term vectors."""
    return factor_products(doc_factors, sum_of_vectors(term_factors, terms).scalar())


def factor_products(doc_factors: DataFrame, q: Column) -> DataFrame:
    """(doc_id, relevance): each document's factors times one vector; no rows if that is null."""
    dot = F.aggregate(F.zip_with("us", "_q", lambda a, b: a * b), F.lit(0.0), lambda acc, x: acc + x)
    both = doc_factors.select("doc_id", "us", q.alias("_q")).filter("_q IS NOT NULL")
    return both.select("doc_id", dot.alias("relevance"))


def most_relevant(relevance: DataFrame, count: int = 25) -> DataFrame:
    return relevance.orderBy(F.col("relevance").desc(), F.col("doc_id")).limit(count)


def in_rank_order(relevant: DataFrame, page_rank: DataFrame, page_ids: DataFrame) -> DataFrame:
    """(page_rank, title, relevance) by page rank; documents without a rank vanish."""
    few = F.broadcast(relevant.withColumnRenamed("doc_id", "page_id"))  # the top rows of a limit
    ranked = page_rank.select("page_id", F.col("rank").alias("page_rank")).join(few, "page_id")
    # the titles are met by the few ranked rows, so the large table is never shuffled
    titled = page_ids.select("page_id", "title").join(F.broadcast(ranked), "page_id", "right")
    return titled.select("page_rank", "title", "relevance").orderBy("page_rank")


def search(
    spark,
    query: str,
    vocab: DataFrame,
    doc_factors: DataFrame,
    term_factors: DataFrame,
    page_rank: DataFrame,
    page_ids: DataFrame,
    count: int = 25,
) -> DataFrame:
    """The ``count`` most relevant pages for a keyword query, ordered by page rank."""
    terms = query_terms(spark, query, vocab)
    relevant = most_relevant(lsa_relevance(doc_factors, term_factors, terms), count)
    return in_rank_order(relevant, page_rank, page_ids)

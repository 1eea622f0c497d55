"""All of it: rank the pages, build the index, answer queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpusloom.operators.lsa import lsa
from corpusloom.operators.norm_index import best_documents, write_norm_index
from corpusloom.operators.pagerank import pagerank
from corpusloom.operators.search import in_rank_order, query_terms
from corpusloom.operators.terms import build_tdm
from corpusloom.sinks.tables import write_index
from corpusloom.sources.tables import DOC_FACTORS, read_index


def build_index(
    spark: SparkSession,
    path: str,
    contents: DataFrame,
    page_ids: DataFrame,
    vocab_size: int = 30_000,
    k: int = 300,
    decompose: Callable = lsa,
    **tdm_options,
) -> dict[str, DataFrame]:
    """Write the term-document matrix and its factors under ``path`` and read them back.

    ``decompose`` is ``lsa``, or ``randomised_lsa`` for a corpus whose exact factors take too many passes.
    """
    tdm, vocab = build_tdm(contents, vocab_size, **tdm_options)
    write_index(path, tdm=tdm, vocab=vocab, page_ids=page_ids)
    tdm, vocab = (spark.read.parquet(f"{path}/{name}") for name in ("tdm", "vocab"))
    doc_factors, term_factors = decompose(tdm, vocab, contents, k)
    write_index(path, term_factors=term_factors)
    write_norm_index(doc_factors, f"{path}/{DOC_FACTORS}")
    return read_index(spark, path)


def answer(spark: SparkSession, path: str, query: str, page_rank: DataFrame, count: int = 25) -> DataFrame:
    """Search a written index: the most relevant pages in page-rank order; documents of short factors are not read."""
    index = read_index(spark, path)
    terms = query_terms(spark, query, index["vocab"])
    relevant = best_documents(spark, f"{path}/{DOC_FACTORS}", index["term_factors"], terms, count)
    return in_rank_order(relevant, page_rank, index["page_ids"])


def rank_and_search(
    spark: SparkSession, path: str, query: str, corpus: dict[str, DataFrame], count: int = 25, vocab_size: int = 30_000, k: int = 300
) -> DataFrame:
    """Rank, index and search an extracted corpus in one go."""
    ranked = pagerank(corpus["transitions"], corpus["vector"])
    build_index(spark, path, corpus["contents"], corpus["page_ids"], vocab_size, k)
    return answer(spark, path, query, ranked, count)

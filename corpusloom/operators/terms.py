"""Term counts and the TF-IDF term-document matrix."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.fixed_values import TERM_STOPWORDS, UNICODE_SPACE
from corpusloom.runtime import BROADCAST_ROWS, checkpoint


def words(column):
    """Lower-cased words of a text, split at white space."""
    return F.filter(F.split(F.lower(column), f"[{UNICODE_SPACE}]+"), lambda w: w != "")


def term_counts(contents: DataFrame, stopwords=TERM_STOPWORDS, min_length: int = 3, min_count: int = 3) -> DataFrame:
    """(doc_id, term, cnt): words of each document that occur often enough in it.

    Counting needs no shuffle: a document's sorted words put equal words side by
    side, and a back-reference picks the runs of at least ``min_count``.
    """
    text = F.array_join(F.sort_array(words(F.col("content"))), " ")
    run = r"(?<!\S)(\S{%d,}+)(?: \1(?!\S)){%d,}+" % (min_length, min_count - 1)
    runs = contents.select("doc_id", F.explode(F.regexp_extract_all(text, F.lit(run), F.lit(0))).alias("_run"))
    term = F.substring_index("_run", " ", 1)
    counted = runs.select(
        "doc_id",
        term.alias("term"),
        ((F.length("_run") + 1) / (F.length(term) + 1)).cast("long").alias("cnt"),
    )
    stop = list(stopwords)
    return counted.filter(~F.col("term").isin(stop)) if stop else counted


def term_totals(counts: DataFrame) -> DataFrame:
    """Sum of the kept counts per term."""
    return counts.groupBy("term").agg(F.sum("cnt").alias("total"))


def document_frequency(counts: DataFrame) -> DataFrame:
    """Number of documents that keep the term."""
    return counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def top_vocabulary(counts: DataFrame, size: int) -> DataFrame:
    """(term, total, df) of the ``size`` terms with the largest totals; ties by term."""
    return (
        counts.groupBy("term")
        .agg(F.sum("cnt").alias("total"), F.count(F.lit(1)).alias("df"))
        .orderBy(F.col("total").desc(), F.col("term"))
        .limit(size)
    )


def vocabulary(counts: DataFrame, n_docs: int, size: int = 30_000, idf: str = "floor") -> DataFrame:
    """(term, term_id, df, idf): ids are dense from 0 in term order.

    ``idf="floor"`` divides in integers before the logarithm; ``"exact"`` does not.
    """
    ratio = F.lit(n_docs).cast("double") / F.col("df")
    inverse = F.log(F.floor(ratio).cast("double") if idf == "floor" else ratio)
    top = top_vocabulary(counts, size)
    # at most ``size`` rows are numbered here, however large the corpus
    number = F.row_number().over(Window.orderBy("term")) - 1
    return top.select("term", number.cast("long").alias("term_id"), "df", inverse.alias("idf"))


def _with_vocabulary(counts: DataFrame, vocab: DataFrame, size: int) -> DataFrame:
    return counts.join(F.broadcast(vocab) if size <= BROADCAST_ROWS else vocab, "term")


def max_counts(counts: DataFrame, vocab: DataFrame, size: int = 30_000) -> DataFrame:
    """Largest count of any vocabulary term per document."""
    return _with_vocabulary(counts, vocab, size).groupBy("doc_id").agg(F.max("cnt").alias("max_cnt"))


def term_weights(counts: DataFrame, vocab: DataFrame, size: int = 30_000, tf: str = "half_plus") -> DataFrame:
    """(doc_id, term_id, weight) with weight = tf * idf.

    ``tf="half_plus"`` is 0.5 + cnt/max; ``"augmented"`` is 0.5 + 0.5*cnt/max.
    The maximum is taken over the vocabulary terms of the document.
    """
    known = _with_vocabulary(counts, vocab, size)
    share = F.col("cnt") / F.max("cnt").over(Window.partitionBy("doc_id"))
    frequency = F.lit(0.5) + (share if tf == "half_plus" else 0.5 * share)
    return known.select("doc_id", "term_id", (frequency * F.col("idf")).alias("weight"))


def build_tdm(
    contents: DataFrame,
    vocab_size: int = 30_000,
    idf: str = "floor",
    tf: str = "half_plus",
    stopwords=TERM_STOPWORDS,
    min_length: int = 3,
    min_count: int = 3,
) -> tuple[DataFrame, DataFrame]:
    """(tdm, vocab) of ``contents(doc_id, content)``; every row counts as a document."""
    n_docs = contents.count()
    counts = checkpoint(term_counts(contents, stopwords, min_length, min_count))
    vocab = vocabulary(counts, n_docs, vocab_size, idf)
    return term_weights(counts, vocab, vocab_size, tf), vocab

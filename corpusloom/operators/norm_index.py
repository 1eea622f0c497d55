"""Documents stored by the length of their factors, and an exact top search that reads the longest first.

A document's relevance is the product of its factors with the query's vector, so it is at most the
product of both lengths. Documents are stored in bands of like length, sorted inside. A search takes
bands from the longest on, a growing number of documents at a time, and ends when no band that is
left can hold a document as relevant as the last one found. The result is that of a full scan.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators.search import factor_products, most_relevant, sum_of_vectors

BANDS_PER_DOUBLING = 4  # lengths of a band differ by a factor of less than 1.19
EMPTY_BAND = -10_000  # documents of length 0
FIRST_DOCS, GROWTH = 10_000, 8
ROUNDING = 1e-9  # relative; sums of products are not exact


def write_norm_index(doc_factors: DataFrame, path: str) -> None:
    """Store (doc_id long, us) under ``path`` by length, and the number and greatest length of each band's documents.

    Documents without factors are left out; those whose factors are all 0 have the last band.
    """
    length = F.sqrt(F.aggregate("us", F.lit(0.0), lambda acc, x: acc + x * x))
    measured = doc_factors.select(F.col("doc_id").cast("long"), "us", length.alias("norm")).filter("norm IS NOT NULL")
    band = F.when(F.col("norm") > 0, F.floor(F.log2("norm") * BANDS_PER_DOUBLING)).otherwise(EMPTY_BAND)
    banded = measured.withColumn("band", band.cast("int"))
    # ranges of length: a band of many documents is cut into several files, none of which overlap
    ordered = banded.repartitionByRange(F.col("band").desc(), F.col("norm").desc(), F.col("doc_id"))
    ordered = ordered.sortWithinPartitions(F.col("band").desc(), F.col("norm").desc(), F.col("doc_id"))
    ordered.write.mode("overwrite").partitionBy("band").parquet(f"{path}/documents")
    stored = read_norm_index(doc_factors.sparkSession, path)
    counted = stored.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.max("norm").alias("longest"))
    counted.coalesce(1).write.mode("overwrite").parquet(f"{path}/bands")  # a few thousand rows at most


def read_norm_index(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, us, norm, band) of a stored index."""
    return spark.read.schema("doc_id long, us array<double>, norm double, band int").parquet(f"{path}/documents")


def steps(bands: list[tuple[int, int, float]], first: int, growth: int = GROWTH) -> list[tuple[int, int, float]]:
    """(greatest band, smallest band, longest) of each step through (band, n, longest), longest band first."""
    cut, held, wanted = [], 0, first
    for band, n, longest in sorted(bands, reverse=True):
        if held == 0:
            top, reach = band, longest
        held += n
        if held >= wanted:
            cut.append((top, band, reach))
            held, wanted = 0, wanted * growth
    if held:
        cut.append((top, band, reach))
    return cut


def best_documents(
    spark: SparkSession, path: str, term_factors: DataFrame, terms: DataFrame, count: int = 25, first: int | None = None
) -> DataFrame:
    """(doc_id, relevance): the ``count`` most relevant documents of a stored index, equal ones by id.

    Each step's best ``count`` rows pass the driver, nothing else of the documents. A query
    without a known word gives no row.
    """
    vector = sum_of_vectors(term_factors, terms).first()["q"] if count > 0 else None
    if vector is None:
        return spark.createDataFrame([], "doc_id long, relevance double")
    reach = math.sqrt(math.fsum(x * x for x in vector)) * (1 + ROUNDING)
    documents = read_norm_index(spark, path)
    bands = [tuple(r) for r in spark.read.parquet(f"{path}/bands").select("band", "n", "longest").collect()]
    asked = F.array(*[F.lit(float(x)) for x in vector])
    best: list[tuple[int, float]] = []
    for top, bottom, longest in steps(bands, max(count, first or FIRST_DOCS)):
        part = documents.filter(F.col("band").between(bottom, top))
        if len(best) == count:
            last = best[-1][1]
            if reach * longest < last:
                break
            if last > 0:
                part = part.filter(F.col("norm") >= last / reach)
        found = most_relevant(factor_products(part, asked), count).collect()
        best = sorted(best + [tuple(r) for r in found], key=lambda r: (-r[1], r[0]))[:count]
    return spark.createDataFrame(best, "doc_id long, relevance double")

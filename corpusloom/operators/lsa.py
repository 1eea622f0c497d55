"""Truncated singular value decomposition of the term-document matrix."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg.distributed import CoordinateMatrix, IndexedRowMatrix
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.ranking import with_position
from corpusloom.runtime import checkpoint

TASK_ROWS = 500_000  # rows of the matrix that one task of a pass goes through


def lsa(tdm: DataFrame, vocab: DataFrame, doc_ids: DataFrame, k: int = 300) -> tuple[DataFrame, DataFrame]:
    """(doc_factors(doc_id, us), term_factors(term_id, v)) of the best rank-k fit.

    Rows stay distributed throughout, and in memory or on the local disks while the values are found; only the vocabulary-by-k factor, whose size
    the vocabulary bounds, passes the driver. Row and column signs are arbitrary.
    """
    spark = tdm.sparkSession
    n_terms = vocab.count()
    rows = with_position(doc_ids.select("doc_id"), F.col("doc_id"), name="row")
    rows = checkpoint(rows)
    n_docs = rows.count()
    cells = tdm.join(rows, "doc_id").select("row", "term_id", F.col("weight"))
    entries = CoordinateMatrix(_entries(cells, n_docs, n_terms))
    by_row = entries.toIndexedRowMatrix()._java_matrix_wrapper._java_model
    sparse = checkpoint(callMLlibFunc("getIndexedRows", by_row))
    rank = min(k, n_terms, n_docs)
    # every one of some hundred passes is a job over all rows: they are read and decoded once, and dealt to few tasks
    few = sparse.coalesce(max(spark.sparkContext.defaultParallelism, n_docs // TASK_ROWS))
    matrix = _row_matrix(few, n_docs, n_terms)
    held = matrix._java_matrix_wrapper._java_model.rows()
    held.persist(spark.sparkContext._getJavaStorageLevel(StorageLevel.MEMORY_AND_DISK_DESER))
    svd = matrix.computeSVD(rank)
    held.unpersist(False)
    scaled = _row_matrix(sparse, n_docs, n_terms).multiply(svd.V)  # the matrix times V is U times the singular values
    us_rows = callMLlibFunc("getIndexedRows", scaled._java_matrix_wrapper._java_model)
    us = us_rows.select(F.col("index").alias("row"), vector_to_array("vector", "float64").alias("us"))
    zero = F.array_repeat(F.lit(0.0), len(svd.s))
    doc_factors = rows.join(us, "row", "left").select("doc_id", F.coalesce("us", zero).alias("us"))
    factor = svd.V.toArray()
    starts = np.arange(0, factor.size + 1, factor.shape[1], dtype=np.int32)
    columns = {"term_id": np.arange(len(factor)), "v": pa.ListArray.from_arrays(pa.array(starts), pa.array(factor.ravel()))}
    term_factors = spark.createDataFrame(pa.table(columns), "term_id long, v array<double>")
    return doc_factors, term_factors


def _row_matrix(rows: DataFrame, n_docs: int, n_terms: int) -> IndexedRowMatrix:
    return IndexedRowMatrix(callMLlibFunc("createIndexedRowMatrix", rows, n_docs, n_terms))


def _entries(cells: DataFrame, n_docs: int, n_terms: int):
    """A coordinate matrix made from the cell table inside the JVM."""
    named = cells.select(
        F.col("row").alias("i"), F.col("term_id").alias("j"), F.col("weight").alias("value")
    )
    return callMLlibFunc("createCoordinateMatrix", named, n_docs, n_terms)

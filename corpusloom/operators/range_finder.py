"""Truncated singular value decomposition by a randomised range finder, with no factor on the driver.

The matrix is stored in blocks of documents by terms. Random combinations of its columns span nearly
the space of the largest singular vectors; rounds of multiplying by the transpose and the matrix
bring them nearer. Dense factors stay in blocks of rows, and only triangles of rank by rank move: the
triangle of a tall factor comes from those of its blocks, merged in a tree. Driver and closures hold
numbers by the square of the rank, whatever the size of the corpus and the vocabulary.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.ranking import with_position
from corpusloom.runtime import arrow_rows, checkpoint, discard, scratch_path, shuffle_partitions

EXTRA = 20  # columns beyond the rank
POWERS = 2  # rounds with the transpose
DOCS, TERMS = 1024, 4096  # rows and columns of a block
FAN = 8  # parts of a sum or a triangle that one task merges
CELLS = 8192  # cells multiplied at once
BATCH_BYTES = 32 << 20  # of dense blocks that a worker is given at once
TINY = 1e-9  # of the largest singular value: smaller ones are zero
_BLOCK = "number long, data binary"
_PART = "number long, part long, data binary"


def randomised_lsa(
    tdm: DataFrame,
    vocab: DataFrame,
    doc_ids: DataFrame,
    k: int = 300,
    extra: int = EXTRA,
    powers: int = POWERS,
    docs: int = DOCS,
    terms: int = TERMS,
    fan: int = FAN,
) -> tuple[DataFrame, DataFrame]:
    """(doc_factors(doc_id, us), term_factors(term_id, v)) of nearly the best rank-k fit.

    Exact where the matrix has at most ``k + extra`` singular values that are not zero; otherwise the
    error falls with ``powers``, faster the steeper the spectrum. Every document and every term of the
    vocabulary has a row; there are as many factors as singular values up to ``k`` that are not zero.
    Row and column signs are arbitrary.
    """
    spark = tdm.sparkSession
    n_terms = vocab.count()
    rows = checkpoint(with_position(doc_ids.select("doc_id"), F.col("doc_id"), name="row"))
    n_docs = rows.count()
    width = min(k + extra, n_terms, n_docs)
    if not width:
        zero = F.array().cast("array<double>")
        return rows.select("doc_id", zero.alias("us")), vocab.select(F.col("term_id").cast("long"), zero.alias("v"))
    docs, terms = min(docs, n_docs), min(terms, n_terms)
    at_once = max(1, BATCH_BYTES // (8 * width * max(docs, terms)))
    pieces, path = _pieces(tdm.join(rows, "doc_id"), docs, terms)
    dense, old = _stored(_sampled(pieces, width, docs, terms), "range")
    turn = _turn(_triangle(dense, width, fan, at_once))
    for _ in range(powers):
        back, _ = _stored(_folded(_times_transpose(pieces, dense, turn, terms), fan, at_once), "range")
        turn = _turn(_triangle(back, turn.shape[1], fan, at_once))
        discard(spark, old)
        dense, old = _stored(_folded(_times(pieces, back, turn, docs), fan, at_once), "range")
        turn = _turn(_triangle(dense, turn.shape[1], fan, at_once))
    back, _ = _stored(_folded(_times_transpose(pieces, dense, turn, terms), fan, at_once), "range")
    discard(spark, path)
    # The matrix is nearly (dense turn) times the transpose of back, and back is orthonormal columns times its triangle.
    _, sizes, right = np.linalg.svd(_triangle(back, turn.shape[1], fan, at_once))
    kept = min(k, int((sizes > TINY * sizes[:1].sum()).sum()))
    right, sizes = right[:kept].T, sizes[:kept]
    us = _rows_of(dense, turn @ right * sizes, docs, "row", "us")
    v = _rows_of(back, right / sizes, terms, "term_id", "v")
    zeros = F.array_repeat(F.lit(0.0), kept)
    doc_factors = rows.join(us, "row", "left").select("doc_id", F.coalesce("us", zeros).alias("us"))
    all_terms = vocab.select(F.col("term_id").cast("long"))
    return doc_factors, all_terms.join(v, "term_id", "left").select("term_id", F.coalesce("v", zeros).alias("v"))


def _stored(rows: DataFrame, name: str) -> tuple[DataFrame, str]:
    path = scratch_path(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.parquet(path), path


def _pieces(cells: DataFrame, docs: int, terms: int) -> tuple[DataFrame, str]:
    """Stored rows (doc_block, term_block, cells) of the cells (row, term_id, weight), each cell by its place in the block."""
    cell = F.struct(
        (F.col("row") % docs).cast("int").alias("r"), (F.col("term_id") % terms).cast("int").alias("c"), F.col("weight").cast("double").alias("w")
    )
    block = [F.floor(F.col("row") / docs).alias("doc_block"), F.floor(F.col("term_id") / terms).alias("term_block")]
    return _stored(cells.select(*block, cell.alias("cell")).groupBy("doc_block", "term_block").agg(F.collect_list("cell").alias("cells")), "pieces")


def _product(cells: pa.ListScalar, right: np.ndarray, height: int, transposed: bool = False) -> np.ndarray:
    """A block of the matrix, or its transpose, times a dense block."""
    r, c, w = (part.to_numpy(zero_copy_only=False) for part in cells.values.flatten())
    if transposed:
        r, c = c, r
    out, order = np.zeros((height, right.shape[1])), np.argsort(r, kind="stable")
    for at in range(0, len(order), CELLS):
        part = order[at : at + CELLS]
        places, starts = np.unique(r[part], return_index=True)
        out[places] += np.add.reduceat(w[part, None] * right[c[part]], starts, axis=0)
    return out


def _matrix(value: pa.Scalar, width: int) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), np.float64).reshape(-1, width)


def _sampled(pieces: DataFrame, width: int, docs: int, terms: int) -> DataFrame:
    """Blocks of the matrix times normal random numbers, which every task makes from the number of a block of terms."""

    def sample(block: pa.Table) -> pa.Table:
        out = np.zeros((docs, width))
        for number, cells in zip(block.column("term_block").to_pylist(), block.column("cells")):
            out += _product(cells, np.random.default_rng([7, number]).standard_normal((terms, width)), docs)
        return pa.table({"number": block.column("doc_block")[:1], "data": pa.array([out.tobytes()], pa.binary())})

    return pieces.groupBy("doc_block").applyInArrow(sample, _BLOCK)


def _times_transpose(pieces: DataFrame, dense: DataFrame, turn: np.ndarray, terms: int) -> DataFrame:
    """Parts of the transposed matrix times (dense turn), summed within each task: a vocabulary by the rank at most."""
    shared = dense.sparkSession.sparkContext.broadcast(turn)  # rank by rank

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn, held = shared.value, {}
        for batch in batches:
            for number, cells, data in zip(batch.column("number").to_pylist(), batch.column("cells"), batch.column("data")):
                product = _product(cells, _matrix(data, turn.shape[0]) @ turn, terms, transposed=True)
                held[number] = held[number] + product if number in held else product
        part = TaskContext.get().partitionId()
        for number, data in held.items():
            yield pa.RecordBatch.from_pydict({"number": [number], "part": [part], "data": pa.array([data.tobytes()], pa.binary())})

    blocks = dense.withColumnRenamed("number", "doc_block")
    met = pieces.join(blocks.hint("merge"), "doc_block").select(F.col("term_block").alias("number"), "cells", "data")
    return met.mapInArrow(multiply, _PART)


def _times(pieces: DataFrame, back: DataFrame, turn: np.ndarray, docs: int) -> DataFrame:
    """Parts of the matrix times (back turn), one for each piece. A block of ``back`` goes to several tasks."""
    salts = shuffle_partitions(back.sparkSession)
    shared = back.sparkSession.sparkContext.broadcast(turn)  # rank by rank

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = shared.value
        for batch in batches:
            columns = (batch.column("number").to_pylist(), batch.column("part").to_pylist(), batch.column("cells"), batch.column("data"))
            for number, part, cells, data in zip(*columns):
                product = _product(cells, _matrix(data, turn.shape[0]) @ turn, docs)
                yield pa.RecordBatch.from_pydict({"number": [number], "part": [part], "data": pa.array([product.tobytes()], pa.binary())})

    many = back.select(F.col("number").alias("term_block"), "data", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    met = pieces.withColumn("salt", (F.col("doc_block") % salts).cast("int")).join(many.hint("merge"), ["term_block", "salt"])
    return met.select(F.col("doc_block").alias("number"), F.col("term_block").alias("part"), "cells", "data").mapInArrow(multiply, _PART)


def _folded(parts: DataFrame, fan: int, at_once: int, merge=sum) -> DataFrame:
    """Blocks (number, data): the parts of each merged in a tree; a task holds ``fan`` of them.

    The work that makes the parts is done here, on batches of ``at_once`` rows: a join may hold the same dense block many times.
    """

    def fold(block: pa.Table) -> pa.Table:
        merged = merge([np.frombuffer(d.as_buffer(), np.float64) for d in block.column("data")])
        return pa.table({"number": block.column("number")[:1], "part": block.column("part")[:1], "data": pa.array([merged.tobytes()], pa.binary())})

    with arrow_rows(parts.sparkSession, at_once):
        parts, _ = _stored(parts, "parts")
    left = (parts.agg(F.max("part")).first()[0] or 0) + 1
    while True:
        parts = parts.withColumn("part", F.floor(F.col("part") / fan)).groupBy("number", "part").applyInArrow(fold, _PART)
        left = -(-left // fan)
        if left <= 1:
            return parts.select("number", "data")


def _triangle(blocks: DataFrame, width: int, fan: int, at_once: int) -> np.ndarray:
    """The triangle of the tall factor that blocks of rows make: of each task's rows first, then merged in a tree."""

    def reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.empty((0, width))
        for batch in batches:
            for value in batch.column("data"):
                held = np.linalg.qr(np.vstack([held, _matrix(value, width)]), mode="r")
        if len(held):
            yield pa.RecordBatch.from_pydict({"number": [0], "part": [TaskContext.get().partitionId()], "data": pa.array([held.tobytes()], pa.binary())})

    def stack(triangles: list[np.ndarray]) -> np.ndarray:
        return np.linalg.qr(np.vstack([t.reshape(-1, width) for t in triangles]), mode="r")

    found = _folded(blocks.select("data").mapInArrow(reduced, _PART), fan, at_once, stack).collect()  # one triangle
    return np.frombuffer(found[0]["data"], np.float64).reshape(-1, width) if found else np.zeros((1, width))


def _turn(triangle: np.ndarray) -> np.ndarray:
    """What makes the columns of a factor of this triangle orthonormal, without those that are nearly zero."""
    _, sizes, right = np.linalg.svd(triangle)
    kept = max(int((sizes > TINY * sizes[0]).sum()), 1)
    return right[:kept].T / np.where(sizes[:kept] > 0, sizes[:kept], 1.0)


def _rows_of(blocks: DataFrame, turn: np.ndarray, height: int, name: str, value: str) -> DataFrame:
    """Rows (name long, value array<double>) of the blocks times ``turn``."""
    shared = blocks.sparkSession.sparkContext.broadcast(np.ascontiguousarray(turn))  # rank by rank

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = shared.value
        for batch in batches:
            for number, data in zip(batch.column("number").to_pylist(), batch.column("data")):
                out = _matrix(data, turn.shape[0]) @ turn
                starts = np.arange(0, out.size + 1, max(out.shape[1], 1), dtype=np.int32)[: len(out) + 1]
                lists = pa.ListArray.from_arrays(pa.array(starts), pa.array(out.ravel()))
                yield pa.RecordBatch.from_pydict({name: pa.array(number * height + np.arange(len(out))), value: lists})

    return blocks.mapInArrow(rows, f"{name} long, {value} array<double>")

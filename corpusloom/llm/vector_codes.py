"""Short codes for vectors: the nearest codebook entry of each part, found by LAESA pivots.

A part's distances to a few fixed pivots are computed once and stored beside it. In each
round the pivots' distances to the entries give lower bounds of all part-entry distances
(a difference of two sides of a triangle is at most the third). Entries are tried in the
order of their bounds with exact integer distances, until every bound left is beyond the best.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import free_name, join_lookup, with_fields
from corpusloom.runtime import checkpoint, scratch_path

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
PIVOTS = 4
LARGEST = 1 << 26  # of a scaled component: squares and their sums stay within long
_ROWS = 4096  # vectors worked on at once
_SLACK = 1e-6  # of stored distances, which are rounded to four bytes


def pick_pivots(entries: np.ndarray, count: int = PIVOTS) -> np.ndarray:
    """Entries far from each other, each the farthest from those before; the first one to begin with."""
    chosen = [0]
    far = ((entries - entries[0]) ** 2).sum(1)
    while len(chosen) < min(count, len(entries)):
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((entries - entries[chosen[-1]]) ** 2).sum(1))
    return entries[chosen]


def pivot_distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of each vector to each pivot, rounded to four bytes."""
    return np.sqrt(((vectors[:, None, :] - pivots[None]) ** 2).sum(2)).astype(np.float32)


def nearest_entries(vectors: np.ndarray, known: np.ndarray, entries: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Index and squared distance of each vector's nearest entry (ties to the lower index), and exact evaluations made."""
    to_entries = pivot_distances(entries, pivots)
    bound = np.zeros((len(vectors), len(entries)))
    for p in range(len(pivots)):
        a, b = known[:, p, None].astype(np.float64), to_entries[None, :, p].astype(np.float64)
        np.maximum(bound, np.abs(a - b) - _SLACK * (a + b), out=bound)
    rows = np.arange(len(vectors))
    best = np.full(len(vectors), np.iinfo(np.int64).max)
    index = np.zeros(len(vectors), np.int64)
    made = 0
    while len(rows):
        at = bound.argmin(1)
        line = np.arange(len(rows))
        low = bound[line, at]
        open_ = (low * low <= best[rows]) & np.isfinite(low)
        rows, bound, at = rows[open_], bound[open_], at[open_]
        exact = ((vectors[rows] - entries[at]) ** 2).sum(1)
        made += len(rows)
        better = (exact < best[rows]) | ((exact == best[rows]) & (at < index[rows]))
        best[rows[better]], index[rows[better]] = exact[better], at[better]
        bound[np.arange(len(rows)), at] = np.inf
    return index, best, made


def _usable(vector: Column) -> Column:
    wrong = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(wrong, F.lit(True))


def _scaled(flat: np.ndarray) -> np.ndarray:
    out = np.floor(flat.astype(np.float64) * SCALE)
    if out.size and np.abs(out).max() > LARGEST:
        raise ValueError(f"a component is larger than {LARGEST // SCALE}")
    return out.astype(np.int64)


def _prepared(kept: DataFrame, vector: str, box: str, pivots: list[np.ndarray], width: int) -> DataFrame:
    """Add the scaled components and the pivot distances of all parts, each as bytes, in one struct."""

    @F.arrow_udf("struct<parts: binary, known: binary>")
    def prepare(vectors: pa.Array) -> pa.Array:
        whole, known = [], []
        for start in range(0, len(vectors), _ROWS):
            some = vectors.slice(start, _ROWS)
            if (np.diff(some.offsets.to_numpy()) != width * PARTS).any():
                raise ValueError(f"vectors must all have {width * PARTS} components, as the first one")
            parts = _scaled(some.flatten().to_numpy(zero_copy_only=False)).reshape(len(some), PARTS, width)
            near = np.stack([pivot_distances(parts[:, p], pivots[p]) for p in range(PARTS)], 1)
            whole += [row.tobytes() for row in parts.astype(np.int32)]
            known += [row.tobytes() for row in near]
        return pa.StructArray.from_arrays([pa.array(whole, pa.binary()), pa.array(known, pa.binary())], ["parts", "known"])

    return kept.withColumn(box, prepare(F.col(vector))).drop(vector)


def _stacked(column: pa.Array, kind, *shape: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, *shape)


def _assign(parts: pa.Array, known: pa.Array, books: list[np.ndarray], pivots: list[np.ndarray], width: int):
    """Chunks of (scaled parts, entry index of each part, squared distance of each part)."""
    for start in range(0, len(parts), _ROWS):
        vectors = _stacked(parts.slice(start, _ROWS), np.int32, PARTS, width).astype(np.int64)
        near = _stacked(known.slice(start, _ROWS), np.float32, PARTS, len(pivots[0]))
        found = [nearest_entries(vectors[:, p], near[:, p], books[p], pivots[p]) for p in range(PARTS)]
        yield vectors, np.stack([f[0] for f in found], 1), np.stack([f[1] for f in found], 1)


def _improved(stored: DataFrame, box: str, books: list[np.ndarray], pivots: list[np.ndarray], width: int) -> list[np.ndarray]:
    """The codebooks after one round: floored means of the parts assigned to each entry.

    Tasks send sums per entry, at most one row for each component of a codebook; the driver
    gets the codebooks, whose size does not depend on the table.
    """

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(books[0])
        total, count = np.zeros((PARTS, size, width), np.int64), np.zeros((PARTS, size), np.int64)
        for batch in batches:
            for vectors, index, _ in _assign(batch.column(0), batch.column(1), books, pivots, width):
                for p in range(PARTS):
                    np.add.at(total[p], index[:, p], vectors[:, p])
                    count[p] += np.bincount(index[:, p], minlength=size)
        p, e = np.nonzero(count)
        place = np.tile(np.arange(width), len(p))
        p, e = np.repeat(p, width), np.repeat(e, width)
        columns = [p, e, place, total[p, e, place], count[p, e]]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["part", "entry", "place", "total", "n"])

    partial = stored.select(f"{box}.parts", f"{box}.known").mapInArrow(sums, "part long, entry long, place long, total long, n long")
    out = [book.copy() for book in books]
    for r in partial.groupBy("part", "entry", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect():
        out[r.part][r.entry, r.place] = r.total // r.n
    return out


def codebooks_digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all entries' components by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(str(x) for book in books for x in book.ravel().tolist()).encode()).hexdigest()


def compress_vectors(vectors: DataFrame, vector: str = "embedding", key: str = "vec_id", label: str = "label") -> DataFrame:
    """Replace ``vector`` by ``code``, ``error``, ``label_error`` and ``codebooks_sha256``.

    Rows whose vector is null, or holds null, NaN or infinite components, are dropped.
    Components become floor(256 x); vectors are cut into 16 equal parts. The codebook of
    a part starts as that part of the 64 rows of smallest key (null keys last; rows of one key by
    their vectors), or of all rows where there are fewer, and is improved in two rounds.
    ``code`` has two hex digits a part; ``error`` is the sum of the squared distances;
    ``label_error`` sums it over the rows of one label, nulls together. Repeated rows each get
    their code. All kept vectors need one length, a multiple of 16, and components
    within 2^18; others raise ValueError. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    kept = vectors.filter(_usable(F.col(vector)))
    first = kept.select(key, vector).orderBy(F.col(key).asc_nulls_last(), vector).limit(ENTRIES).collect()
    size = len(first[0][1]) if first else PARTS
    if size % PARTS or any(len(r[1]) != size for r in first):
        raise ValueError("vectors must have one length, a multiple of 16")
    width = size // PARTS
    start = _scaled(np.array([r[1] for r in first], np.float64).reshape(len(first), size)).reshape(-1, PARTS, width)
    books = [start[:, p].copy() for p in range(PARTS)]
    box = free_name(vectors, "vector_parts")
    pivots = [pick_pivots(book) if len(book) else np.zeros((1, width), np.int64) for book in books]
    path = scratch_path(spark, "vector-parts")
    _prepared(kept, vector, box, pivots, width).write.parquet(path)
    stored = spark.read.parquet(path)
    for _ in range(ROUNDS if first else 0):
        books = _improved(stored, box, books, pivots, width)

    @F.arrow_udf("struct<code: string, error: long>")
    def coded(parts: pa.Array, known: pa.Array) -> pa.Array:
        codes, errors = [], []
        for _, index, distance in _assign(parts, known, books, pivots, width):
            codes += [row.tobytes().hex() for row in index.astype(np.uint8)]
            errors.append(distance.sum(1))
        return pa.StructArray.from_arrays([pa.array(codes, pa.string()), pa.array(np.concatenate(errors or [np.empty(0, np.int64)]))], ["code", "error"])

    path = scratch_path(spark, "vector-codes")
    with_fields(stored, coded(F.col(f"{box}.parts"), F.col(f"{box}.known")), "code", "error").drop(box).write.parquet(path)
    done = spark.read.parquet(path)
    totals = checkpoint(done.groupBy(label).agg(F.sum("error").alias("label_error")))
    joined = join_lookup(done.drop("label_error"), totals, label)
    return joined.withColumn("codebooks_sha256", F.lit(codebooks_digest(books)))

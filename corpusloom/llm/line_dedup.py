"""Drop lines that a document of smaller id holds too.

Two Bloom filters are filled from the hashes of all line keys: a bit of the first is set by
one document, a bit of the second by a second one. Keys that miss the second filter occur in
one document only and stay where they are; the others, the suspects, are shuffled by their
whole text for exact confirmation and the choice of the document that keeps them.

The filters are built in parts: each task sends the sorted places it sets, each segment of
bits is put together by one task, and only the second filter reaches the driver. Keys are taken
in slices of the hash range, so that one pair of filters has a fixed size however many keys
there are; the keys are stored in the order of their hash, so a slice reads its own row groups.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import SPACES, free_name
from corpusloom.llm.shingles import mix
from corpusloom.runtime import HOT_KEY_ROWS, checkpoint, discard, salt_lookup, salt_rows, scratch_path, shuffle_partitions, sized_broadcast

MIN_CHARS = 10
SEGMENT_BITS = 20  # bits of a segment, as a power of two: 128 KB
KEYS_PER_SEGMENT = (1 << SEGMENT_BITS) // 12
SLICE_SEGMENTS = 256  # segments of one filter: 32 MB, about 22 million keys
PLACES = 3  # bits of one key
_U = np.uint64
_SPACES = SPACES.encode()
_SIGN = _U(1 << 63)


def line_key(line: bytes) -> bytes:
    """A line without white space at its ends, A-Z lower-cased."""
    return line.strip(_SPACES).lower()


def _long_enough(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode()) >= min_chars)


def _line_keys(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, hash, key): the distinct keys of each row's lines."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, found = [], []
            for i, text in enumerate(batch.column(1)):
                mine = {line_key(line) for line in (text.as_py() or b"").split(b"\n")}
                mine = [k for k in mine if _long_enough(k, min_chars)]
                at.extend([i] * len(mine))
                found.extend(mine)
            hashes = pa.array(np.fromiter(map(xxhash.xxh3_64_intdigest, found), _U, len(found)).view(np.int64))
            texts = pa.array(found, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), hashes, texts], ["doc_id", "hash", "key"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(keys, f"doc_id {kind}, hash long, key string")


def bit_places(hashes: np.ndarray, segments: int) -> np.ndarray:
    """The bits of each key, PLACES in a row: a segment number and a place within it."""
    with np.errstate(over="ignore"):
        segment = mix(hashes) % _U(segments)
        spread = [mix(hashes + _U(0x9E3779B97F4A7C15) * _U(n + 1)) >> _U(64 - SEGMENT_BITS) for n in range(PLACES)]
        return np.stack([(segment << _U(SEGMENT_BITS)) | s for s in spread], 1)


def _set_bits(bits: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The same bit map with bits set; places are distinct."""
    np.bitwise_or.at(bits, places >> 3, np.uint8(1) << (places & 7).astype(np.uint8))
    return bits


def _twice_filter(hashes: DataFrame, segments: int) -> Broadcast:
    """The second filter over one slice of keys, broadcast: 128 KB a segment, all zero where unset."""
    tasks = min(segments, shuffle_partitions(hashes.sparkSession))

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = bit_places(batch.column(0).to_numpy().view(_U), segments).ravel()
            found, times = np.unique(places, return_counts=True)
            owner = (found >> _U(SEGMENT_BITS)).astype(np.int64)
            inner = (found & _U((1 << SEGMENT_BITS) - 1)).astype(np.int32)
            cut = np.flatnonzero(np.diff(owner)) + 1
            names = owner[np.concatenate(([0], cut))] if len(owner) else owner
            ones = [p.tobytes() for p in np.split(inner, cut)][: len(names)]
            twos = [p[t > 1].tobytes() for p, t in zip(np.split(inner, cut), np.split(times, cut))][: len(names)]
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(ones, pa.binary()), pa.array(twos, pa.binary())], ["segment", "once", "twice"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, once, twice = None, None, None

        def done():
            return pa.RecordBatch.from_arrays([pa.array([name], pa.int64()), pa.array([twice.tobytes()], pa.binary())], ["segment", "bits"])

        for batch in batches:
            for segment, ones, twos in zip(*(c.to_pylist() for c in batch.columns)):
                if segment != name:
                    if name is not None:
                        yield done()
                    name, once, twice = segment, *(np.zeros(1 << (SEGMENT_BITS - 3), np.uint8) for _ in "ab")
                mine = _set_bits(np.zeros_like(once), np.frombuffer(ones, np.int32))
                _set_bits(twice, np.frombuffer(twos, np.int32))
                twice |= once & mine
                once |= mine
        if name is not None:
            yield done()

    parts = hashes.mapInArrow(partial, "segment long, once binary, twice binary")
    met = parts.repartition(tasks, "segment").sortWithinPartitions("segment")
    bits = np.zeros((segments, 1 << (SEGMENT_BITS - 3)), np.uint8)
    for row in met.mapInArrow(merge, "segment long, bits binary").collect():  # 32 MB at most
        bits[row.segment] = np.frombuffer(row.bits, np.uint8)
    return hashes.sparkSession.sparkContext.broadcast(bits)


def _seen_twice(key_hash: Column, filters: Broadcast) -> Column:
    @F.arrow_udf("boolean")
    def hit(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bits = filters.value
        flat = bits.reshape(-1)
        for batch in batches:
            places = bit_places(batch.to_numpy(zero_copy_only=False).view(_U), len(bits)).astype(np.int64)
            yield pa.array(((flat[places >> 3] >> (places & 7).astype(np.uint8)) & 1).all(1))

    return hit(key_hash)


def _suspects(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, key) of all keys that two documents may hold, stored."""
    spark = docs.sparkSession
    stored = scratch_path(spark, "line-keys")
    _line_keys(docs, min_chars).sortWithinPartitions("hash").write.parquet(stored)
    keys = spark.read.parquet(stored)
    count = keys.count()
    slices = max(1, -(-count // (KEYS_PER_SEGMENT * SLICE_SEGMENTS)))
    segments = max(1, min(SLICE_SEGMENTS, -(-count // KEYS_PER_SEGMENT)))
    bounds = [-(1 << 63) + (1 << 64) * n // slices for n in range(slices)] + [None]
    out = scratch_path(spark, "line-suspects")
    for low, high in zip(bounds, bounds[1:]):
        mine = keys.filter(F.col("hash") >= low) if high is None else keys.filter((F.col("hash") >= low) & (F.col("hash") < high))
        filters = _twice_filter(mine.select("hash"), segments)
        mine.filter(_seen_twice(F.col("hash"), filters)).select("doc_id", "key").write.mode("append").parquet(out)
        filters.destroy()
    discard(spark, stored)
    return spark.read.parquet(out)


def _lost_keys(docs: DataFrame, min_chars: int, hot_rows: int) -> DataFrame:
    """(doc_id, lost): the keys whose lines each document loses."""
    suspects = _suspects(docs, min_chars)
    unnamed = F.count_if(F.col("doc_id").isNull())
    held = suspects.groupBy("key").agg(
        F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), unnamed.alias("unnamed"), F.count(F.lit(1)).alias("rows")
    )
    repeated = checkpoint(held.filter("first < last OR (first IS NOT NULL AND unnamed > 0)").select("key", "first", "rows"))
    firsts = repeated.select("key", "first")
    hot = checkpoint(repeated.filter(F.col("rows") > hot_rows).select("key", F.ceil(F.col("rows") / hot_rows).alias("_salts")))
    if hot.isEmpty():
        met = suspects.join(firsts, "key")
    else:
        hot = sized_broadcast(hot)
        met = salt_rows(suspects, "key", hot).join(salt_lookup(firsts, "key", hot), ["key", "_salt"])
    later = met.filter("doc_id > first OR doc_id IS NULL").select("doc_id", "key")
    return later.groupBy("doc_id").agg(F.collect_set("key").alias("lost"))


def _cut(docs: DataFrame, min_chars: int, hot_rows: int, box: str) -> DataFrame:
    """Add a struct: lines, lines dropped, and the text of the others."""
    spare = free_name(docs, "lost_keys")
    other = free_name(docs, "lost_doc")
    lost = _lost_keys(docs.select("doc_id", "text"), min_chars, hot_rows).select(F.col("doc_id").alias(other), F.col("lost").alias(spare))

    @F.arrow_udf("struct<n_lines: long, n_dropped: long, kept: string>")
    def cut(texts: pa.Array, keys: pa.Array) -> pa.Array:
        lines_of, dropped, kept = [], [], []
        for text, gone in zip(texts, keys):
            lines = (text.as_py() or b"").split(b"\n")
            gone = {k.encode() for k in gone.as_py() or ()}
            left = [line for line in lines if line_key(line) not in gone] if gone else lines
            lines_of.append(len(lines))
            dropped.append(len(lines) - len(left))
            kept.append(b"\n".join(left))
        fields = [pa.array(lines_of, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())]
        return pa.StructArray.from_arrays(fields, ["n_lines", "n_dropped", "kept"])

    met = docs.join(lost, docs["doc_id"].eqNullSafe(lost[other]), "left")
    return met.withColumn(box, cut(F.col("text").cast("binary"), F.col(spare))).drop(spare, other)


def without_repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, hot_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """Add ``n_lines``, ``n_dropped`` and ``kept``, the text without its dropped lines.

    A line's key is the line without the white space \\x20 and \\x09-\\x0D at its ends, A-Z
    lower-cased. A key of at least ``min_chars`` code points that two documents hold loses
    all its lines but those of the smallest ``doc_id``; that document keeps every one of them.
    Lines end at \\n only. A null or empty text is one empty line, kept. Rows of one id are one
    document: they lose a key together, or not at all. Rows without an id are one document
    behind all others. Other columns stay as they are; an empty table gives an empty result.
    """
    box = free_name(docs, "cut_lines")
    found = _cut(docs, min_chars, hot_rows, box)
    return found.withColumns({f: F.col(f"{box}.{f}") for f in ("n_lines", "n_dropped", "kept")}).drop(box)


def drop_repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, hot_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """The rows and columns of ``docs``, each text without its dropped lines; rules as above."""
    box = free_name(docs, "cut_lines")
    return _cut(docs, min_chars, hot_rows, box).withColumn("text", F.col(f"{box}.kept")).drop(box)

"""Remove byte strings that also occur earlier in the corpus.

Equal windows of 100 bytes have the same smallest hash among their 32-byte strings, the
anchor. Each text is cut into runs of windows with one anchor; a run can repeat elsewhere
only if its anchor does. Runs of repeated anchors meet by anchor. Equal runs are settled by
their order alone; where an anchor has several distinct ones, each task builds a Burrows-Wheeler transform of
a bounded batch and expands its intervals backward, breadth first, up to 100 bytes: what
still shares a prefix then are the repeated windows. Anchors of very many runs give up
their windows one by one to a shuffle instead, so that no group must fit in a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.bwt import later_windows
from corpusloom.llm.common import free_name, join_lookup, make_room
from corpusloom.llm.shingles import _BYTE, mix
from corpusloom.operators.ranking import with_position
from corpusloom.runtime import checkpoint, scratch_path

LENGTH = 100
ANCHOR = 32
MOST_WINDOWS = 256  # windows of one run; longer runs are cut
BATCH_BYTES = 1 << 20  # of distinct runs in one transform
HOT_RUNS = 20_000  # runs of one anchor that are compared window by window, by a shuffle
_U = np.uint64
_LAST = (1 << 63) - 1
# A place packs a start, whether windows of the run may repeat within it, and a window count.
_START_BIT, _SELF_BIT = 10, 9
_COUNT = (1 << _SELF_BIT) - 1


def _sliding(values: np.ndarray, size: int, pick) -> np.ndarray:
    """The smallest or largest of each ``size`` neighbours, in log2(size) passes."""
    span = 1
    while span * 2 <= size:
        values = pick(values[:-span], values[span:])
        span *= 2
    return pick(values[: len(values) - (size - span)], values[size - span :]) if size > span else values


def runs(data: bytes, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, start, number of windows, and whether the anchor occurs twice, of each run of a text."""
    if len(data) < length:
        return (np.empty(0, _U), *(np.empty(0, np.int64),) * 2, np.empty(0, bool))
    h = _BYTE[np.frombuffer(data, np.uint8)]
    span = 1
    while span < ANCHOR:
        h = h[:-span] * _U(2 * span + 0x9E3779B97F4A7C15 % (1 << 63)) + (h[span:] ^ (h[span:] >> _U(29)))
        span *= 2
    h = mix(h)
    places = length - ANCHOR + 1  # of an anchor in a window
    least = _sliding(h, places, np.minimum)
    start = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
    count = np.diff(np.append(start, len(least)))
    # An anchor twice within one window: two smallest places next to each other.
    padded = np.concatenate((np.zeros(places - 1, _U), least, np.zeros(places - 1, _U)))
    chosen = np.flatnonzero(_sliding(padded, places, np.maximum) == h)
    twice = chosen[:-1][(h[chosen[:-1]] == h[chosen[1:]]) & (np.diff(chosen) < places)]
    double = count > places
    double[np.searchsorted(start, np.minimum(twice, len(least) - 1), side="right") - 1] = True
    if count.max() > MOST_WINDOWS:
        parts = -(-count // MOST_WINDOWS)
        nth = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
        whole_start, whole_count = np.repeat(start, parts), np.repeat(count, parts)
        double = np.repeat(double | (parts > 1), parts)
        start = whole_start + nth * MOST_WINDOWS
        count = np.minimum(whole_count - nth * MOST_WINDOWS, MOST_WINDOWS)
    return least[start], start, count, double


def text_runs(text: Column, length: int) -> Column:
    """Array of structs ``anchor``, ``place``, ``double`` of a text's runs."""
    kind = [pa.field("anchor", pa.int64()), pa.field("place", pa.int64()), pa.field("double", pa.bool_())]

    @F.arrow_udf("array<struct<anchor:long,place:long,double:boolean>>")
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        make_room()
        for batch in batches:
            offsets, anchors, places, doubles = [0], [], [], []
            for value in batch:
                data = (value.as_py() or "").encode()
                anchor, start, count, double = runs(data, length)
                anchors.append(anchor.astype(np.int64))
                places.append(start << _START_BIT | double.astype(np.int64) << _SELF_BIT | count)
                doubles.append(double)
                offsets.append(offsets[-1] + len(anchor))
            columns = [np.concatenate(x) if x else np.empty(0) for x in (anchors, places, doubles)]
            items = pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kind)], fields=kind)
            yield pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), items)

    return found(text)


def _place(value: int) -> tuple[int, int]:
    return value >> _START_BIT, value & _COUNT


def run_pieces(text: Column, wanted: Column, length: int) -> Column:
    """The bytes of wanted runs (structs anchor, place, hot) of a text; a hot run gives each window, as a digest."""

    @F.arrow_udf("array<struct<anchor:long,place:long,hot:boolean,piece:binary>>")
    def cut(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        kind = pa.list_(
            pa.struct([("anchor", pa.int64()), ("place", pa.int64()), ("hot", pa.bool_()), ("piece", pa.binary())])
        )
        for texts, lists in batches:
            out = []
            for value, items in zip(texts, lists):
                data, rows = (value.as_py() or "").encode(), []
                for item in items.as_py() or []:
                    start, count = _place(item["place"])
                    if item["hot"]:
                        for at in range(start, start + count):
                            digest = hashlib.blake2b(data[at : at + length], digest_size=16).digest()
                            rows.append((item["anchor"], at << _START_BIT | 1, True, digest))
                    else:
                        rows.append((item["anchor"], item["place"], False, data[start : start + count + length - 1]))
                out.append([dict(zip(("anchor", "place", "hot", "piece"), r)) for r in rows])
            yield pa.array(out, kind)

    return cut(text, wanted)


def _spans(owner: np.ndarray, place: np.ndarray, count: np.ndarray) -> pa.RecordBatch:
    """Rows of the result: document, and place with the number of windows."""
    return pa.record_batch({"doc": pa.array(owner, pa.int64()), "place": pa.array(place + count, pa.int64())})


def repeated_in_batches(length: int):
    """For sorted runs (anchor, piece, doc, place): those that repeat, as doc and place."""

    def flush(pieces, owner, place):
        if not pieces:
            return
        owners, windows = later_windows(pieces, np.array(owner, np.int64), np.array(place, np.int64) >> _START_BIT, length)
        if len(owners):
            order = np.lexsort((windows, owners))
            owners, windows = owners[order], windows[order]
            first = np.concatenate(([True], (owners[1:] != owners[:-1]) | (windows[1:] != windows[:-1] + 1)))
            starts = np.flatnonzero(first)
            sizes = np.diff(np.append(starts, len(owners)))
            parts = -(-sizes // MOST_WINDOWS)  # a place holds so many windows at most
            nth = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
            begin = windows[np.repeat(starts, parts)] + nth * MOST_WINDOWS
            count = np.minimum(np.repeat(sizes, parts) - nth * MOST_WINDOWS, MOST_WINDOWS)
            yield _spans(owners[np.repeat(starts, parts)], begin << _START_BIT, count)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, owner, place = [], [], []
        begin, held = 0, 0  # where the runs of this anchor begin, and the bytes of all
        last, first = (None, None), (None, None)

        def end_group() -> None:
            # the only run of an anchor has no windows in common with others
            if len(pieces) == begin + 1 and not place[begin] >> _SELF_BIT & 1:
                for column in (pieces, owner, place):
                    column.pop()

        for batch in source:
            copies_owner, copies_place = [], []
            columns = [batch.column(c).to_pylist() for c in ("anchor", "piece", "doc", "place")]
            for anchor, piece, doc, at in zip(*columns):
                if (anchor, piece) == last:  # equal to an earlier run: all its windows repeat
                    if (doc, at) != first:  # else the row repeats
                        copies_owner.append(doc)
                        copies_place.append(at)
                    continue
                if anchor != last[0]:
                    end_group()
                    held += sum(map(len, pieces[begin:]))
                    if held >= BATCH_BYTES:
                        yield from flush(pieces, owner, place)
                        held = 0
                        for column in (pieces, owner, place):
                            column.clear()
                    begin = len(pieces)
                last, first = (anchor, piece), (doc, at)
                pieces.append(piece)
                owner.append(doc)
                place.append(at)
            if copies_owner:
                yield _spans(np.array(copies_owner), np.array(copies_place), np.zeros(len(copies_owner), np.int64))
        end_group()
        yield from flush(pieces, owner, place)
        make_room()

    return batches


def repeated_spans(docs: DataFrame, length: int = LENGTH, hot_runs: int = HOT_RUNS) -> DataFrame:
    """Rows (doc, place): runs of windows of documents (doc, text) that start earlier, too."""
    spark = docs.sparkSession
    found = docs.select("doc", F.explode(text_runs(F.col("text"), length)).alias("r")).select("doc", "r.*")
    by_anchor = Window.partitionBy("anchor").orderBy("doc", "place")
    company = F.lag("doc").over(by_anchor).isNotNull() | F.lead("doc").over(by_anchor).isNotNull()
    path = scratch_path(spark, "runs")
    found.withColumn("double", F.col("double") | company).filter("double").select("anchor", "doc", "place").write.parquet(path)
    stored = spark.read.parquet(path)
    hot = checkpoint(stored.groupBy("anchor").agg(F.count("*").alias("n")).filter(F.col("n") > hot_runs).select("anchor", F.lit(True).alias("hot")))
    marked = join_lookup(stored, hot, "anchor").withColumn("hot", F.coalesce("hot", F.lit(False)))
    wanted = marked.groupBy("doc").agg(F.collect_list(F.struct("anchor", "place", "hot")).alias("wanted"))
    pieces = docs.join(wanted, "doc").select("doc", F.explode(run_pieces(F.col("text"), F.col("wanted"), length)).alias("p"))
    pieces = pieces.select("doc", "p.*")
    cold = pieces.filter(~F.col("hot")).select("anchor", "piece", "doc", "place")
    cold = cold.repartition("anchor").sortWithinPartitions("anchor", "piece", "doc", "place")
    spans = cold.mapInArrow(repeated_in_batches(length), "doc long, place long")
    if hot.take(1):
        same = Window.partitionBy("piece").orderBy("doc", "place")
        windows = pieces.filter("hot").select("piece", "doc", "place").withColumn("nth", F.rank().over(same))
        spans = spans.unionByName(windows.filter("nth > 1").select("doc", "place"))
    return spans


def remove_spans(text: Column, places: Column, length: int, as_text: bool = False) -> Column:
    """Struct of ``n_bytes, n_removed, n_spans`` and ``kept`` of a text without its repeated runs.

    ``kept`` are bytes; as text, the bytes of characters that a removal has split are left out.
    """
    kept_type = "string" if as_text else "binary"

    @F.arrow_udf(f"n_bytes long, n_removed long, n_spans long, kept {kept_type}")
    def removed(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        kind = pa.struct([("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", getattr(pa, kept_type)())])
        for texts, lists in batches:
            out = []
            for value, items in zip(texts, lists):
                data = (value.as_py() or "").encode()
                items = items.as_py()
                if not items:
                    out.append((len(data), 0, 0, data.decode() if as_text else data))
                    continue
                packed = np.sort(np.array(items, np.int64))
                start = packed >> _START_BIT
                gone = np.zeros(len(data) + 1, np.int32)
                np.add.at(gone, start, 1)
                np.add.at(gone, start + (packed & _COUNT) + length - 1, -1)
                gone = np.cumsum(gone)[:-1] > 0
                n_spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
                kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
                out.append((len(data), int(gone.sum()), n_spans, kept.decode(errors="ignore") if as_text else kept))
            columns = list(zip(*out)) or [(), (), (), ()]
            yield pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kind)], fields=list(kind))

    return removed(text, places)


def _ids_with_several_texts(docs: DataFrame, number: Column, text: str) -> bool:
    pairs = docs.select(number.alias("doc"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("h"))
    return not pairs.groupBy("doc").agg(F.min("h").alias("low"), F.max("h").alias("high")).filter("low <> high").isEmpty()


def _numbered(docs: DataFrame, number: Column, text: str, key: str) -> DataFrame:
    """Add a number of its own to each distinct pair of id and text, in the order of ids, by a distributed sort."""
    wide, digest = free_name(docs, "doc_number"), free_name(docs, "text_digest")
    named = docs.withColumns({wide: number, digest: F.md5(F.coalesce(F.col(text), F.lit("")))})
    pairs = named.select(F.col(wide).alias("n"), F.col(digest).alias("d")).distinct()
    ranks = with_position(pairs, F.col("n"), F.col("d"), name=key)
    return named.join(ranks, (named[wide] == ranks["n"]) & (named[digest] == ranks["d"])).drop("n", "d", wide, digest)


def without_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, as_text: bool = False
) -> DataFrame:
    """Add ``n_bytes, n_removed, n_spans`` and ``kept`` (bytes, or text) to every row.

    Every byte covered by a string of ``length`` bytes that also starts earlier (smaller
    id, or earlier in the same text) is removed; strings are judged on the input and never
    cross texts. Null texts are empty. A row without id comes last
    (as does an id of 2^63 - 1). Rows of one id and text
    are one document and get the same result; different texts of one id are documents of their
    own, in the order of their digests. Windows of hot anchors are compared by 128-bit digests, all others by their
    bytes.
    """
    key, places, box = (free_name(docs, n) for n in ("doc_key", "repeated_places", "removed_box"))
    number = F.coalesce(F.col(doc_id).cast("long"), F.lit(_LAST))
    plain = not _ids_with_several_texts(docs, number, text)
    numbered = docs.withColumn(key, number) if plain else _numbered(docs, number, text, key)
    texts = docs.select(number.alias("doc"), F.col(text).alias("text")) if plain else numbered.select(F.col(key).alias("doc"), F.col(text).alias("text"))
    found = repeated_spans(texts, length).groupBy("doc").agg(F.collect_list("place").alias(places)).withColumnRenamed("doc", key)
    if plain and sorted(docs.columns) == sorted((doc_id, text)):  # then the texts are shuffled once for both joins
        back = F.when(F.col("doc") != _LAST, F.col("doc")).cast(docs.schema[doc_id].dataType)
        joined = texts.join(found.withColumnRenamed(key, "doc"), "doc", "left").select(
            back.alias(doc_id), F.col("text").alias(text), places, F.lit(None).alias(key)
        )
    else:
        joined = numbered.join(found, key, "left")
    boxed = joined.withColumn(box, remove_spans(F.col(text), F.col(places), length, as_text))
    fields = {f: F.col(f"{box}.{f}") for f in ("n_bytes", "n_removed", "n_spans", "kept")}
    return boxed.withColumns(fields).drop(key, places, box)


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """``docs`` with repeated strings removed from the texts; bytes of split characters go too."""
    cleaned = without_repeats(docs, doc_id, text, length, as_text=True)
    return cleaned.withColumn(text, F.when(F.col("n_removed") == 0, F.col(text)).otherwise(F.col("kept"))).select(*docs.columns)

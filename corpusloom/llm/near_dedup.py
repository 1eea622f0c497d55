"""Near-duplicate documents by HyperMinHash.

One hash per shingle picks a bucket; a bucket keeps the smallest rest as a register of
16 bits: how many leading zeros it has, and ten bits behind them. Registers are banded:
documents that agree in a band are candidates. Their likeness is estimated from equal
registers, corrected for registers that are equal by accident, and a pair whose estimate
does not rule it out is verified on the full shingle sets.

At a likeness of 0.8 a pair misses all 32 bands of 4 registers with a chance of 5e-8,
and the estimate rules it out (by five standard deviations) with one of 3e-7. Copies with
equal words are grouped before, by digest. Inside a band bucket no set of all pairs is
made: members meet one centre, then, as far as they are not yet connected, other
centres, and at last the few outside a bucket's largest component are compared with the
bucket in blocks, which give links only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import BROADCAST_ROWS
from corpusloom.llm.components import components
from corpusloom.llm.shingles import lower_words, mix, shingle_set, word_hashes
from corpusloom.runtime import checkpoint

REGISTERS, BANDS = 128, 32
MANTISSA = 10  # bits of a register behind its leading zeros
PERCENT = 80
ROUNDS = 2  # of centres, before the remaining members are compared in blocks
BLOCK = 400  # documents of each side of a block
_U = np.uint64
_BUCKET_BITS = REGISTERS.bit_length() - 1
_REST_BITS = 64 - _BUCKET_BITS
_PROBES = (mix(np.arange(REGISTERS * 256, dtype=_U) + _U(99)) % _U(REGISTERS)).astype(np.int64).reshape(256, REGISTERS)
SIGMAS = 5.0


def registers(shingles: np.ndarray) -> np.ndarray:
    """Compressed registers of a sorted shingle set that is not empty.

    Buckets that no shingle falls in copy others, in an order fixed for each bucket, so
    that small sets do not agree by what they lack.
    """
    bucket = (shingles >> _U(_REST_BITS)).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
    rest = shingles[first] & _U((1 << _REST_BITS) - 1)
    # floats keep 53 bits: enough for the exponent and ten bits behind it
    fraction, exponent = np.frexp(np.maximum(rest, _U(1)).astype(np.float64))
    zeros = _REST_BITS - exponent
    behind = np.floor((fraction * 2 - 1) * (1 << MANTISSA)).astype(np.int64)
    found = np.full(REGISTERS, -1, np.int64)
    found[bucket[first]] = zeros * (1 << MANTISSA) + behind
    empty = np.flatnonzero(found < 0)
    filled = found.copy()
    for probe in _PROBES:
        if not len(empty):
            break
        filled[empty] = found[probe[empty]]
        empty = empty[filled[empty] < 0]
    filled[empty] = found[bucket[first][0]]
    return filled.astype(np.uint16)


def accidental(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """The chance that registers of two sets of n and m shingles are equal though their minima differ.

    A minimum of n shingles over the buckets is nearly exponential. In the interval of
    equally many leading zeros all register values have one width, so the chance is that
    width times the integral of both densities, summed over the intervals.
    """
    a, b = np.maximum(n / REGISTERS, 1.0)[:, None], np.maximum(m / REGISTERS, 1.0)[:, None]
    low = 0.5 ** np.arange(1, 41)[None, :]
    inside = np.exp(-(a + b) * low) - np.exp(-(a + b) * 2 * low)
    return (a * b / (a + b) * inside * low / (1 << MANTISSA)).sum(axis=1)


def estimate(left: np.ndarray, right: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Jaccard estimates from rows of registers."""
    equal = (left == right).mean(axis=1)
    chance = accidental(n, m)
    return np.clip((equal - chance) / (1 - chance), 0, 1)


def _stacked(batch: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(batch.to_pylist()), np.uint16).reshape(len(batch), REGISTERS)


def sketches(text: Column, words: int) -> Column:
    """Struct of ``copy`` (digest of the word sequence), ``n`` (size of the set), ``registers``; null registers without words."""

    @F.arrow_udf("copy binary, n long, registers binary")
    def sketch(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = [pa.field("copy", pa.binary()), pa.field("n", pa.int64()), pa.field("registers", pa.binary())]
        for batch in batches:
            rows = []
            for value in batch:
                joined = b" ".join(lower_words(value.as_py() or ""))
                shingles = shingle_set(word_hashes(joined), words)
                digest = hashlib.blake2b(joined, digest_size=16).digest()
                rows.append((digest, len(shingles), registers(shingles).tobytes() if len(shingles) else None))
            columns = list(zip(*rows)) or [(), (), ()]
            yield pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kind)], fields=kind)

    return sketch(text)


def band_keys(stored: Column) -> Column:
    """One 64-bit key for each band of registers."""

    @F.arrow_udf("array<long>")
    def keys_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            bands = _stacked(batch).reshape(len(batch), BANDS, REGISTERS // BANDS).astype(_U)
            keys = np.broadcast_to(np.arange(BANDS, dtype=_U), bands.shape[:2])
            for k in range(REGISTERS // BANDS):
                keys = mix(keys * _U(0x5851F42D4C957F2D) + bands[:, :, k] + _U(k + 1))
            offsets = np.arange(0, keys.size + 1, BANDS, dtype=np.int32)
            yield pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.astype(np.int64).ravel()))

    return keys_of(stored)


def possible(percent: int) -> Column:
    """Whether the estimate leaves a pair (left, right, n, m) a chance to be linked."""

    @F.arrow_udf("boolean")
    def passes(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        level = percent / 100
        for left, right, n, m in batches:
            n, m = n.to_numpy(zero_copy_only=False).astype(float), m.to_numpy(zero_copy_only=False).astype(float)
            if not len(n):
                yield pa.array([], pa.bool_())
                continue
            deviation = np.sqrt(level * (1 - level) / np.minimum(REGISTERS, np.minimum(n, m)))
            likely = estimate(_stacked(left), _stacked(right), n, m) >= level - SIGMAS * deviation
            # sizes alone bound the likeness
            yield pa.array(likely & (100 * np.minimum(n, m) >= percent * np.maximum(n, m)))

    return passes("left_registers", "right_registers", "left_n", "right_n")


def verified(percent: int) -> Column:
    """Whether two full sets reach the likeness."""

    @F.arrow_udf("boolean")
    def linked(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for left, right in batches:
            found = []
            for a, b in zip(left, right):
                a, b = np.frombuffer(a.as_py(), _U), np.frombuffer(b.as_py(), _U)
                shared = len(np.intersect1d(a, b, assume_unique=True))
                found.append(100 * shared >= percent * (len(a) + len(b) - shared))
            yield pa.array(found, pa.bool_())

    return linked("left_set", "right_set")


def full_sets(text: Column, words: int) -> Column:
    @F.arrow_udf("binary")
    def whole(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            texts = (b" ".join(lower_words(t.as_py() or "")) for t in batch)
            yield pa.array([shingle_set(word_hashes(t), words).tobytes() for t in texts], pa.binary())

    return whole(text)


class _Linker:
    """Turns candidate pairs of representatives into verified links; keeps what has been read so far."""

    def __init__(self, texts: DataFrame, groups: DataFrame, words: int, percent: int):
        self.texts, self.groups, self.words, self.percent = texts, groups, words, percent

    def _both(self, pairs: DataFrame, table: DataFrame, *columns: str) -> DataFrame:
        for side, key in (("left", "u"), ("right", "v")):
            one = table.select(F.col("rep").alias(key), *[F.col(c).alias(f"{side}_{c}") for c in columns])
            pairs = pairs.join(one, key)
        return pairs

    def sets(self, ids: DataFrame) -> DataFrame:
        """The full sets of the representatives ``ids(rep)``, stored."""
        wanted = checkpoint(ids.distinct())
        if wanted.count() <= BROADCAST_ROWS:
            wanted = F.broadcast(wanted)
        texts = self.texts.join(wanted, "rep", "left_semi")
        return checkpoint(texts.select("rep", full_sets(F.col("text"), self.words).alias("set")))

    def links_to_components(self, asked: DataFrame, members: DataFrame) -> DataFrame:
        """Links of the documents asked(label, rep) with members(label, rep) of the label, and among each other.

        Both are dealt into blocks; each pair of blocks is compared by one task, and one link
        with the members of a block stands for all, as these are connected already.
        """
        targets = members.withColumn("asked", F.lit(False)).unionByName(asked.withColumn("asked", F.lit(True)))
        counts = targets.groupBy("label").agg(F.count("*").alias("n"), F.count_if("asked").alias("q")).filter("q > 0")
        counts = counts.select("label", F.ceil(F.col("n") / BLOCK).alias("t_blocks"), F.ceil(F.col("q") / BLOCK).alias("q_blocks"))
        sized = checkpoint(targets.join(counts, "label"))
        sets = self.sets(sized.select("rep"))
        own = lambda blocks: F.pmod(F.xxhash64("rep"), F.col(blocks))
        every = lambda blocks: F.explode(F.sequence(F.lit(0).cast("long"), F.col(blocks) - 1))
        sides = sized.select("label", "rep", "asked", F.lit(False).alias("asks"), own("t_blocks").alias("t"), every("q_blocks").alias("q"))
        asks = sized.filter("asked").select("label", "rep", "asked", F.lit(True).alias("asks"), every("t_blocks").alias("t"), own("q_blocks").alias("q"))
        blocks = sides.unionByName(asks).join(sets, "rep")
        found = blocks.groupBy("label", "t", "q").applyInArrow(_compare_blocks(self.percent), "u long, v long")
        return checkpoint(found.distinct())

    def links(self, pairs: DataFrame) -> DataFrame:
        """Those of the pairs (u, v) that are linked."""
        likely = self._both(pairs, self.groups, "registers", "n").filter(possible(self.percent)).select("u", "v")
        likely = checkpoint(likely)
        sets = self.sets(likely.select(F.explode(F.array("u", "v")).alias("rep")))
        return checkpoint(self._both(likely, sets, "set").filter(verified(self.percent)).select("u", "v").distinct())


def _compare_blocks(percent: int):
    """Compare the rows of a block that ask with its other rows, by full sets."""

    def compare(block: pa.Table) -> pa.Table:
        rep, asks = block.column("rep").to_numpy(), block.column("asks").to_numpy(zero_copy_only=False)
        asked = block.column("asked").to_numpy(zero_copy_only=False)
        sets = [np.frombuffer(b, _U) for b in block.column("set").to_pylist()]
        sizes = np.array([len(x) for x in sets], np.int64)
        other = np.flatnonzero(~asks)
        u, v = [], []
        if len(other):
            joined = np.concatenate([sets[i] for i in other])
            starts = np.cumsum(sizes[other]) - sizes[other]
            for i in np.flatnonzero(asks):
                place = np.minimum(np.searchsorted(sets[i], joined), sizes[i] - 1)
                shared = np.add.reduceat((sets[i][place] == joined).astype(np.int64), starts)
                near = other[(100 * shared >= percent * (sizes[i] + sizes[other] - shared)) & (rep[other] != rep[i])]
                member = near[~asked[near]]
                for k in [*member[:1], *near[asked[near]]]:
                    u.append(max(rep[i], rep[k]))
                    v.append(min(rep[i], rep[k]))
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return compare


def _mixed(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows (band, rep) with their component, of the buckets that still hold several components."""
    known = labels.select(F.col("u").alias("rep"), F.col("v").alias("label"))
    rows = rows.join(known, "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    spread = rows.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high")
    return rows.join(spread.select("band"), "band")


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 5, percent: int = PERCENT
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id, kept``.

    Links join documents whose sets of ``words``-word shingles (A-Z lower-cased) have a
    Jaccard likeness of ``percent`` or more; ``component_id`` is the smallest id in reach,
    ``kept`` marks that document. A text with fewer words is one shingle. A text without
    words is empty, null texts are, and linked with nothing. Rows that share an id are one
    document with the links of all its texts. A row without id is its own component, null.
    """
    plain = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    sketched = plain.select("doc_id", sketches(F.col("text"), words).alias("s")).select("doc_id", "s.*")
    sketched = checkpoint(sketched)
    able = sketched.filter(F.col("doc_id").isNotNull() & (F.col("n") > 0))
    groups = checkpoint(
        able.groupBy("copy").agg(F.min("doc_id").alias("rep"), F.max("registers").alias("registers"), F.max("n").alias("n"))
    )
    linker = _Linker(plain.withColumnRenamed("doc_id", "rep"), groups, words, percent)

    alone = Window.partitionBy("band").orderBy("rep")
    rows = groups.select("rep", F.explode(band_keys(F.col("registers"))).alias("band"))
    shared = rows.withColumn("company", F.lag("rep").over(alone).isNotNull() | F.lead("rep").over(alone).isNotNull())
    rows = checkpoint(shared.filter("company").select("band", "rep"))

    repeated = checkpoint(able.groupBy("doc_id").agg(F.count("*").alias("texts")).filter("texts > 1").select("doc_id"))
    labels = None
    if repeated.take(1):
        same = able.join(repeated, "doc_id").join(groups.select("copy", "rep"), "copy").filter("doc_id != rep")
        labels = components(same.select(F.col("doc_id").alias("u"), F.col("rep").alias("v")))
    for turn in range(ROUNDS):
        open_rows = rows if labels is None else _mixed(rows, labels)
        order = F.xxhash64("rep", F.lit(turn)) if turn else F.col("rep")
        ordered = open_rows.withColumn("order", order)
        centres = F.first("rep").over(Window.partitionBy("band").orderBy("order", "rep"))
        pairs = ordered.select(centres.alias("c"), "rep").filter("c != rep")
        pairs = pairs.select(F.greatest("c", "rep").alias("u"), F.least("c", "rep").alias("v")).distinct()
        links = linker.links(pairs)
        labels = components(links if labels is None else links.unionByName(labels))

    rest = checkpoint(_mixed(rows, labels))
    if not rest.isEmpty():
        # In each bucket the documents outside its largest component ask for links with it and each other.
        sizes = rest.groupBy("band", "label").agg(F.count("*").alias("members"))
        main = sizes.groupBy("band").agg(F.max(F.struct("members", "label"))["label"].alias("main"))
        asked = rest.join(main, "band").filter("label != main").select(F.col("main").alias("label"), "rep").distinct()
        members = rest.select("label", "rep").distinct()
        labels = components(linker.links_to_components(asked, members).unionByName(labels))

    known = labels.select(F.col("u").alias("rep"), F.col("v").alias("component_id"))
    by_copy = groups.join(known, "rep", "left").select("copy", F.coalesce("component_id", "rep").alias("component_id"))
    by_id = sketched.join(by_copy, "copy", "left")
    # a row without words, or without an id, stands alone
    own = F.when(F.col("doc_id").isNotNull() & (F.col("n") > 0), F.col("component_id")).otherwise(F.col("doc_id"))
    result = by_id.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))
    return result.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 5, percent: int = PERCENT) -> DataFrame:
    """``docs`` without the rows that are not kept; rows that share a kept id all stay."""
    gone = checkpoint(near_duplicates(docs, doc_id, text, words, percent).filter(~F.col("kept")).select(F.col("doc_id").alias(doc_id)).distinct())
    if gone.count() <= BROADCAST_ROWS:
        gone = F.broadcast(gone)
    return docs.join(gone, doc_id, "left_anti")

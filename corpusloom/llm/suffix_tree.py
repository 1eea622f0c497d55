"""A probabilistic suffix tree over words, and scores of texts by it.

The symbols of the tree are the words seen SYMBOL_COUNT times, the end of a text, and classes
of all other words by their first two bytes. A context of one or two symbols is kept if it is
followed CONTEXT_COUNT times and its next-symbol distribution diverges from that of the context
without its first symbol. Distributions are smoothed with the next shorter one, down to the
add-one chances of words. A token is scored in the state of the longest kept context before it:
its symbol's chance there, times its share of the symbol in the whole corpus. The logarithm of
that chance is a sum over rows of the tree, so every row is stored with what it adds, and a
text asks for rows by 64-bit keys and gets one number back from each task.

All thresholds are counts, so words, contexts and pairs grow with the corpus. They are stored
tables: the most frequent rows are broadcast, texts meet the others in a shuffle.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain, count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.shingles import lower_words, mix, word_hashes
from corpusloom.operators.ranking import with_position
from corpusloom.runtime import attach_by_key, checkpoint, discard, scratch_path, shuffle_partitions, shuffles_dropped

DEPTH = 2  # symbols of a context
SYMBOL_COUNT = 100  # times that a word of its own symbol is seen
CONTEXT_COUNT = 100  # times that a context is followed by anything
PAIR_COUNT = 3  # times that a symbol is seen behind a context; rarer ones leave their mass to the shorter context
GAIN = 20.0  # count times divergence, in nats, that keeps a context
STRENGTH = 20.0  # tokens' worth of the shorter context in each distribution
KNOWN_SHARE = 1 / 2_000_000  # of all tokens that a word's count needs to be broadcast
HEAD_ROWS = 2_000_000  # of the tree that are broadcast, at most
FILTER_BITS = 26  # log2 of the bits that tell which contexts, and which other rows of the tree, are not in the broadcast part
LOOKUP_ROWS = 1_000_000  # of a table joined by broadcast, at most
CLASSES = 512
BUCKET_BITS = 21  # log2 of the buckets of the broadcast rows
_WIDE = 31  # bits of a symbol
_LOW, _LONG = (1 << _WIDE) - 1, 1 << 2 * _WIDE  # the last symbol of a context; mark of two symbols
_END = CLASSES
FLUSH = 1_000_000  # tokens counted at once by a worker
_U = np.uint64
_WORD = ("key", "n")
_PACKED = ("part", "size", "packed")
PART_TOKENS = 1 << 20  # tokens of the corpus for each part that strings of two symbols, or asks of texts, are dealt to
CHUNK = 1 << 17  # tokens of texts that a worker looks up at once


def word_keys(words: list[bytes]) -> np.ndarray:
    """Keys of words: 55 bits of hash, 9 of class."""
    if not words:
        return np.empty(0, np.int64)
    joined = b" ".join(words)
    data = np.frombuffer(joined + b" ", np.uint8).astype(np.int64)
    starts = np.concatenate(([0], np.flatnonzero(data == 32)[:-1] + 1))
    kind = (data[starts] * 37 + data[starts + 1]) % CLASSES
    return (word_hashes(joined) << _U(9)).astype(np.int64) | kind


@dataclass
class Words:
    """Frequent words by sorted key: their counts, and their symbols or -1; and the totals."""

    keys: np.ndarray
    counts: np.ndarray
    symbols: np.ndarray
    total: int
    distinct: int
    ends: int

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each key, and whether it is there."""
        return _find(self.keys, keys)


def _find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(table):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    place = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return place, table[place] == keys


@dataclass
class Head:
    """The most frequent rows of the tree: their sorted keys and deltas, and where each bucket of keys starts.

    A key's bucket is its leading bits, so a lookup reads one start and a row or two.
    """

    keys: np.ndarray
    deltas: np.ndarray
    starts: np.ndarray
    shift: int
    elsewhere: np.ndarray | None  # bits of the contexts and of the other rows that are not here: one whose bits are not set is nowhere

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The delta of each row, 0 for those that are not here, and whether it is here."""
        bucket = (keys >> _U(self.shift)).astype(np.int64)
        at, end = self.starts[bucket], self.starts[bucket + 1]
        delta, here = np.zeros(len(keys)), np.zeros(len(keys), bool)
        left = np.flatnonzero(at < end)
        while len(left):
            place = at[left]
            met = self.keys[place] == keys[left]
            found = left[met]
            delta[found], here[found] = self.deltas[place[met]], True
            left = left[~met]
            at[left] += 1
            left = left[at[left] < end[left]]
        return delta, here

    def gains(self, keys: np.ndarray) -> tuple[float, np.ndarray]:
        """The sum of the deltas of rows that are here, and the keys of the others."""
        delta, here = self.find(keys)
        return float(delta.sum()), keys[~here]

    def may_be_elsewhere(self, keys: np.ndarray, kind: int) -> np.ndarray:
        """Of keys that are not here, of contexts (kind 0) or other rows (kind 1)."""
        if self.elsewhere is None:
            return np.zeros(len(keys), bool)
        word, bits = _bits_of(keys)
        return self.elsewhere[kind, word] & bits == bits

    def gains_of_texts(self, symbols: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What each text gains here; and the text and key of each row that may be elsewhere."""
        gain, owners, contexts, symbols = self.asks_of_texts(symbols)
        return gain, owners, _row_keys(contexts, symbols)

    def asks_of_texts(self, symbols: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """What each text gains here; and the text, context and symbol (-1: the context's own) of each row that may be elsewhere.

        What follows a context is looked up only if the context is kept, here or perhaps elsewhere.
        """
        sizes = np.array([len(c) for c in symbols], np.int64)
        whole = np.concatenate(symbols).astype(np.int64)
        owner = np.repeat(np.arange(len(symbols)), sizes)
        nth = np.arange(len(whole)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        gain, owners, contexts, follow = np.zeros(len(symbols)), [], [], []
        for d in range(1, DEPTH + 1):
            context = _context(whole, d) if len(whole) > d else whole[:0]
            inside = nth[d:] >= d
            context, symbol, text = context[inside], whole[d:][inside], owner[d:][inside]
            for kind in (0, 1):
                asked = _row_keys(context, symbol if kind else -1)
                delta, here = self.find(asked)
                gain += np.bincount(text, delta, len(gain))
                away = ~here
                away[away] = self.may_be_elsewhere(asked[away], kind)
                owners.append(text[away])
                contexts.append(context[away])
                follow.append(symbol[away] if kind else np.full(int(away.sum()), -1))
                kept = here | away
                context, symbol, text = context[kept], symbol[kept], text[kept]
        return gain, np.concatenate(owners), np.concatenate(contexts), np.concatenate(follow)


def _row_keys(context: np.ndarray, symbol: np.ndarray | int) -> np.ndarray:
    """64-bit keys of rows of the tree."""
    return mix(mix(context.astype(_U)) + np.asarray(symbol, np.int64).astype(_U))


def row_keys_of_text(symbols: np.ndarray) -> np.ndarray:
    """Keys of all rows of the tree whose deltas make the gain of a text, each as often as it counts."""
    keys = [np.empty(0, _U)]
    for d in range(1, min(DEPTH, len(symbols) - 1) + 1):
        context = _context(symbols, d)
        keys += [_row_keys(context, -1), _row_keys(context, symbols[d:])]
    return np.concatenate(keys)


def row_key(context: Column, symbol: Column) -> Column:
    """The key of a stored row."""

    @F.arrow_udf("long")
    def key(contexts: pa.Array, symbols: pa.Array) -> pa.Array:
        return pa.array(_row_keys(contexts.to_numpy(), symbols.to_numpy()).view(np.int64))

    return key(context, symbol)


def _bits_of(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The word of ``elsewhere`` that tells of a row of the tree, and the three bits that it sets there."""
    h = mix(keys)
    bits = np.zeros(len(keys), _U)
    for k in range(3):
        bits |= _U(1) << (h >> _U(6 * k) & _U(63))
    return (h >> _U(70 - FILTER_BITS)).astype(np.int64), bits.view(np.int64)


def _bits(rest: DataFrame) -> np.ndarray:
    """The bits of all contexts, and of all other rows; made in Spark, and of a fixed size however many they are."""
    size = 1 << (FILTER_BITS - 6)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            word, bits = _bits_of(batch.column("key").to_numpy().view(_U))
            word += (batch.column("symbol").to_numpy() >= 0) * size
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(bits)], names=["word", "bits"])

    words = rest.select("key", "symbol").mapInArrow(places, "word long, bits long").groupBy("word")
    word, bits = _columns(words.agg(F.bit_or("bits").alias("bits")), "word", "bits")
    out = np.zeros(2 * size, np.int64)
    out[word] = bits
    return out.reshape(2, size)


def _dealt(part: np.ndarray, parts: int, *columns: np.ndarray) -> tuple[list, list, list]:
    """For each part: its number, the rows dealt to it, and their compressed columns, of 64 bits each.

    The first column is held as steps from row to row, and the bytes of a column by their place in the number.
    """
    order = np.argsort(part.astype(np.uint16) if parts <= 1 << 16 else part, kind="stable")
    sizes = np.bincount(part, minlength=parts)
    ends = np.cumsum(sizes)
    columns = [c[order] for c in columns]
    numbers, packed = np.flatnonzero(sizes), []
    for k in numbers.tolist():
        first, *others = (c[ends[k] - sizes[k] : ends[k]] for c in columns)
        held = np.stack([np.diff(first, prepend=first.dtype.type(0)).view(np.uint8), *(c.view(np.uint8) for c in others)])
        packed.append(pa.compress(held.reshape(len(columns), -1, 8).transpose(0, 2, 1).tobytes(), codec="zstd", asbytes=True))
    return numbers.tolist(), sizes[numbers].tolist(), packed


def _unpacked(table: pa.Table, columns: int) -> Iterator[list[np.ndarray]]:
    """The columns of each row of ``_dealt``, as integers."""
    for size, packed in zip(table.column("size").to_pylist(), table.column("packed")):
        raw = pa.decompress(packed.as_buffer(), decompressed_size=8 * columns * size, codec="zstd")
        held = np.frombuffer(raw, np.uint8).reshape(columns, 8, size).transpose(0, 2, 1)
        first, *others = np.ascontiguousarray(held).view(np.int64).reshape(columns, size)
        yield [np.cumsum(first), *others]


def _part_of(tails: np.ndarray, parts: int) -> np.ndarray:
    """The part that strings are dealt to by their last two symbols."""
    return mix(tails.astype(_U)).view(np.int64) % parts


def counted(learn: Column, values: Column, names: tuple[str, ...], part_of: Callable, counts_of: Callable) -> Column:
    """Counts of what the values of the rows to learn from hold.

    ``part_of`` makes an array of a value, ``counts_of`` columns of counts of many arrays: a
    worker counts many rows at once; the counts stand on the last row of each flush.
    """

    kinds = ["binary" if n == "packed" else "long" for n in names]

    @F.arrow_udf(f"array<struct<{','.join(map(':'.join, zip(names, kinds)))}>>")
    def count(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        fields = [pa.field(n, pa.binary() if k == "binary" else pa.int64()) for n, k in zip(names, kinds)]
        for learns, column in batches:
            flushed, sizes, parts, held = [], np.zeros(len(column), np.int64), [], 0
            for i, (wanted, value) in enumerate(zip(learns, column)):
                if wanted.as_py():
                    parts.append(part_of(value.as_py()))
                    held += len(parts[-1])
                if parts and (held >= FLUSH or i == len(column) - 1):
                    flushed.append(counts_of(parts))
                    sizes[i] = len(flushed[-1][0])
                    parts, held = [], 0
            columns = [pa.concat_arrays([pa.array([], f.type), *(pa.array(c[k], f.type) for c in flushed)]) for k, f in enumerate(fields)]
            items = pa.StructArray.from_arrays(columns, fields=fields)
            yield pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), items)

    return count(learn, values)


def _columns(df: DataFrame, *names: str) -> list[np.ndarray]:
    table = df.toArrow()
    return [table.column(n).to_numpy().astype(np.int64) for n in names]


def _stored(df: DataFrame) -> tuple[DataFrame, str]:
    """The rows, written once to the shared folder as compressed columns, and their path."""
    path = scratch_path(df.sparkSession, "tree")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path), path


def _attach(rows: DataFrame, lookup: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join a stored lookup of one row per key: broadcast if it is small, else shuffled with salts."""
    if lookup.count() <= LOOKUP_ROWS:
        return rows.join(F.broadcast(lookup), key, how)
    return attach_by_key(rows, lookup, key, how)


def learn_words(plain: DataFrame) -> tuple[DataFrame, str, DataFrame, Words]:
    """The stored vocabulary (key, n) and its path, symbols (symbol, n, root, key), and the frequent words.

    Symbols of words follow the end in order of count, so the frequent words have the first ones.
    """
    spark = plain.sparkSession

    def counts_of(parts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        seen = Counter(chain.from_iterable(parts))
        return word_keys(list(seen)), np.fromiter(seen.values(), np.int64, len(seen))

    words_of = lambda text: lower_words(text or "")
    counts = plain.select(F.explode(counted(F.col("learn"), F.col("text"), _WORD, words_of, counts_of)).alias("c")).select("c.*")
    vocabulary, path = _stored(counts.groupBy("key").agg(F.sum("n").alias("n")))
    ends = plain.filter("learn").count()
    distinct, running = vocabulary.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    total, distinct = int(running) + ends, int(distinct) + (ends > 0)
    base = total + distinct + 1
    own = vocabulary.filter(F.col("n") >= SYMBOL_COUNT)
    own = with_position(own, F.col("n").desc(), F.col("key"), name="place")
    own = checkpoint(own.select((F.col("place") + _END + 1).alias("symbol"), "n", ((F.col("n") + 1) / base).alias("root"), "key"))
    # at most 1/KNOWN_SHARE words come to the driver
    often = F.col("n") >= total * KNOWN_SHARE
    keys, counts = _columns(vocabulary.filter(often), "key", "n")
    order = np.argsort(keys)
    words = Words(keys[order], counts[order], np.full(len(keys), -1), total, distinct, ends)
    keys, symbols = _columns(own.filter(often), "key", "symbol")
    words.symbols[words.find(keys)[0]] = symbols
    root = np.zeros(_END + 1)
    of_class = vocabulary.filter(F.col("n") < SYMBOL_COUNT).groupBy(F.col("key").bitwiseAND(F.lit(CLASSES - 1)).alias("kind"))  # at most CLASSES rows
    kind, n, types = _columns(of_class.agg(F.sum("n").alias("n"), F.count("*").alias("types")), "kind", "n", "types")
    root[kind] = n + types
    root[:CLASSES] += 1  # words never met
    root[_END] = ends + 1
    root /= base
    classes = spark.createDataFrame([(i, 0, float(root[i]), None) for i in range(_END + 1)], own.schema)
    return vocabulary, path, own.unionByName(classes), words


def _context(symbols: np.ndarray, d: int) -> np.ndarray:
    """Number of the context of ``d`` symbols before each symbol of a text from the d-th on."""
    if d == 1:
        return symbols[:-1]
    return _LONG | symbols[:-2] << _WIDE | symbols[1:-1]


def grow_tree(rows: DataFrame, symbols: DataFrame, parts: int) -> tuple[DataFrame, list[str]]:
    """Stored rows (context, symbol, n, key, delta) of kept contexts and what follows them, and their paths.

    The chance of a symbol behind a kept context is (n / root + (STRENGTH + y) r) / (STRENGTH + total)
    times its root chance: r is the same ratio behind the context without its first symbol, y the
    mass of symbols seen fewer than PAIR_COUNT times here, which goes to that shorter context.
    The row of a context has symbol -1 and as delta the logarithm of (STRENGTH + y) / (STRENGTH + total);
    a symbol's row has what its count adds to that. So the logarithm of a token's ratio is the
    sum of the deltas of the rows met on the way to its longest kept context, and a text gains
    the sum over all rows that it meets. All counts are made and joined in Spark, of whatever number;
    strings are summed in ``parts``, by a hash of their last two symbols.
    """
    spark, model, paths = rows.sparkSession, None, []
    chances, wanted = symbols.select("symbol", "root"), None
    for d in range(1, DEPTH + 1):

        def strings(values, d=d, wanted=wanted):
            coded = [c.astype(np.int64) for c in values if len(c) > d]
            context = np.concatenate([_context(c, d) for c in coded] or [np.empty(0, np.int64)])
            symbol = np.concatenate([c[d:] for c in coded] or [np.empty(0, np.int64)])
            if d == 1:
                tails, n = np.unique(context << _WIDE | symbol, return_counts=True)
                return _dealt(_part_of(tails, parts), parts, tails >> _WIDE, tails & _LOW, n)
            table = np.unique(context) if wanted is None else wanted.value
            place, keep = _find(table, context)
            keys, n = np.unique((place << _WIDE | symbol)[keep], return_counts=True)
            context = table[keys >> _WIDE]
            tails = (context & _LOW) << _WIDE | keys & _LOW
            order = np.argsort(tails, kind="stable")
            tails, first, n = tails[order], (context >> _WIDE & _LOW)[order], n[order]
            return _dealt(_part_of(tails, parts), parts, tails >> _WIDE, tails & _LOW, n, first)

        counts = rows.select(F.explode(counted(F.col("learn"), F.col("symbols"), _PACKED, lambda v: np.frombuffer(v, np.int32), strings)).alias("c")).select("c.*")
        pairs, path = _stored(_pairs(counts, model, parts))
        sums = checkpoint(pairs.groupBy("context").agg(F.sum("n").alias("total")).filter(F.col("total") >= CONTEXT_COUNT))
        often = _with_shorter(_attach(pairs, sums, "context"), chances, model)
        mixed = (F.col("n") + STRENGTH * F.col("shorter")) / (F.col("total") + STRENGTH)
        judged = often.withColumn("term", mixed * F.log(mixed / F.col("shorter"))).groupBy("context", "total")
        seen = F.col("n") >= PAIR_COUNT
        judged = judged.agg(F.sum("term").alias("divergence"), F.coalesce(F.sum(F.when(seen, F.col("n"))), F.lit(0)).alias("given"))
        kept = checkpoint(judged.filter(F.col("total") * F.col("divergence") >= GAIN))
        left = (F.col("total") - F.col("given") + STRENGTH).alias("left")
        held = _with_shorter(_attach(pairs.filter(seen), kept.select("context", left), "context"), chances, model)
        states = kept.select("context", F.lit(-1).cast("long").alias("symbol"), F.col("total").alias("n"), F.log(left / (F.col("total") + STRENGTH)).alias("delta"))
        added = F.log1p(F.col("n") / (F.col("left") * F.col("shorter"))).alias("delta")
        grown = states.unionByName(held.select("context", "symbol", "n", added))
        grown, grown_path = _stored(grown.select("*", row_key(F.col("context"), F.col("symbol")).alias("key")))
        paths.append(grown_path)
        model = grown if model is None else model.unionByName(grown)
        if d < DEPTH:
            # a longer context is frequent only if what follows this one is
            long = pairs.filter((F.col("n") >= CONTEXT_COUNT) & (F.col("symbol") != _END)).select(
                F.shiftleft("context", _WIDE).bitwiseOR(F.col("symbol")).bitwiseOR(F.lit(_LONG)).alias("context")
            )
            wanted = spark.sparkContext.broadcast(np.sort(_columns(long, "context")[0])) if long.count() <= HEAD_ROWS else None
        discard(spark, path)
    return model, paths


def _pairs(counts: DataFrame, model: DataFrame | None, parts: int) -> DataFrame:
    """Rows (context, symbol, n) from counts of strings; with ``after_delta``, of the row without the first symbol.

    Longer strings are dealt by their tails alone, so that their counts and the rows that they need meet at once.
    """

    def summed(columns: Iterator[list[np.ndarray]]) -> list[np.ndarray]:
        """Distinct tails, in order, with what else tells strings apart, and the sums of their counts."""
        context, symbol, n, *first = (np.concatenate(c) for c in zip(*columns))
        tails = context << _WIDE | symbol
        order = np.lexsort((*first, tails))
        strings = [c[order] for c in (tails, *first)]
        fresh = np.concatenate(([True], np.any([c[1:] != c[:-1] for c in strings], axis=0)))
        begin = np.flatnonzero(fresh)
        return [*(c[begin] for c in strings), np.add.reduceat(n[order], begin)]

    def summed_part(table: pa.Table) -> pa.Table:
        tails, n = summed(_unpacked(table, 3))
        return pa.table({"context": tails >> _WIDE, "symbol": tails & _LOW, "n": n})

    def met_part(table: pa.Table, after: pa.Table) -> pa.Table:
        tails, first, n = summed(_unpacked(table, 4)) if table.num_rows else [np.empty(0, np.int64)] * 3
        known, delta = after.column("tail").to_numpy(), after.column("after_delta").to_numpy()
        order = np.argsort(known)
        place, here = _find(known[order], tails)
        deltas = np.zeros(len(tails))
        deltas[here] = delta[order[place[here]]]
        columns = {"context": _LONG | first << _WIDE | tails >> _WIDE, "symbol": tails & _LOW, "n": n}
        return pa.table(columns | {"after_delta": pa.array(deltas, pa.float64(), mask=~here)})

    if model is None:
        return counts.groupBy("part").applyInArrow(summed_part, "context long, symbol long, n long")

    @F.arrow_udf("long")
    def part(tails: pa.Array) -> pa.Array:
        return pa.array(_part_of(tails.to_numpy(), parts))

    after = model.filter("symbol >= 0").filter(F.col("context") < _LONG)
    after = after.select(F.shiftleft("context", _WIDE).bitwiseOR(F.col("symbol")).alias("tail"), F.col("delta").alias("after_delta"))
    after = after.withColumn("part", part(F.col("tail")))
    return counts.groupBy("part").cogroup(after.groupBy("part")).applyInArrow(met_part, "context long, symbol long, n long, after_delta double")


def _with_shorter(pairs: DataFrame, chances: DataFrame, model: DataFrame | None) -> DataFrame:
    """Add ``shorter``: the chance of the symbol in the state of the context without its first symbol."""
    rooted = _attach(pairs, chances, "symbol")
    if model is None:
        return rooted.withColumn("shorter", F.col("root"))
    last = F.col("context").bitwiseAND(F.lit(_LOW)).alias("last")
    states = model.filter("symbol < 0").select(F.col("context").alias("last"), F.col("delta").alias("state_delta"))
    met = _attach(rooted.select("*", last), states, "last", "left")
    return met.withColumn("shorter", F.col("root") * F.exp(F.coalesce("state_delta", F.lit(0.0)) + F.coalesce("after_delta", F.lit(0.0))))


def head_of(model: DataFrame) -> tuple[Head, DataFrame]:
    """The most frequent rows of the tree, at most HEAD_ROWS, for a broadcast; and the other rows."""
    power = F.floor(F.log2("n") * 8)
    sizes = sorted(model.groupBy(power.alias("power")).count().collect(), reverse=True)  # a few hundred rows
    least, held = 1 << 20, 0
    for power_of, count in sizes:
        held += count
        if held > HEAD_ROWS:
            break
        least = power_of
    table = model.filter(power >= least).select("key", "delta").toArrow()
    keys = table.column("key").to_numpy().view(_U)
    order = np.argsort(keys)
    keys = keys[order]
    depth = min(max(len(keys).bit_length(), 1), BUCKET_BITS)
    bounds = np.arange(1 << depth, dtype=_U) << _U(64 - depth)
    starts = np.append(np.searchsorted(keys, bounds), len(keys)).astype(np.int32)
    rest = model.filter(power < least)
    elsewhere = None if held <= HEAD_ROWS else _bits(rest)
    return Head(keys, table.column("delta").to_numpy()[order], starts, 64 - depth, elsewhere), rest


def _encoded(texts: list[list[bytes]], words: Words, open_rare: bool) -> tuple[list, ...]:
    """The columns of ``encoded`` for the words of some texts; each distinct word is looked up once."""
    number = defaultdict(count().__next__)
    coded = [np.array(list(map(number.__getitem__, t)), np.int64) for t in texts]
    keys = word_keys(list(number))
    order = np.argsort(keys)
    place, met = np.empty(len(keys), np.int64), np.empty(len(keys), bool)
    place[order], met[order] = words.find(keys[order])
    base = np.log10(words.total + words.distinct + 1)
    logs, own = np.zeros(len(keys)), np.full(len(keys), -1)
    logs[met], own[met] = np.log10(words.counts[place[met]] + 1) - base, words.symbols[place[met]]
    kind = keys & (CLASSES - 1)
    kind = np.where(met, kind, -1 - kind) if open_rare else kind
    symbols = np.append(np.where(own >= 0, own, kind), _END).astype(np.int32)
    end = np.log10(words.ends + 1) - base
    out = []
    for code in coded:
        here = met[code]
        text = np.append(symbols[code], symbols[-1:])
        out.append((len(code) + 1, int(here.sum()) + (words.ends > 0), float(logs[code].sum() + end), text.tobytes(), keys[code[~here]]))
    return tuple(map(list, zip(*out)))


def encoded(text: Column, shared: Broadcast, open_rare: bool) -> Column:
    """Struct of ``n_tokens``, ``known`` and ``base`` over frequent words and the end, ``rare`` keys, ``symbols``.

    With ``open_rare`` a rare word is coded as -1 minus its class: its symbol may be its own.
    """
    fields = [pa.field(n, pa.int64()) for n in ("n_tokens", "known")] + [pa.field("base", pa.float64()), pa.field("symbols", pa.binary())]

    @F.arrow_udf("n_tokens long, known long, base double, symbols binary, rare array<long>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        words: Words = shared.value
        for texts in batches:
            flushed, parts, held = [], [], 0
            for i, value in enumerate(texts):
                parts.append(lower_words(value.as_py() or ""))
                held += len(parts[-1])
                if held >= CHUNK or i == len(texts) - 1:
                    flushed.append(_encoded(parts, words, open_rare))
                    parts, held = [], 0
            columns = [list(chain.from_iterable(c)) for c in zip(*flushed)] or [[]] * 5
            offsets = np.concatenate(([0], np.cumsum([len(r) for r in columns[4]]))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*columns[4], np.empty(0, np.int64)])))
            arrays = [pa.array(c, f.type) for c, f in zip(columns, fields)] + [lists]
            yield pa.StructArray.from_arrays(arrays, fields=[*fields, pa.field("rare", lists.type)])

    return encode(text)


def settled(symbols: Column, rare: Column, own: Column) -> Column:
    """Symbols with those of rare words put in, from (key, symbol) of the row's words that have one."""

    @F.arrow_udf("binary")
    def settle(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for coded, keys, owns in batches:
            out = []
            for c, k, o in zip(coded, keys, owns):
                code = np.frombuffer(c.as_py(), np.int32).copy()
                code_of = {x["rare_key"]: x["symbol"] for x in o.as_py() or []}
                at = np.flatnonzero(code < 0)
                code[at] = [code_of.get(key, -1 - x) for key, x in zip(k.as_py(), code[at].tolist())]
                out.append(code.tobytes())
            yield pa.array(out, pa.binary())

    return settle(symbols, rare, own)


def asked(row: Column, symbols: Column, head: Broadcast, parts: int) -> Column:
    """What texts gain from rows that are broadcast, then the rows that they may need from elsewhere, by part.

    Many texts are dealt at once: packed columns of their numbers and gains, or numbers and the symbols of rows, stand on the last row of each flush.
    """
    names = (*_PACKED, "gained")
    fields = [pa.field(n, k) for n, k in zip(names, (pa.int64(), pa.int64(), pa.binary(), pa.bool_()))]

    @F.arrow_udf("array<struct<part:long,size:long,packed:binary,gained:boolean>>")
    def ask(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for numbers, coded in batches:
            numbers = numbers.to_numpy()
            begin, flushed, sizes = 0, [], np.zeros(len(coded), np.int64)
            asks, gains, parts_held, held, away = [], [], [], 0, 0
            for i, code in enumerate(coded):
                parts_held.append(np.frombuffer(code.as_buffer(), np.int32))
                held += len(parts_held[-1])
                last = i == len(coded) - 1
                if held >= CHUNK or last:
                    gain, owner, context, symbol = head.value.asks_of_texts(parts_held)
                    first = i + 1 - len(parts_held)
                    order = np.argsort(owner, kind="stable")
                    asks.append((numbers[first : i + 1][owner[order]], context[order], symbol[order]))
                    gains.append(gain)
                    away += len(owner)
                    parts_held, held = [], 0
                if away >= FLUSH or last:
                    own = numbers[begin : i + 1]
                    text, context, symbol = (np.concatenate(c) for c in zip(*asks))
                    to = _row_keys(context, symbol).view(np.int64) % parts
                    away_from_here = _dealt(to, parts, text, context >> _WIDE, context & _LOW, symbol + 1)
                    gained = _dealt(np.full(len(own), own[0] % parts), parts, own, np.concatenate(gains))  # to any part
                    for is_gain, dealt in ((True, gained), (False, away_from_here)):
                        flushed.append((*dealt, [is_gain] * len(dealt[0])))
                        sizes[i] += len(dealt[0])
                    begin, asks, gains, away = i + 1, [], [], 0
            columns = [pa.array(list(chain.from_iterable(f[k] for f in flushed)), field.type) for k, field in enumerate(fields)]
            offsets = pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32())
            yield pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(columns, fields=fields))

    return ask(row, symbols)


def _total(texts: list[np.ndarray], gains: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    row, place = np.unique(np.concatenate(texts), return_inverse=True)
    return row, np.bincount(place, np.concatenate(gains), len(row))


def _gains(rows: DataFrame, head: Broadcast, rest: DataFrame, parts: int) -> DataFrame:
    """The ``gain`` of each ``row``, in nats."""

    def summed(sums: pa.Table) -> pa.Table:
        texts, gains = zip(*_unpacked(sums, 2))
        row, gain = _total(texts, [g.view(np.float64) for g in gains])
        return pa.table({"row": row, "gain": gain})

    sums = _sums(rows, head, rest, parts, shuffle_partitions(rows.sparkSession))
    return sums.groupBy("part").applyInArrow(summed, "row long, gain double")


def _sums(rows: DataFrame, head: Broadcast, rest: DataFrame, parts: int, groups: int) -> DataFrame:
    """What each part adds to each text, as packed columns (row, gain) for each of some groups of texts.

    Rows of the tree that are not broadcast meet what the texts ask in a shuffle by part.
    """

    def met(asks: pa.Table, others: pa.Table) -> pa.Table:
        keys, deltas = others.column("key").to_numpy(), others.column("delta").to_numpy()
        order = np.argsort(keys)
        keys, deltas = keys[order], deltas[order]
        texts, gains = [np.empty(0, np.int64)], [np.empty(0)]
        gained = asks.column("gained")
        for text, value in _unpacked(asks.filter(gained), 2):
            texts.append(text)
            gains.append(value.view(np.float64))
        for text, first, last, symbol in _unpacked(asks.filter(pc.invert(gained)), 4):
            place, here = _find(keys, _row_keys(first << _WIDE | last, symbol - 1).view(np.int64))
            texts.append(text[here])
            gains.append(deltas[place[here]])
        row, gain = _total(texts, gains)
        group, size, packed = _dealt(row % groups, groups, row, gain)
        return pa.table({"part": pa.array(group, pa.int64()), "size": pa.array(size, pa.int64()), "packed": pa.array(packed, pa.binary())})

    asks = rows.select(F.explode(asked(F.col("row"), F.col("symbols"), head, parts)).alias("a")).select("a.*")
    others = rest.select(F.pmod("key", F.lit(parts)).alias("part"), "key", "delta")
    return asks.groupBy("part").cogroup(others.groupBy("part")).applyInArrow(met, "part long, size long, packed binary")


def score_texts(docs: DataFrame, learn: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    The tree and the word counts are learnt from the rows for which ``learn`` holds; a row
    for which it is null is held out. ``base_score`` is the add-one unigram score of the
    tokens (words, A-Z lower-cased, and one end), with words told apart by 64-bit keys.
    ``score`` adds what the states of the tree gain. A null text is just an end; rows that
    repeat are scored each, and learnt from each.

    Counts of frequent words, at most 1/KNOWN_SHARE, are broadcast; occurrences of other
    words meet their counts in a shuffle. So do the rows of the tree beyond HEAD_ROWS.
    """
    spark = docs.sparkSession
    learns = F.coalesce(learn, F.lit(False))
    plain = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), learns.alias("learn"))
    with shuffles_dropped(spark):
        rows, added, gains, words = _learnt(plain)
    scored = rows.drop("symbols").join(gains, "row").join(added, "row", "left")
    base_score = F.col("base") + F.coalesce("more_base", F.lit(0.0))
    return scored.select(
        "doc_id",
        (~F.col("learn")).alias("held_out"),
        "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(words.total).cast("long").alias("train_tokens"),
        base_score.alias("base_score"),
        (base_score + F.col("gain") / float(np.log(10))).alias("score"),
    )


def _learnt(plain: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, Words]:
    """Stored tables by ``row``: texts as symbols, what their rare words add, and what the tree adds; and the frequent words.

    A table or shuffle is dropped as soon as the next one is stored: rare words are settled before the tree is grown.
    """
    spark = plain.sparkSession
    vocabulary, words_path, symbols, words = learn_words(plain)
    rarest = words.total * KNOWN_SHARE  # count of a broadcast word
    coded = encoded(F.col("text"), spark.sparkContext.broadcast(words), rarest > SYMBOL_COUNT)
    rows = plain.select("doc_id", "learn", F.monotonically_increasing_id().alias("row"), coded.alias("s"))
    rows, path = _stored(rows.select("doc_id", "learn", "row", "s.*"))  # at most four bytes a token
    base = float(np.log10(words.total + words.distinct + 1))
    rest = vocabulary.filter(F.col("n") < rarest).select(F.col("key").alias("rare_key"), "n")
    met = rows.select("row", F.explode("rare").alias("rare_key")).join(rest, "rare_key", "left")
    added, _ = _stored(
        met.groupBy("row").agg(F.count("n").alias("more_known"), F.sum(F.log10(F.coalesce("n", F.lit(0)) + 1) - base).alias("more_base"))
    )
    discard(spark, words_path)
    if rarest > SYMBOL_COUNT:
        own = symbols.filter(F.col("n") < rarest).filter("key is not null").select(F.col("key").alias("rare_key"), "symbol")
        own = rows.select("row", F.explode(F.array_distinct("rare")).alias("rare_key")).join(own, "rare_key")
        own = own.groupBy("row").agg(F.collect_list(F.struct("rare_key", "symbol")).alias("own"))
        coded = settled(F.col("symbols"), F.col("rare"), F.col("own"))
        rows = rows.join(own, "row", "left").withColumn("symbols", coded).drop("own")
    rows, _ = _stored(rows.drop("rare"))
    discard(spark, path)
    parts = max(shuffle_partitions(spark), -(-words.total // PART_TOKENS))
    model, paths = grow_tree(rows, symbols, parts)
    head, other = head_of(model)
    gains, _ = _stored(_gains(rows, spark.sparkContext.broadcast(head), other, parts))
    for path in paths:
        discard(spark, path)
    return rows, added, gains, words

"""A Bloom filter as a small table: keeps rows whose key is in another table, before any shuffle.

Every key sets four bits of one 64-bit word. A word is the ``bit_or`` of its keys, so the filter
is an ordinary aggregate that combines on the map side; words are laid out in blocks, and rows meet
their block in a broadcast join. No key of the table is ever missed; of other keys about one in a
hundred passes, so an exact join has to follow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.runtime import BROADCAST_BYTES

KEYS_PER_WORD = 4  # 16 bits a key while the filter stays within its bytes
FULL_WORD = 32  # with more keys in a word too many others would pass
BITS = 4
BLOCK_WORDS = 512


def _word(key: Column, words: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(key), 6 * BITS).bitwiseAND(F.lit(words - 1).cast("long"))


def _mask(key: Column) -> Column:
    """The bits of a key: one for each six bits at the low end of its hash."""
    hashed, mask = F.xxhash64(key), F.lit(0).cast("long")
    for i in range(BITS):
        bit = F.shiftrightunsigned(hashed, 6 * i).bitwiseAND(F.lit(63).cast("long")).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit))
    return mask


def filter_words(n_keys: int, max_bytes: int = BROADCAST_BYTES) -> int | None:
    """Words of a filter for so many keys: a power of two within the bytes; None if it would be too full."""
    most = 1 << max(0, (max_bytes // 8).bit_length() - 1)
    words = BLOCK_WORDS
    while words * KEYS_PER_WORD < n_keys and 2 * words <= most:
        words *= 2
    return words if n_keys <= words * FULL_WORD else None


def build_filter(keys: DataFrame, key: str, words: int) -> DataFrame:
    """(_block, _words): the filter of all keys that are not null; repeated keys change nothing."""
    named = keys.filter(F.col(key).isNotNull())
    named = named.select(_word(F.col(key), words).alias("_word"), _mask(F.col(key)).alias("_mask"))
    empty = keys.sparkSession.range(words).select(F.col("id").alias("_word"), F.lit(0).cast("long").alias("_mask"))
    whole = named.unionByName(empty).groupBy("_word").agg(F.bit_or("_mask").alias("_mask"))
    in_order = F.array_sort(F.collect_list(F.struct(F.col("_word"), F.col("_mask"))))
    block = F.floor(F.col("_word") / BLOCK_WORDS).cast("long").alias("_block")
    return whole.groupBy(block).agg(F.transform(in_order, lambda s: s["_mask"]).alias("_words"))


def keep_possible(rows: DataFrame, key: str, table: DataFrame, words: int) -> DataFrame:
    """The rows whose key may be in the table of ``build_filter``; rows without a key go."""
    word, mask = _word(F.col(key), words), _mask(F.col(key))
    placed = rows.filter(F.col(key).isNotNull()).withColumn("_block", F.floor(word / BLOCK_WORDS).cast("long"))
    met = placed.join(F.broadcast(table), "_block")
    found = F.get("_words", word.bitwiseAND(F.lit(BLOCK_WORDS - 1).cast("long")).cast("int"))
    return met.filter(found.bitwiseAND(mask) == mask).select(*rows.columns)


def keep_known(rows: DataFrame, known: DataFrame, key: str, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Rows whose key may be among ``known``; all rows if the filter would not fit ``max_bytes``."""
    words = filter_words(known.count(), max_bytes)
    return rows if words is None else keep_possible(rows, key, build_filter(known, key, words), words)

"""Helpers that several operators share."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.runtime import checkpoint, scratch_path

# What separates words, space and \t to \r, and the words between.
SPACES = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return rows.select(*columns) if columns else rows


def whole_text(column: str | Column = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def words_of(text: Column) -> Column:
    """The words of a text as an array, without Python."""
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+", -1), lambda w: w != F.lit(""))


def count_words(text: Column) -> Column:
    """How many words a text has: runs of separators, counted from their ends."""
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def free_name(df: DataFrame, base: str) -> str:
    """A column name the table lacks, whatever the caller's columns are called."""
    taken, name = {c.lower() for c in df.columns}, base
    while name.lower() in taken:
        name += "_"
    return name


def with_fields(df: DataFrame, result: Column, *fields: str) -> DataFrame:
    """Add the named fields of one struct, computed once, as columns."""
    box = free_name(df, "result_fields")
    boxed = df.withColumn(box, result)
    return boxed.withColumns({f: F.col(f"{box}.{f}") for f in fields}).drop(box)


_RESIDENT: dict = {}  # the one large object that a Python worker keeps between tasks


def resident(key, build):
    """An object that tasks of one worker share; another key takes its place."""
    if key not in _RESIDENT:
        make_room()
        _RESIDENT[key] = build()
    return _RESIDENT[key]


def make_room() -> None:
    """Give a worker's memory back to the system: its resident object, and what freed arrays still hold."""
    _RESIDENT.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def stored(rows: DataFrame, name: str) -> DataFrame:
    """The rows, written once to the shared folder as compressed columns; as a checkpoint if those cannot hold a type."""
    if re.search(r"\b(void|interval)\b", rows.schema.simpleString()):
        return checkpoint(rows)
    path = scratch_path(rows.sparkSession, name)
    rows.write.option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.parquet(path)


BROADCAST_ROWS, BROADCAST_BYTES = 100_000, 8 << 20
SALTS = 64


def join_lookup(rows: DataFrame, lookup: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Join rows of possibly hot keys with a stored lookup of one row per key (null is a key too).

    The lookup is broadcast if its counted rows and key bytes are within fixed bounds.
    Beyond them every key is cut into salts, and the lookup repeated for each salt, so
    that the rows of one key meet it in many tasks.
    """
    other = free_name(rows, f"{key}_lookup")
    lookup = lookup.withColumnRenamed(key, other)
    n, size = lookup.agg(F.count("*"), F.coalesce(F.sum(F.octet_length(F.col(other).cast("string"))), F.lit(0))).first()
    if n <= BROADCAST_ROWS and size <= BROADCAST_BYTES:
        return rows.join(F.broadcast(lookup), rows[key].eqNullSafe(lookup[other]), how).drop(other)
    salt = free_name(rows, "salt")
    salted = rows.withColumn(salt, F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)))
    many = lookup.withColumn(f"{salt}_lookup", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).cast("long"))
    met = salted[key].eqNullSafe(many[other]) & (salted[salt] == many[f"{salt}_lookup"])
    return salted.join(many, met, how).drop(other, salt, f"{salt}_lookup")

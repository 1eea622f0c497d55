"""Session helpers: checkpoints, scratch tables, partition counts, hot keys."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows of one key that one task can take; a key with more is cut into salts.
HOT_KEY_ROWS = 1_000_000

# Row bound under which a table of short rows may be broadcast (about 100 MB).
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 << 20


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and scratch tables."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="corpusloom-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def checkpoint(df: DataFrame) -> DataFrame:
    """Write the rows once to the shared folder and cut the lineage there; a stored table is given back as it is."""
    if df.__dict__.get("_stored_rows"):
        return df
    checkpoint_dir(df.sparkSession)
    stored = df.checkpoint(eager=True)
    stored._stored_rows = True
    return stored


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def _settings(spark: SparkSession, values: dict) -> Iterator[None]:
    before = {key: spark.conf.get(key) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def arrow_rows(spark: SparkSession, rows: int):
    """Jobs started inside give their Python workers at most ``rows`` rows at once: for rows of many bytes."""
    return _settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": rows})


def shuffles_dropped(spark: SparkSession):
    """Jobs started inside delete their shuffle files as they end: for tables that are stored one after the other."""
    return _settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": True})


def parts_kept(spark: SparkSession):
    """Tables checkpointed inside know by which key they are laid out, which an adaptive plan forgets: they meet where they lie."""
    return _settings(spark, {"spark.sql.adaptive.enabled": False})


def buckets_joined(spark: SparkSession):
    """Tables stored by a key meet where they lie inside, also where further keys are joined."""
    return _settings(
        spark,
        {"spark.sql.sources.bucketing.autoBucketedScan.enabled": False, "spark.sql.requireAllClusterKeysForCoPartition": False},
    )


def stored_by(df: DataFrame, key: str, parts: int) -> DataFrame:
    """Write the rows once to the shared folder, compressed by columns and laid out by ``key``; the shuffles behind them are deleted.

    ``df`` lies in ``parts`` partitions by ``key`` already, or a task writes a file for each of them.
    """
    spark = df.sparkSession
    name = f"scratch_{uuid.uuid4().hex}"
    path = scratch_path(spark, name)
    with shuffles_dropped(spark):
        df.write.bucketBy(parts, key).option("path", path).option("compression", "zstd").saveAsTable(name)
    stored = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the files stay
    stored._path = path
    return stored


def discard(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that nothing reads any more."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def local_path(spark: SparkSession, path: str) -> str | None:
    """The path as the machine's own file system names it, which tasks open without Hadoop; None on any other file system."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.makeQualified(folder).toUri().getPath() if files.getUri().getScheme() == "file" else None


def drop_stored(df: DataFrame) -> None:
    """Delete the files of a checkpointed table that nothing reads any more."""
    file = df._jdf.queryExecution().analyzed().rdd().getCheckpointFile()
    if file.isDefined():
        discard(df.sparkSession, file.get())


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def sized_broadcast(table: DataFrame) -> DataFrame:
    """A stored table, marked for broadcast if its counted rows and characters are within the bounds."""
    texts = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in table.columns]
    rows, size = table.agg(F.count(F.lit(1)), F.coalesce(F.sum(sum(texts[1:], texts[0])), F.lit(0))).first()
    return F.broadcast(table) if rows <= BROADCAST_ROWS and size <= BROADCAST_BYTES else table


def hot_keys(rows: DataFrame, key: str, min_rows: int | None = None) -> DataFrame | None:
    """(key, _salts) of all keys with more than ``min_rows`` rows, or None; any number of them."""
    bound = min_rows or HOT_KEY_ROWS
    counts = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_salts"))
    return _salts_of(counts, bound)


def _salts_of(counts: DataFrame, bound: int) -> DataFrame | None:
    hot = checkpoint(counts.filter(F.col("_salts") > bound).withColumn("_salts", F.ceil(F.col("_salts") / bound)))
    return None if hot.isEmpty() else sized_broadcast(hot)


def salt_rows(rows: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """Add ``_salt``: rows of a hot key are dealt over its salts."""
    dealt = F.pmod(F.xxhash64(*rows.columns), F.coalesce("_salts", F.lit(1)))
    return rows.join(hot, key, "left").withColumn("_salt", dealt).drop("_salts")


def salt_lookup(lookup: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """One row of the lookup for each salt of its key."""
    salts = F.sequence(F.lit(0).cast("long"), F.coalesce("_salts", F.lit(1)) - 1)
    return lookup.join(hot, key, "left").withColumn("_salt", F.explode(salts)).drop("_salts")


def attach_by_key(
    rows: DataFrame, lookup: DataFrame, key: str, how: str = "inner", min_rows: int | None = None, counts: str | None = None
) -> DataFrame:
    """Join ``rows`` with a lookup that has one row per key.

    The rows are stored once, as they are counted and joined. Hot keys meet copies of
    their lookup row in several tasks; rows without a key go past the join. A lookup that counts the rows
    of each of its keys already, in the column ``counts``, spares the count.
    """
    rows = checkpoint(rows)
    keyed = rows.filter(F.col(key).isNotNull())
    if counts is None:
        hot = hot_keys(keyed, key, min_rows)
    else:
        hot = _salts_of(lookup.select(key, F.col(counts).alias("_salts")), min_rows or HOT_KEY_ROWS)
    if hot is None:
        joined = keyed.join(lookup, key, how)
    else:
        joined = salt_rows(keyed, key, hot).join(salt_lookup(lookup, key, hot), [key, "_salt"], how).drop("_salt")
    if how == "inner":
        return joined
    added = [F.lit(None).cast(f.dataType).alias(f.name) for f in lookup.schema if f.name != key]
    return joined.unionByName(rows.filter(F.col(key).isNull()).select("*", *added))

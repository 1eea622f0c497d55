"""Positions in a total order, computed without one task seeing all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.runtime import checkpoint

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in its low 33 bits


def with_position(df: DataFrame, *order: Column, name: str = "position") -> DataFrame:
    """Add the 0-based position of every row under ``order`` (a total order).

    A range-partitioned sort numbers the rows inside each partition; the sizes
    of the earlier partitions, one number per partition, are then added.
    """
    ordered = checkpoint(df.orderBy(*order).withColumn("_mid", F.monotonically_increasing_id()))
    part = F.shiftrightunsigned("_mid", _ROW_BITS)
    sizes = {r["part"]: r["count"] for r in ordered.groupBy(part.alias("part")).count().collect()}
    offsets, seen = [], 0
    for pid in sorted(sizes):
        offsets.append((pid, seen))
        seen += sizes[pid]
    offset_table = df.sparkSession.createDataFrame(offsets, "_part long, _offset long")
    local = F.col("_mid").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        ordered.withColumn("_part", part)
        .join(F.broadcast(offset_table), "_part")
        .select(*df.columns, (F.col("_offset") + local).alias(name))
    )

"""Inputs shared by the catalog queries, each with its SQL twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table on all cores: costly per-row work must not follow the layout of its files.

    A file is cut into many partitions of which only those with the start of a row group hold rows,
    so rows are counted (from the footers) and not partitions.
    """
    rows = table(spark, sf_dir, name)
    cores = spark.sparkContext.defaultParallelism
    sizes = [r["count"] for r in rows.groupBy(F.spark_partition_id().alias("part")).count().collect()]
    return rows if sizes and max(sizes) * cores <= 2 * sum(sizes) else rows.repartition(cores)


def sql_text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("'", "''") + "'"


def sql_list(values) -> str:
    return ", ".join(sql_text(v) for v in values)


# --- the part-supplier graph of lineitem -------------------------------------


def part_supplier_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-way links part -> supplier, with repeats."""
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("src"),
        F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("dst"),
    )


def part_supplier_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links both ways, with repeats."""
    pairs = part_supplier_pairs(spark, sf_dir)
    return pairs.unionByName(pairs.select(F.col("dst").alias("src"), F.col("src").alias("dst")))


def graph_nodes(edge_rows: DataFrame) -> DataFrame:
    return (
        edge_rows.select(F.col("src").alias("id"))
        .unionByName(edge_rows.select(F.col("dst").alias("id")))
        .distinct()
    )


GRAPH_SQL = """
pairs AS (SELECT 'p' || l_partkey AS src, 's' || l_suppkey AS dst FROM lineitem),
edges AS (SELECT DISTINCT src, dst FROM (SELECT src, dst FROM pairs UNION ALL SELECT dst, src FROM pairs)),
nodes AS (SELECT DISTINCT src AS id FROM edges UNION SELECT DISTINCT dst FROM edges),
trans AS (SELECT dst, src, 1.0::DOUBLE / count(*) OVER (PARTITION BY src) AS p FROM edges),
vec AS (SELECT id, 1.0::DOUBLE / (SELECT count(*) FROM nodes) AS p FROM nodes)
"""

ONE_WAY_SQL = """
edges AS (SELECT DISTINCT 'p' || l_partkey AS src, 's' || l_suppkey AS dst FROM lineitem),
nodes AS (SELECT DISTINCT src AS id FROM edges UNION SELECT DISTINCT dst FROM edges),
trans AS (SELECT dst, src, 1.0::DOUBLE / count(*) OVER (PARTITION BY src) AS p FROM edges),
vec AS (SELECT id, 1.0::DOUBLE / (SELECT count(*) FROM nodes) AS p FROM nodes)
"""


def rank_rounds_sql(rounds: int, beta: float = 0.85) -> str:
    """Chained CTEs r1..rN over ``trans`` and ``vec``."""
    steps, previous = [], "vec"
    for i in range(1, rounds + 1):
        steps.append(
            f"r{i} AS (SELECT v.id, {beta} * coalesce(m.s, 0) + {1 - beta} * v.p AS p FROM vec v LEFT JOIN "
            f"(SELECT t.dst, sum(t.p * q.p) AS s FROM trans t JOIN {previous} q ON t.src = q.id GROUP BY t.dst) m "
            f"ON v.id = m.dst)"
        )
        previous = f"r{i}"
    return ",\n".join(steps)

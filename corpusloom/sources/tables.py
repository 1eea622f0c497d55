"""Readers of the text tables that the stages exchange, and of a saved index."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators.norm_index import read_norm_index

INDEX_TABLES = ("tdm", "vocab", "term_factors", "page_ids")
DOC_FACTORS = "doc_factors"  # stored by length, in bands


def _spaced(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).csv(
        path, sep=" ", escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )


def read_page_ids(spark: SparkSession, path: str) -> DataFrame:
    """``id title``, the title quoted if it holds a space."""
    return _spaced(spark, path, "page_id long, title string")


def read_page_links(spark: SparkSession, path: str) -> DataFrame:
    """Ragged rows ``src dst dst ...`` as (src, dsts); a row may hold the source alone."""
    ids = F.split(F.trim("value"), " +")
    rows = spark.read.text(path).filter("trim(value) != ''")
    return rows.select(
        ids[0].cast("long").alias("src"),
        F.transform(F.slice(ids, 2, F.greatest(F.size(ids) - 1, F.lit(0))), lambda d: d.cast("long")).alias("dsts"),
    )


def read_contents(spark: SparkSession, path: str) -> DataFrame:
    """``id<TAB>text``; a row without a tab has empty text and still counts."""
    parts = F.split("value", "\t", 2)
    rows = spark.read.text(path).filter("value != ''")
    return rows.select(parts[0].cast("long").alias("doc_id"), F.coalesce(F.get(parts, F.lit(1)), F.lit("")).alias("content"))


def read_transitions(spark: SparkSession, path: str) -> DataFrame:
    return _spaced(spark, path, "dst long, src long, p double")


def read_vector(spark: SparkSession, path: str) -> DataFrame:
    return _spaced(spark, path, "id long, p double")


def read_page_rank(spark: SparkSession, path: str) -> DataFrame:
    return _spaced(spark, path, "rank long, page_id long, score double")


def read_index(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    tables = {name: spark.read.parquet(f"{path}/{name}") for name in INDEX_TABLES}
    return tables | {DOC_FACTORS: read_norm_index(spark, f"{path}/{DOC_FACTORS}").select("doc_id", "us")}


def read_templates(spark: SparkSession, table: str, path: str | None = None, buckets: int = 64) -> DataFrame:
    """lookup(name, real_title, body) of a template store; its buckets are by name.

    ``path`` and ``buckets`` name the store to a session whose catalog does not know the table yet.
    """
    if path is not None and not spark.catalog.tableExists(table):
        columns = "name STRING, real_title STRING, body STRING"
        layout = f"CLUSTERED BY (name) SORTED BY (name) INTO {int(buckets)} BUCKETS LOCATION '{path}'"
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet {layout}")
    return spark.table(table).select("name", "real_title", "body")

"""A training-data pipeline: classify, drop near copies, remove repeats, mix sources, encode."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm.bpe import with_bpe_digests
from corpusloom.llm.classifier import classify
from corpusloom.llm.mixing import mixed_documents
from corpusloom.llm.near_dedup import drop_near_duplicates
from corpusloom.llm.queries import tokenizer_path
from corpusloom.llm.suffix_dedup import remove_repeats
from corpusloom.runtime import scratch_path


def accept_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labels, accepts."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return classify(docs, labels).filter("accepted").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, 0.8): the one of smallest id."""
    return drop_near_duplicates(docs)


def remove_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of 100 bytes that also start earlier."""
    return remove_repeats(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of the sources takes it."""
    return mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded texts, one row for each row of the mix."""
    coded = with_bpe_digests(docs, tokenizer_path("word_bpe_49k.json"))
    return coded.select("doc_id", "source", "n_tokens", "ids_sha256", "decoded_sha256")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", accept_quality),
    ("minhash near-dedup", drop_near_copies),
    ("suffix-array dedup", remove_repeated_strings),
    ("mixing sources", mix),
    ("bpe encoding", encode),
]

# No stage but the mixing and the near copies can be said in SQL; tests hold each against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = scratch_path(spark, f"pipeline-{uuid.uuid4().hex}")
    for number, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
    return docs


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}

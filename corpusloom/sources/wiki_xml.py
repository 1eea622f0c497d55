"""Page dumps and page files in wiki XML."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.fixed_values import TEMPLATE_NAMESPACE
from corpusloom.functions.entities import unescape
from corpusloom.operators.links import first_title
from corpusloom.operators.pages import with_dense_ids
from corpusloom.runtime import (
    checkpoint,
    drop_stored,
    local_path,
    shuffle_partitions,
    shuffles_dropped,
    sized_broadcast,
)

PAGE_SCHEMA = (
    "title string, ns int, id long, redirect struct<_title: string>, revision array<struct<id: long, text: string>>"
)
_XML_OPTIONS = {"ignoreSurroundingSpaces": "false"}
_PAGE_FOLDER = re.compile(r"(?s).*/folder=\d+\Z").match
_PAGE_FILE = re.compile(r"page-\d+\.txt\Z").match
_SHARES = 4  # of a folder that tasks read apart
_BATCH_BYTES = 4 << 20
SITE_SCHEMA = "base string, namespaces struct<namespace: array<struct<_key: int, _VALUE: string>>>"


def _chunks(spark: SparkSession, path: str) -> DataFrame:
    """The file cut behind every page, so that one large dump, bz2 included, is read by many tasks."""
    return spark.read.option("lineSep", "</page>").text(path).select("value", F.col("_metadata.file_path").alias("file"))


def read_wiki_dump(spark: SparkSession, path: str, with_file: bool = False) -> DataFrame:
    """pages(page_id, title, ns, redirect, text) of one or more dump files, and their ``file`` if asked for.

    ``redirect`` is null for pages that are none. The text is that of the first
    revision. A page that is no well-formed XML is read by its tags instead.
    """
    source = F.regexp_extract("value", r"(?s)(<page\b.*)\z", 1)
    parsed = (
        _chunks(spark, path)
        .filter(F.col("value").contains("<page"))
        .select(
            F.from_xml(F.concat(source, F.lit("</page>")), PAGE_SCHEMA, _XML_OPTIONS).alias("p"),
            source.contains("<redirect").alias("is_redirect"),
            source.alias("source"),
            "file",
        )
    )
    broken = F.col("p.title").isNull() & F.col("p.id").isNull() & F.col("p.revision").isNull()

    def tag(name: str) -> Column:
        found = F.regexp_extract("source", rf"(?s)<{name}\b[^>]*(?<!/)>(.*?)</{name}>", 1)
        return F.when(found != "", unescape(found))

    named = F.when(broken, unescape(F.regexp_extract("source", r'<redirect\b[^>]*\btitle="([^"]*)"', 1)))
    return parsed.select(
        F.coalesce("p.id", F.when(broken, tag("id").try_cast("long"))).alias("page_id"),
        F.coalesce("p.title", F.when(broken, tag("title"))).alias("title"),
        F.coalesce("p.ns", F.when(broken, tag("ns").try_cast("int"))).alias("ns"),
        F.when(F.col("is_redirect"), F.coalesce("p.redirect._title", named, F.lit(""))).alias("redirect"),
        F.coalesce(F.get("p.revision", F.lit(0))["text"], F.when(broken, tag("text")), F.lit("")).alias("text"),
        *(["file"] if with_file else []),
    )


def read_siteinfo(spark: SparkSession, path: str) -> DataFrame:
    """siteinfo(file, url_base, namespaces ARRAY<STRUCT<key, name>>): one row for each file that has a header.

    Of several headers in one file the least counts.
    """
    header = F.regexp_extract("value", r"(?s)(<siteinfo.*?</siteinfo>)", 1)
    found = _chunks(spark, path).filter(F.col("value").contains("<siteinfo")).groupBy("file").agg(F.min(header).alias("header"))
    found = found.select("file", F.from_xml("header", SITE_SCHEMA, _XML_OPTIONS).alias("s"))
    named = F.transform(
        "s.namespaces.namespace",
        lambda n: F.struct(n["_key"].alias("key"), F.coalesce(n["_VALUE"], F.lit("")).alias("name")),
    )
    return found.select("file", F.regexp_replace("s.base", "/[^/]*$", "").alias("url_base"), named.alias("namespaces"))


def template_namespace(siteinfo: DataFrame) -> DataFrame:
    """(file, template_namespace): the name of each file's namespace with key 10."""
    names = siteinfo.select("file", F.explode("namespaces").alias("n"))
    return names.filter("n.key = 10").select("file", F.col("n.name").alias("template_namespace"))


def with_siteinfo(pages: DataFrame, siteinfo: DataFrame) -> DataFrame:
    """Add ``url_base`` and ``template_namespace`` of each page's own dump file.

    Where all headers say the same, that holds for every page, whichever file has the header. Otherwise
    ``pages`` need their ``file``; pages of a file without a header have no url base and the
    usual template namespace.
    """
    sites = siteinfo.join(template_namespace(siteinfo), "file", "left").select("file", "url_base", "template_namespace")
    usual = F.coalesce("template_namespace", F.lit(TEMPLATE_NAMESPACE)).alias("template_namespace")
    different = sites.select("url_base", usual).distinct().limit(2).collect()
    if len(different) < 2:
        base, name = different[0] if different else (None, TEMPLATE_NAMESPACE)
        return pages.withColumns({"url_base": F.lit(base).cast("string"), "template_namespace": F.lit(name)})
    if "file" not in pages.columns:
        raise ValueError("dump files differ in their siteinfo: read the pages with their file")
    # one short row for each file
    return pages.join(sized_broadcast(checkpoint(sites)), "file", "left").select(*pages.columns, "url_base", usual)


def _page_folders(spark: SparkSession, path: str) -> list[str] | None:
    """The local folders of ``path`` if it holds none but those of ``write_page_files``."""
    own = local_path(spark, path)
    if own is None or not os.path.isdir(own):
        return None
    with os.scandir(own) as entries:
        found = [e.path for e in entries if not e.name.startswith(("_", "."))]
    return found if found and all(map(_PAGE_FOLDER, found)) and not _has_others(spark, found) else None


def _folder_rows(spark: SparkSession, folders: list[str]) -> DataFrame:
    """(folder, share): each folder in ``_SHARES`` shares of its files, on all cores."""
    tasks = min(len(folders) * _SHARES, max(shuffle_partitions(spark), 4 * spark.sparkContext.defaultParallelism))
    rows = spark.createDataFrame([(f,) for f in folders], "folder string")
    return rows.select("folder", F.explode(F.sequence(F.lit(0), F.lit(_SHARES - 1))).alias("share")).repartition(tasks)


def _has_others(spark: SparkSession, folders: list[str]) -> bool:
    """Whether a folder holds anything but page files."""

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = (name for folder in batch.column(0).to_pylist() for name in os.listdir(folder))
            yield pa.RecordBatch.from_pydict({"other": [any(not _PAGE_FILE(name) for name in names)]})

    return not _folder_rows(spark, folders).filter("share = 0").mapInArrow(others, "other boolean").filter("other").isEmpty()


def _page_texts(spark: SparkSession, folders: list[str]) -> DataFrame:
    """(value): the text of each page file, read in batches of bounded bytes."""

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for folder, share in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for name in sorted(os.listdir(folder))[share::_SHARES]:
                    with open(f"{folder}/{name}", "rb") as file:
                        held.append(file.read())
                    size += len(held[-1])
                    if size > _BATCH_BYTES:
                        yield pa.RecordBatch.from_pydict({"value": pa.array(held, pa.binary())})
                        held, size = [], 0
        yield pa.RecordBatch.from_pydict({"value": pa.array(held, pa.binary())})

    read = _folder_rows(spark, folders).mapInArrow(texts, "value binary")
    return read.select(F.col("value").cast("string").alias("value"))


def read_page_files(spark: SparkSession, path: str) -> DataFrame:
    """pages(page_id, title, text) of a glob with one page per file.

    Ids are dense from 0 in title order; files without a title are left out. Each file is read once:
    the pages are stored before the sort, which looks at its rows twice. Folders of ``write_page_files`` on a local
    disk are listed and read by the tasks, so the driver holds folders, not files.
    """
    folders = _page_folders(spark, path)
    files = spark.read.text(path, wholetext=True) if folders is None else _page_texts(spark, folders)
    title = unescape(first_title(F.col("value")))
    body = unescape(F.regexp_extract("value", r"(?s)<text\b[^>]*(?<!/)>(.*?)</text>", 1))
    pages = files.select(F.when(title != "", title).alias("title"), body.alias("text"))
    stored = checkpoint(pages)
    with shuffles_dropped(spark):
        numbered = with_dense_ids(stored)  # stores the sorted rows
    drop_stored(stored)
    return numbered.select("page_id", "title", "text")

"""Writers of the text tables that the stages exchange, and of a search index."""

from __future__ import annotations

import os
import shutil
from collections import deque
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.runtime import arrow_rows, checkpoint, local_path

MIN_FILE_BYTES = 200 * 1024
FILES_PER_FOLDER = 100
FOLDER_BITS = 10  # of the number of a page file, for its place in its folder


def _write_spaced(df: DataFrame, path: str, *columns: str) -> None:
    df.select(*columns).write.mode("overwrite").csv(
        path, sep=" ", escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )


def write_page_ids(page_ids: DataFrame, path: str) -> None:
    _write_spaced(page_ids, path, "page_id", "title")


def write_page_links(adjacency: DataFrame, path: str) -> None:
    """Rows ``src dst dst ...`` of (src, dsts)."""
    ids = F.concat(F.array(F.col("src").cast("string")), F.col("dsts").cast("array<string>"))
    adjacency.select(F.array_join(ids, " ").alias("value")).write.mode("overwrite").text(path)


def write_contents(contents: DataFrame, path: str) -> None:
    line = F.concat(F.col("doc_id").cast("string"), F.lit("\t"), F.regexp_replace("content", r"[\r\n]+", " "))
    contents.select(line.alias("value")).write.mode("overwrite").text(path)


def write_transitions(transitions: DataFrame, path: str) -> None:
    _write_spaced(transitions, path, "dst", "src", "p")


def write_vector(vector: DataFrame, path: str) -> None:
    _write_spaced(vector, path, "id", "p")


def write_page_rank(page_rank: DataFrame, path: str) -> None:
    _write_spaced(page_rank, path, "rank", "page_id", "score")


def write_index(path: str, **tables: DataFrame) -> None:
    """The parts of a search index as one parquet table each."""
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{path}/{name}")


def save_templates(lookup: DataFrame, table: str, path: str, buckets: int = 64) -> None:
    """Store ``lookup(name, real_title, body)`` as ``table`` in ``path``, bucketed and sorted by name.

    Later runs read it by ``read_templates`` instead of the dump; a join by name leaves the store where it lies.
    """
    lookup.write.mode("overwrite").bucketBy(buckets, "name").sortBy("name").option("path", path).saveAsTable(table)


def write_page_files(pages: DataFrame, path: str) -> None:
    """Write ``pages(value)`` as one file each, in folders ``folder=n`` of at most 1024 files.

    A folder belongs to one task, so the end of the job moves folders, not files, and readers list them side by
    side. On a local disk the tasks open the files themselves: Hadoop would start a process for each.
    """
    spark, folder = pages.sparkSession, F.shiftright(F.monotonically_increasing_id(), FOLDER_BITS)
    placed, own = pages.select("value", folder.alias("folder")), local_path(spark, path)
    if own is None:
        placed.write.partitionBy("folder").option("maxRecordsPerFile", 1).text(path)
        return
    if os.path.exists(own):
        raise AnalysisException(f"[PATH_ALREADY_EXISTS] Path {path} already exists.")
    staged = f"{own}/_temporary"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the folders of an attempt that fails are never moved
        task, held, place = f"{staged}/{TaskContext.get().taskAttemptId()}", None, 0
        for batch in batches:
            for number, value in zip(batch.column(1).to_pylist(), batch.column(0).cast(pa.large_binary())):
                if number != held:
                    held, place = number, 0
                    os.makedirs(f"{task}/folder={number}")
                    yield pa.RecordBatch.from_pydict({"task": [task], "folder": [f"folder={number}"]})
                with open(f"{task}/folder={number}/page-{place:04d}.txt", "xb") as file:
                    file.write((value.as_py() or b"") + b"\n")
                place += 1

    with arrow_rows(spark, 1 << FOLDER_BITS):
        written = placed.mapInArrow(write, "task string, folder string").collect()
    os.makedirs(staged, exist_ok=True)
    for row in written:
        os.rename(f"{row['task']}/{row['folder']}", f"{own}/{row['folder']}")
    shutil.rmtree(staged)
    open(f"{own}/_SUCCESS", "wb").close()


def document_text(page_id: Column, url: Column, title: Column, body: Column) -> Column:
    """One page with its header and footer lines."""
    return F.concat(
        F.lit('<doc id="'), page_id.cast("string"), F.lit('" url="'), url, F.lit('" title="'), title, F.lit('">\n'),
        title, F.lit("\n\n"), body, F.lit("\n</doc>\n"),
    )


def file_bytes(size: str) -> int:
    """Bytes of a size such as ``500K``, ``1M`` or ``2G``."""
    power = "kmg".find(size[-1:].lower()) + 1
    amount = size[:-1] if power else size
    if not amount.isdigit() or int(amount) * 1024**power < MIN_FILE_BYTES:
        raise ValueError(f"insufficient or invalid size: {size}")
    return int(amount) * 1024**power


def folder_name(number: int) -> str:
    """AA, AB, ... ZZ, then three letters and more."""
    letters = ""
    while number >= 0 or len(letters) < 2:
        number, place = divmod(max(number, 0), 26)
        letters = chr(ord("A") + place) + letters
        number -= len(letters) >= 2
    return letters


def pack_documents(documents: DataFrame, limit: int, order: Sequence[str] = ()) -> DataFrame:
    """(folder, file, place, value): documents dealt in order to files of at most ``limit`` bytes.

    A document that does not fit behind the others opens the next file; one larger than ``limit``
    has a file of its own. 100 files fill a folder. The documents are cut into ranges of at least
    100 files by ``order`` (as they lie if empty; null keys first) and stored; each range packs by the running sum of its own sizes, and
    only the number of files of each range reaches the driver. Only the last file of a range is not filled.
    """
    spark = documents.sparkSession
    keyed = documents.select("value", *(F.col(c).alias(f"key_{i}") for i, c in enumerate(order)))
    if not order:
        keyed = keyed.withColumn("key_0", F.monotonically_increasing_id())
    keys = [c for c in keyed.columns if c != "value"]
    keyed = keyed.filter("value IS NOT NULL")
    total = keyed.agg(F.sum(F.octet_length("value") + 1).alias("n")).first()["n"] or 0
    ranges = max(1, total // (limit * FILES_PER_FOLDER))
    ordered = keyed.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys, F.xxhash64("value"))
    stored = checkpoint(ordered.select("value", (F.octet_length("value") + 1).alias("size")))

    def ends(sizes: Iterable[int]) -> Iterator[int]:
        """The file of each document of a range, counted from 0."""
        file, held = 0, 0
        for size in sizes:
            if held and held + size > limit:
                file, held = file + 1, 0
            held += size
            yield file

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = -1
        for last in ends(size for batch in batches for size in batch.column(0).to_pylist()):
            pass
        yield pa.RecordBatch.from_pydict({"part": [TaskContext.get().partitionId()], "files": [last + 1]})

    before, offsets = 0, {}
    for row in stored.select(F.col("size").cast("long")).mapInArrow(counted, "part long, files long").orderBy("part").collect():
        offsets[row["part"]] = before
        before += row["files"]

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes: deque[int] = deque()
        numbers = ends(iter(sizes.popleft, None))
        place, first = 0, offsets[TaskContext.get().partitionId()]
        for batch in batches:
            sizes.extend(batch.column(1).to_pylist())
            files = [first + next(numbers) for _ in range(len(batch))]
            columns = [
                pa.array([folder_name(f // FILES_PER_FOLDER) for f in files], pa.string()),
                pa.array([f"wiki_{f % FILES_PER_FOLDER:02d}" for f in files], pa.string()),
                pa.array(range(place, place + len(files)), pa.int64()),
                batch.column(0),
            ]
            place += len(files)
            yield pa.RecordBatch.from_arrays(columns, ["folder", "file", "place", "value"])

    return stored.select("value", F.col("size").cast("long")).mapInArrow(packed, "folder string, file string, place long, value string")


def write_documents(
    documents: DataFrame, path: str, size: str = "1M", compress: bool = False, order: Sequence[str] = ()
) -> None:
    """Write ``documents(value, ...)`` as text files ``folder=AA/file=wiki_00`` of at most ``size`` before compression.

    Packed as in ``pack_documents``; an empty table leaves no file.
    """
    rows = pack_documents(documents, file_bytes(size), order).sortWithinPartitions("folder", "file", "place")
    writer = rows.select("folder", "file", "value").write.mode("overwrite").partitionBy("folder", "file").option("lineSep", "\n")
    (writer.option("compression", "bzip2") if compress else writer).text(path)

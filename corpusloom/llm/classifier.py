"""Quality classifier by co-training.

Two views of a document, the words and letters of its text and the metadata and layout
of its page, each have a logistic classifier. Over some rounds each labels all documents
without label that it is sure of, for the other to learn from: their features are counted
by label, and the log-odds of the counts are one more input of the other's classifier. The
views are then calibrated on labelled documents that neither has learnt from, and combined.

Labelled rows are a bounded sample; the counts of the others are made in Spark over all.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import with_fields
from corpusloom.llm.shingles import word_hashes
from corpusloom.runtime import scratch_path, sized_broadcast

LABELLED = 12_000  # labelled documents to fit on, at most
ROUNDS = 3
SURE = 0.97  # chance at which a view labels a document for the other
CONTENT_BITS, META_BITS = 18, 11
MIN_DOCUMENTS = 5  # of the sample that a feature must be in
PREFIX_BITS = 14  # of a hash by which rows are counted before the smallest are taken
_STATS = 1 << 10  # features of letter statistics, in front of the words
_PLAIN = bytes(b if chr(b).isalpha() or b > 127 else 32 for b in range(256))
_SIGNS = np.zeros(256, np.int64)  # 1 capital, 2 digit, 3 exclamation mark, 4 full stop or comma, 5 other sign
for _b in range(33, 127):
    _c = chr(_b)
    _SIGNS[_b] = 1 if _c.isupper() else 2 if _c.isdigit() else 3 if _c == "!" else 4 if _c in ".," else 0 if _c.isalpha() else 5


def _step(share: float) -> int:
    """Shares on a logarithmic scale of 12 steps."""
    return 0 if share <= 0 else max(1, 12 + int(np.floor(np.log2(min(share, 1.0)) * 1.2)))


def content_features(text: str) -> np.ndarray:
    """Numbers of the features of a text: its distinct words and its shares of signs."""
    data = text.encode()
    words = data.lower().translate(_PLAIN).split()
    hashes = np.unique(word_hashes(b" ".join(words)))
    found = _STATS + (hashes >> np.uint64(64 - CONTENT_BITS)).astype(np.int64)
    size = max(len(data), 1)
    shares = np.bincount(_SIGNS[np.frombuffer(data, np.uint8)], minlength=6)[1:] / size
    stats = [k * 16 + _step(x) for k, x in enumerate(shares)]
    stats.append(5 * 16 + _step(len(hashes) / max(len(words), 1)))
    stats.append(6 * 16 + min(15, int(sum(map(len, words)) / max(len(words), 1))))
    return np.concatenate((np.array(stats), np.unique(found))).astype(np.int32)


def metadata_features(values: tuple, text: str) -> np.ndarray:
    """Numbers of the features of a page: its metadata values, its size and its lines."""
    lines = text.split("\n")
    sizes = [("chars", len(text).bit_length()), ("lines", len(lines).bit_length())]
    sizes.append(("line", (len(text) // len(lines)).bit_length()))
    sizes.append(("again", _step(1 - len(set(lines)) / len(lines))))
    named = [(str(k), v) for k, v in enumerate(values)]
    keys = [zlib.crc32(f"{k}={v}".encode()) & ((1 << META_BITS) - 1) for k, v in named + sizes]
    return np.unique(np.array(keys, np.int32))


@dataclass
class Rows:
    """Sparse binary rows."""

    index: np.ndarray
    start: np.ndarray

    @classmethod
    def of(cls, parts: list[np.ndarray]) -> Rows:
        sizes = np.array([len(p) for p in parts], np.int64)
        return cls(np.concatenate(parts) if parts else np.empty(0, np.int32), np.concatenate(([0], np.cumsum(sizes))))

    def __len__(self) -> int:
        return len(self.start) - 1

    def take(self, rows: np.ndarray) -> Rows:
        return Rows.of([self.index[self.start[r] : self.start[r + 1]] for r in rows])

    def dot(self, weights: np.ndarray) -> np.ndarray:
        sums, full = np.zeros(len(self)), self.start[1:] > self.start[:-1]
        if full.any():  # each row by itself: the same in any batch
            sums[full] = np.add.reduceat(weights[self.index], self.start[:-1][full])
        return sums


def _chance(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def fit(
    rows: Rows, target: np.ndarray, size: int, odds: np.ndarray | None = None, steps: int = 120, rate: float = 0.1, decay: float = 1e-4
) -> np.ndarray:
    """Logistic regression by Adam; the last weight is the intercept. Rare features keep weight 0.

    ``odds`` are other weights of the features: a multiple of them, fitted too, is added.
    """
    weights, first, second = np.zeros(size + 2), np.zeros(size + 2), np.zeros(size + 2)
    usable = np.append(np.bincount(rows.index, minlength=size) >= MIN_DOCUMENTS, [True, odds is not None])
    owner = np.repeat(np.arange(len(rows)), np.diff(rows.start))
    told = rows.dot(odds) if odds is not None else np.zeros(len(rows))
    mean, scale = (told.mean(), told.std() or 1.0) if len(told) else (0.0, 1.0)
    told = (told - mean) / scale
    for t in range(1, steps + 1):
        off = (_chance(rows.dot(weights) + weights[-2] + weights[-1] * told) - target) / max(len(rows), 1)
        slope = np.append(np.bincount(rows.index, off[owner], minlength=size), [off.sum(), off @ told])
        slope[:-2] += decay * weights[:-2]
        slope *= usable
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope * slope
        weights -= rate * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-8)
    part = weights[-1] / scale
    weights = weights[:-1]
    if odds is not None:
        weights[:-1] += part * odds
        weights[-1] -= part * mean
    return weights


def _calibrated(margins: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Weights of margins (rows by views) and an intercept, by Newton's method with a small penalty."""
    x = np.column_stack((margins, np.ones(len(margins))))
    w = np.append(np.full(margins.shape[1], 1 / margins.shape[1]), 0.0)
    for _ in range(30):
        p = _chance(x @ w)
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * len(x) / 100 * np.eye(x.shape[1]) + 1e-6 * np.eye(x.shape[1])
        w = w - np.linalg.solve(h, x.T @ (p - target) + 1e-3 * len(x) / 100 * w)
    return w


@dataclass
class CoTrained:
    """Weights of both views and of their combination."""

    views: list[np.ndarray]
    scales: list[np.ndarray]
    combined: np.ndarray

    def score(self, parts: list[Rows]) -> tuple[np.ndarray, list[np.ndarray]]:
        """Combined chance of being good, and each view's own."""
        logits = [
            s[0] * np.clip(r.dot(w) + w[-1], -30, 30) + s[1] for r, w, s in zip(parts, self.views, self.scales)
        ]
        margin = sum(k * x for k, x in zip(self.combined, logits)) + self.combined[-1]
        return _chance(margin), [_chance(x) for x in logits]


SIZES = [_STATS + (1 << CONTENT_BITS), 1 << META_BITS]
_STARTS = [0, 2 * (SIZES[0] + 1)]  # of the counts of each view: by label, features and then documents
Teach = Callable[[list[np.ndarray], list[np.ndarray]], np.ndarray]


def sure_counts(parts: list[Rows], views: list[np.ndarray], scales: list[np.ndarray]) -> np.ndarray:
    """Counts for each view of the features of documents that the other is sure of, by its label."""
    counts = []
    for k in range(2):
        rows, w, s = parts[1 - k], views[1 - k], scales[1 - k]
        chance = _chance(s[0] * np.clip(rows.dot(w) + w[-1], -30, 30) + s[1])
        for chosen in (chance <= 1 - SURE, chance >= SURE):
            of_row = np.repeat(chosen, np.diff(parts[k].start))
            counts += [np.bincount(parts[k].index[of_row], minlength=SIZES[k]), [chosen.sum()]]
    return np.concatenate(counts).astype(np.int64)


def _odds(counts: np.ndarray, k: int) -> np.ndarray | None:
    """Log-odds of good of the features of a view, by the counts of what the other was sure of."""
    bad, good = counts[_STARTS[k] :][: 2 * (SIZES[k] + 1)].reshape(2, -1)
    if not bad[-1] or not good[-1]:
        return None
    odds = np.log((good[:-1] + 1) / (good[-1] + 2)) - np.log((bad[:-1] + 1) / (bad[-1] + 2))
    return np.where(good[:-1] + bad[:-1] >= MIN_DOCUMENTS, odds, 0.0)


def co_train(labelled: list[Rows], target: np.ndarray, unlabelled: list[Rows] | Teach, rounds: int = ROUNDS) -> CoTrained:
    """Fit both views; every fifth labelled row is left out of the fitting and calibrates them.

    ``unlabelled`` are the documents without label, or what gives their ``sure_counts``.
    """
    teach = unlabelled if callable(unlabelled) else lambda views, scales: sure_counts(unlabelled, views, scales)
    rows = np.arange(len(target))
    held, learn = rows[rows % 5 == 4], rows[rows % 5 != 4]
    if not len(held) or len(set(target[held])) < 2 or len(set(target[learn])) < 2:
        held = learn = rows
    odds: list[np.ndarray | None] = [None, None]
    for turn in range(rounds + 1):
        views, scales = [], []
        for k in range(2):
            views.append(fit(labelled[k].take(learn), target[learn], SIZES[k], odds[k]))
            margin = np.clip(labelled[k].take(held).dot(views[k]) + views[k][-1], -30, 30)
            scales.append(_calibrated(margin[:, None], target[held]))
        if turn == rounds:
            break
        counts = teach(views, scales)
        odds = [_odds(counts, k) for k in range(2)]
        if all(o is None for o in odds):
            break
    margins = np.column_stack(
        [s[0] * np.clip(r.take(held).dot(w) + w[-1], -30, 30) + s[1] for r, w, s in zip(labelled, views, scales)]
    )
    return CoTrained(views, scales, _calibrated(margins, target[held]))


def _features(text: Column, metadata: Column) -> Column:
    @F.arrow_udf("content binary, page binary")
    def both(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, values in batches:
            rows = [
                ((t := v.as_py() or ""), tuple((m.as_py() or {}).values())) for v, m in zip(texts, values)
            ]
            yield pa.StructArray.from_arrays(
                [
                    pa.array([content_features(t).tobytes() for t, _ in rows], pa.binary()),
                    pa.array([metadata_features(m, t).tobytes() for t, m in rows], pa.binary()),
                ],
                names=["content", "page"],
            )

    return both(text, metadata)


def _scores(text: Column, metadata: Column, model: Broadcast) -> Column:
    @F.arrow_udf("quality_score double, content_score double, metadata_score double")
    def score(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, values in batches:
            content, page = [], []
            for v, m in zip(texts, values):
                t = v.as_py() or ""
                content.append(content_features(t))
                page.append(metadata_features(tuple((m.as_py() or {}).values()), t))
            whole, single = model.value.score([Rows.of(content), Rows.of(page)])
            yield pa.StructArray.from_arrays(
                [pa.array(x) for x in (whole, *single)], names=["quality_score", "content_score", "metadata_score"]
            )

    return score(text, metadata)


def _rows_of(table: pa.Table | pa.RecordBatch) -> list[Rows]:
    return [Rows.of([np.frombuffer(b, np.int32) for b in table.column(c).to_pylist()]) for c in ("content", "page")]


def samples(
    docs: DataFrame, labels: DataFrame, doc_id: str, text: str, metadata: Column, labelled: int = LABELLED, unlabelled: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Features of at most ``labelled`` documents with label, and of all, or at most ``unlabelled``, without.

    Each has one row per id; rows without an id stand for themselves. Bounds take the
    documents of smallest id hash. An id with a label is never without.
    """
    spark = docs.sparkSession
    good = (F.col("quality") == 1) & (F.col("toxic") == 0)
    known = labels.select(F.col(doc_id).alias("sample_id"), good.cast("int").alias("good")).filter("good is not null and sample_id is not null")
    known = sized_broadcast(known.groupBy("sample_id").agg(F.min("good").alias("good")))
    rows = docs.select(F.col(doc_id).alias("sample_id"), _features(F.col(text), metadata).alias("f"))
    path = scratch_path(spark, "features")
    rows.select("sample_id", "f.*").write.parquet(path)
    rows = spark.read.parquet(path)
    again = sized_broadcast(rows.filter("sample_id is not null").groupBy("sample_id").count().filter("count > 1").select("sample_id"))
    one = rows.join(again, "sample_id").groupBy("sample_id").agg(F.min(F.struct("content", "page")).alias("f"))
    rows = rows.join(again, "sample_id", "left_anti").unionByName(one.select("sample_id", "f.*"))
    with_label = smallest(rows.join(known, "sample_id"), F.xxhash64("sample_id"), labelled)
    without = rows.join(known, "sample_id", "left_anti")
    if unlabelled is not None:
        without = smallest(without, F.xxhash64("sample_id", F.lit(1)), unlabelled)
    return with_label, without


def smallest(rows: DataFrame, order: Column, count: int) -> DataFrame:
    """The ``count`` rows of smallest hash, equal ones by id.

    Rows are counted by the leading bits of the hash first, so that hardly more than ``count`` of them are sorted.
    """
    bits = F.shiftright(order, 64 - PREFIX_BITS)
    sizes = rows.groupBy(bits.alias("bits")).count().collect()  # at most 2**PREFIX_BITS rows
    held, last = 0, None
    for last, size in sorted(map(tuple, sizes)):
        held += size
        if held >= count:
            break
    near = rows if last is None else rows.filter(bits <= last)
    return near.orderBy(order, "sample_id").limit(count)


def _taught(without: DataFrame) -> Teach:
    """``sure_counts`` over all rows, summed in Spark; as many numbers as there are features come to the driver."""
    size = _STARTS[1] + 2 * (SIZES[1] + 1)
    context = without.sparkSession.sparkContext

    def teach(views: list[np.ndarray], scales: list[np.ndarray]) -> np.ndarray:
        model = context.broadcast((views, scales))

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(size, np.int64)
            for batch in batches:
                total += sure_counts(_rows_of(batch), *model.value)
            place = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(total[place])], names=["place", "n"])

        parts = without.select("content", "page").mapInArrow(count, "place long, n long")
        table = parts.groupBy("place").agg(F.sum("n").alias("n")).toArrow()
        counts = np.zeros(size, np.int64)
        counts[table.column("place").to_numpy()] = table.column("n").to_numpy()
        return counts

    return teach


def train(
    docs: DataFrame, labels: DataFrame, doc_id: str, text: str, metadata: Column, labelled: int = LABELLED, unlabelled: int | None = None
) -> CoTrained:
    """Fit on at most ``labelled`` documents with label and all, or at most ``unlabelled``, others.

    A label row has quality and toxic; good is quality 1 and toxic 0. Rows with a null in
    any of the three columns are left out; an id labelled twice is good if all its labels are.
    """
    with_label, without = samples(docs, labels, doc_id, text, metadata, labelled, unlabelled)
    table = with_label.toArrow().sort_by([("sample_id", "ascending")])
    if not len(table):
        raise ValueError("no labelled document to learn from")
    mixed = np.random.default_rng(0).permutation(len(table))
    target = table.column("good").to_numpy().astype(float)[mixed]
    return co_train([v.take(mixed) for v in _rows_of(table)], target, _taught(without))


def classify(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    metadata=("source", "lang"),
    least: float = 0.5,
    labelled: int = LABELLED,
    unlabelled: int | None = None,
) -> DataFrame:
    """Add ``quality_score`` (chance of being good), ``content_score``, ``metadata_score`` and ``accepted`` to every row.

    Metadata columns that the table lacks are left out; null values are values. A null
    text is empty. Rows that repeat get the same scores. An empty table is returned with
    the columns and no rows; labels without any labelled document raise an error.
    """
    names = [m for m in metadata if m in docs.columns]
    values = F.struct(*[F.col(m).cast("string") for m in names]) if names else F.struct(F.lit("").alias("none"))
    if docs.isEmpty():
        zero = F.lit(0.0)
        return docs.withColumns({"quality_score": zero, "content_score": zero, "metadata_score": zero, "accepted": F.lit(True)})
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, doc_id, text, values, labelled, unlabelled))
    scored = with_fields(docs, _scores(F.col(text), values, model), "quality_score", "content_score", "metadata_score")
    return scored.withColumn("accepted", F.col("quality_score") >= least)

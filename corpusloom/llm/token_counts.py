"""Token counts with a whole-token shortcut.

Byte-level BPE first cuts a text into pre-tokens. A vocabulary string whose own
merges end in exactly one token costs one token wherever it is a pre-token, so a
set of such strings, proved once before the job, answers for most pre-tokens by a
single look-up. Only the others are merged.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.common import resident, whole_text

# How byte-level BPE cuts a text.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# Letters and digits outside these blocks differ between Unicode versions; a text
# that has one is cut by the tokenizer itself.
SETTLED = regex.compile(r"[^\x00-\u0557\u2000-\u206f\u20a0-\u20bf\u3000-\u30ff\u4e00-\u9fa5\uac00-\ud7a3]")

# In texts of these characters alone, plain character classes cut as the tokenizer does.
LATIN = re.compile(r"[^\x00-\u02ff\u2010-\u2027\u20ac]")

SHORT = 64  # symbols up to which a scan beats a heap, and letters up to which a piece is remembered
MEMO = 100_000  # pieces remembered in each of two generations


def latin_class(kind: str) -> str:
    """The characters below U+0300 of a general category, for use inside [...]."""
    return "".join(f"\\u{c:04x}" for c in range(0x300) if unicodedata.category(chr(c))[0] == kind)


LETTERS, DIGITS, BLANKS = latin_class("L"), latin_class("N"), r"\t-\r \x85\xa0"
LATIN_PIECES = (
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[{DIGITS}]+| ?[^{BLANKS}{LETTERS}{DIGITS}]+|[{BLANKS}]+(?![^{BLANKS}])|[{BLANKS}]+"
)


class Memo(dict):
    """Results by piece in two generations: the older one is let go when the newer is full."""

    def __init__(self, compute):
        super().__init__()
        self.compute, self.older = compute, {}

    def __missing__(self, piece: str):
        value = self.older.get(piece)
        if value is None:
            value = self.compute(piece)
        if len(piece) <= SHORT:
            if len(self) >= MEMO:
                self.older = dict(self)
                self.clear()
            self[piece] = value
        return value


def byte_letters() -> list[str]:
    """The printable character that stands for each byte value in vocabulary files."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def _merge_by_scan(parts: list[str], ranks: dict[tuple[str, str], int]) -> list[str]:
    never = len(ranks)
    order = [ranks.get(pair, never) for pair in zip(parts, parts[1:])]
    while order and (lowest := min(order)) < never:
        i = order.index(lowest)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del order[i]
        if i < len(order):
            order[i] = ranks.get((parts[i], parts[i + 1]), never)
        if i:
            order[i - 1] = ranks.get((parts[i - 1], parts[i]), never)
    return parts


def merge_symbols(symbols: list[str], ranks: dict[tuple[str, str], int]) -> list[str]:
    """Join the pair of lowest rank, leftmost first, until no pair has a rank.

    Long pieces use a heap over a linked list: n log n for n symbols.
    """
    size = len(symbols)
    if size <= SHORT:
        return _merge_by_scan(list(symbols), ranks)
    parts: list[str | None] = list(symbols)
    after, before = list(range(1, size + 1)), list(range(-1, size - 1))
    heap = [(r, i, a, b) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if (r := ranks.get((a, b))) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = after[i] if parts[i] == a else size
        if j >= size or parts[j] != b:
            continue
        parts[i], parts[j] = a + b, None
        after[i] = after[j]
        if after[i] < size:
            before[after[i]] = i
        for left in (before[i], i):
            right = after[left] if left >= 0 else size
            if right < size and (r := ranks.get((parts[left], parts[right]))) is not None:
                heapq.heappush(heap, (r, left, parts[left], parts[right]))
    return [p for p in parts if p is not None]


def read_model(path: str) -> tuple[dict[str, int], dict[tuple[str, str], int], list[str]]:
    """Vocabulary, merge ranks and added token strings of a tokenizer file."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
    return spec["model"]["vocab"], {m: r for r, m in enumerate(merges)}, [t["content"] for t in spec["added_tokens"]]


def prove_whole_tokens(path: str) -> frozenset[str]:
    """The texts of the vocabulary strings that encode alone as one token."""
    vocab, ranks, added = read_model(path)
    value = {c: b for b, c in enumerate(byte_letters())}
    whole = set()
    for string in vocab.keys() - set(added):
        if len(merge_symbols(list(string), ranks)) == 1:
            try:
                whole.add(bytes(value[c] for c in string).decode())
            except UnicodeDecodeError:  # part of a character: never a pre-token
                pass
    return frozenset(whole)


class TokenCounter:
    """Counts the tokens of a text; one per worker."""

    def __init__(self, path: str, whole: frozenset[str]):
        from tokenizers import Tokenizer

        _, self.ranks, added = read_model(path)
        self.whole, self.letters = whole, byte_letters()
        self.value = {c: b for b, c in enumerate(self.letters)}
        self.merged = Memo(self._merge)
        self.latin, self.pieces = re.compile(LATIN_PIECES), regex.compile(PIECES)
        self.special = regex.compile("|".join(map(regex.escape, sorted(added, key=len, reverse=True))) or r"(?!)")
        self.splitter = Tokenizer.from_file(path).pre_tokenizer

    def _merge(self, piece: str) -> int:
        return len(merge_symbols([self.letters[b] for b in piece.encode()], self.ranks))

    def _cut(self, text: str) -> list[str]:
        if not LATIN.search(text):
            return self.latin.findall(text)
        if not SETTLED.search(text):
            return self.pieces.findall(text)
        return [bytes(self.value[c] for c in p).decode() for p, _ in self.splitter.pre_tokenize_str(text)]

    def _segment(self, text: str) -> int:
        pieces, whole = self._cut(text), self.whole
        rest = [p for p in pieces if p not in whole]
        return len(pieces) - len(rest) + sum(map(self.merged.__getitem__, rest))

    def count(self, text: str) -> int:
        specials = len(self.special.findall(text))
        if not specials:
            return self._segment(text)
        return specials + sum(map(self._segment, self.special.split(text)))


def token_count(spark: SparkSession, text: Column, path: str) -> Column:
    """Tokens of a text, counted on the executors; the proved strings are broadcast (at most one vocabulary)."""
    whole = spark.sparkContext.broadcast(prove_whole_tokens(path))

    @F.arrow_udf("long")
    def counted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = resident(("tokens", path), lambda: TokenCounter(path, whole.value))
        for batch in batches:
            yield pa.array([counter.count(t.as_py() or "") for t in batch], pa.int64())

    return counted(text)


def count_tokens(docs: DataFrame, path: str, text: str = "text", limit: int = 1024) -> DataFrame:
    """Add ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens) to every row.

    Counts are those of the tokenizers library for the byte-level BPE file at
    ``path``, without added begin or end tokens; the file's special strings count
    as one token each. A null text has no bytes and no tokens. Repeated rows get the
    same counts. A text of any length takes memory in proportion to itself.
    """
    return docs.withColumns(
        {"n_bytes": F.octet_length(whole_text(text)).cast("long"), "n_tokens": token_count(docs.sparkSession, F.col(text), path)}
    ).withColumn("over_limit", F.col("n_tokens") > limit)

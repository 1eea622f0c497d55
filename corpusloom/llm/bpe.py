"""BPE encoding by dynamic programming over prefixes, and decoding.

In BPE every prefix of a piece has one encoding, so one last token. That token is
the one, among the vocabulary tokens which end the prefix (found by an automaton
over all tokens), that stands alone when encoded and is compatible with the last
token of the shorter prefix before it: encoding the two strings together gives just
the two tokens. Back-pointers from the end then give the ids of the whole piece,
without merging it.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import resident, with_fields
from corpusloom.llm.token_counts import (
    BLANKS,
    DIGITS,
    LATIN,
    LETTERS,
    SETTLED,
    Memo,
    byte_letters,
    merge_symbols,
    read_model,
)

# How this tokenizer cuts a normalised text, and its mark of a word's end.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"""
WORD_END = "</w>"

LATIN_WORDS = rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{DIGITS}]|[^{BLANKS}{LETTERS}{DIGITS}]+"

PAIRS = 200_000  # pair tests remembered by a worker; then it starts anew
_END = 0xE000  # a letter that ends a word is one symbol, moved to the private use area


class PrefixEncoder:
    """Encodes and decodes texts with one tokenizer file; one per worker."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.vocab, self.ranks, added = read_model(path)
        library = Tokenizer.from_file(path)
        self.normalizer, self.splitter = library.normalizer, library.pre_tokenizer
        self.added = {t: library.token_to_id(t) for t in added}
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(added, key=len, reverse=True))) + ")")
        self.words, self.latin, self.letters = regex.compile(WORDS), re.compile(LATIN_WORDS), byte_letters()
        self.strings = {str(i): t for t, i in (self.vocab | self.added).items()}
        self.coded = Memo(lambda word: self._join("".join([self.letters[b] for b in word.encode()])))
        self.pairs: dict[int, bool] = {}
        self.automaton = ahocorasick.Automaton()
        for token in self.vocab.keys() - set(added):
            if len(merge_symbols(self._symbols(token), self.ranks)) == 1:  # else no text has this token
                inner = self._inner(token)
                self.automaton.add_word(inner, (self.vocab[token], len(inner)))
        self.automaton.make_automaton()

    @staticmethod
    def _symbols(token: str) -> list[str]:
        """A token as merge symbols; the mark of a word's end belongs to its last letter."""
        if token.endswith(WORD_END) and len(token) > len(WORD_END):
            body = token[: -len(WORD_END)]
            return [*body[:-1], body[-1] + WORD_END]
        return list(token)

    def _inner(self, token: str) -> str:
        return "".join(chr(_END + ord(s[0])) if len(s) > 1 else s for s in self._symbols(token))

    def _compatible(self, left: int, right: int) -> bool:
        pair = [self.strings[str(left)], self.strings[str(right)]]
        joined = merge_symbols(self._symbols(pair[0]) + self._symbols(pair[1]), self.ranks)
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        known = self.pairs[left << 32 | right] = joined == pair
        return known

    def encode_piece(self, letters: str) -> list[int]:
        """Ids of one piece, given as byte letters, by its table of last tokens."""
        inner = letters[:-1] + chr(_END + ord(letters[-1]))
        last = [-1] * len(inner)  # the last token of the prefix that ends at each letter
        width = last.copy()
        known, compatible = self.pairs.get, self._compatible
        for end, (token, size) in self.automaton.iter(inner):
            if last[end] < 0:
                start = end - size
                if start >= 0:
                    before = last[start]
                    if before < 0:
                        continue
                    fits = known(before << 32 | token)
                    if fits is None:
                        fits = compatible(before, token)
                    if not fits:
                        continue
                last[end], width[end] = token, size
        ids, at = [], len(inner) - 1
        while at >= 0:
            ids.append(last[at])
            at -= width[at]
        return ids[::-1]

    def _join(self, letters: str) -> str:
        return " ".join(map(str, self.encode_piece(letters)))

    def _segment(self, text: str) -> list[str]:
        """The ids of each word of a text without special strings."""
        if not LATIN.search(text):  # such characters are composed, and lower-cased alike everywhere
            return list(map(self.coded.__getitem__, self.latin.findall(text.lower())))
        text = self.normalizer.normalize_str(text)
        if not SETTLED.search(text):
            return list(map(self.coded.__getitem__, self.words.findall(text)))
        return [self._join(p) for p, _ in self.splitter.pre_tokenize_str(text)]

    def encode(self, text: str) -> str:
        """The decimal ids of a text, joined by one space."""
        if "<|" not in text:
            return " ".join(self._segment(text))
        ids: list[str] = []
        for part in self.special.split(text):
            ids.extend([str(self.added[part])] if part in self.added else self._segment(part))
        return " ".join(ids)

    def decode(self, ids: str) -> str:
        """The token strings of ids, joined by one space as the file asks (it names no decoder)."""
        return " ".join(map(self.strings.__getitem__, ids.split()))


def encoder(path: str) -> PrefixEncoder:
    return resident(("bpe", path), lambda: PrefixEncoder(path))


def bpe_round_trip(text: Column, path: str) -> Column:
    """Struct of ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` of a text."""
    kind = pa.struct([("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    @F.arrow_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digests(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coder = encoder(path)
        for batch in batches:
            rows = []
            for value in batch:
                ids = coder.encode(value.as_py() or "")
                rows.append((len(ids.split()), *(hashlib.sha256(s.encode()).hexdigest() for s in (ids, coder.decode(ids)))))
            columns = list(zip(*rows)) or [(), (), ()]
            yield pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kind)], fields=list(kind))

    return digests(text)


def encode_texts(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Add the token ids of every text as ``token_ids`` and their decoded text as ``decoded``.

    Ids are those of the tokenizers library for the file at ``path``, which marks the
    ends of words, without added tokens. A null or empty text has no ids and decodes
    to an empty text.
    """
    kind = pa.struct([("token_ids", pa.list_(pa.int32())), ("decoded", pa.string())])

    @F.arrow_udf("token_ids array<int>, decoded string")
    def coded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coder = encoder(path)
        for batch in batches:
            ids = [coder.encode(t.as_py() or "") for t in batch]
            yield pa.StructArray.from_arrays(
                [
                    pa.array([list(map(int, i.split())) for i in ids], kind[0].type),
                    pa.array([coder.decode(i) for i in ids], pa.string()),
                ],
                fields=list(kind),
            )

    return with_fields(docs, coded(F.col(text)), "token_ids", "decoded")


def with_bpe_digests(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Add ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``, so that no ids leave the workers."""
    return with_fields(docs, bpe_round_trip(F.col(text), path), "n_tokens", "ids_sha256", "decoded_sha256")

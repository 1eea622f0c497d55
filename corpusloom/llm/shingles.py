"""Word and shingle hashes of a text, by numpy inside tasks."""

from __future__ import annotations

import numpy as np

_U = np.uint64
_MASK = (1 << 64) - 1


def _stream(seed: int, count: int) -> np.ndarray:
    """Fixed pseudo-random 64-bit numbers."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, count + 1, dtype=_U) * _U(0x9E3779B97F4A7C15) + _U(seed))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit numbers over all bits."""
    h = (h ^ (h >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> _U(33))


_BYTE = _stream(7, 256)
_BASE = _U(0x5851F42D4C957F2D)
_WORDS_PER_SHINGLE = _stream(11, 64)


def lower_words(text: str) -> list[bytes]:
    """The words of a text, A-Z lower-cased; bytes split at just the separators \\x20 and \\x09-\\x0D."""
    return text.encode().lower().split()


def word_hashes(joined: bytes) -> np.ndarray:
    """64-bit hashes of the words of a text whose words are joined by one space."""
    if not joined:
        return np.empty(0, _U)
    data = np.frombuffer(joined, np.uint8)
    space = data == 32
    starts = np.concatenate(([0], np.flatnonzero(space) + 1))
    lengths = np.diff(np.append(starts, len(data) + 1))
    place = np.arange(len(data)) - np.repeat(starts, lengths)[: len(data)]
    powers = np.ones(int(lengths.max()), _U)
    powers[1:] = _BASE
    powers = np.multiply.accumulate(powers)
    values = _BYTE[data] * powers[place]
    values[space] = 0
    return mix(np.add.reduceat(values, starts))


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of the word n-grams; of the whole sequence where it has fewer words."""
    if not len(words):
        return words
    size = min(size, len(words))
    total = np.zeros(len(words) - size + 1, _U)
    for k in range(size):
        total = mix(total * _BASE + words[k : len(words) - size + 1 + k] + _WORDS_PER_SHINGLE[k % 64])
    return np.unique(total)

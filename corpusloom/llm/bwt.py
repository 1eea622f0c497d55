"""Repeated windows of a few megabytes of text pieces, by a Burrows-Wheeler transform.

Plain numpy on what one task holds; nothing here knows of Spark.
"""

from __future__ import annotations

import numpy as np

_BITS = 63  # of a sort key


def stable_order(key: np.ndarray, most: int) -> np.ndarray:
    """Places of keys of 0 to ``most`` in ascending order, equal keys by place.

    Keys are sorted as numbers that end in their places, which is several times as fast, if both fit.
    """
    shift = len(key).bit_length()
    if most.bit_length() + shift > _BITS:
        return np.argsort(key, kind="stable")
    packed = key << shift | np.arange(len(key))
    packed.sort()
    return packed & (1 << shift) - 1


def suffix_order(symbols: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Positions sorted by their suffixes; pieces end in symbol 0, equal suffixes go by position.

    ``left`` counts the symbols from each position to the end of its piece, end included.
    Ranks of prefixes are doubled; only positions that still share a rank are sorted again.
    """
    n = len(symbols)
    key = np.zeros(n, np.int64)
    used = np.zeros(int(symbols.max()) + 1, bool)
    used[symbols] = used[0] = True
    dense = (np.cumsum(used) - 1)[symbols]  # the symbols in use, numbered
    bits = max(int(used.sum() - 1).bit_length(), 1)
    pack = max((_BITS - n.bit_length()) // bits, 1)  # symbols in a first sort key
    padded = np.append(dense, np.zeros(pack, np.int64))
    for k in range(pack):
        key = key << bits | np.where(left > k, padded[k : n + k], 0)
    order = stable_order(key, (1 << bits * pack) - 1)
    sorted_key = key[order]
    new = np.concatenate(([True], sorted_key[1:] != sorted_key[:-1]))
    rank = np.empty(n, np.int64)
    starts = np.flatnonzero(new)
    rank[order] = np.repeat(starts, np.diff(np.append(starts, n)))
    width, longest = pack, int(left.max())
    while width < longest:
        starts = np.flatnonzero(new)
        sizes = np.diff(np.append(starts, n))
        slots = np.flatnonzero(np.repeat(sizes > 1, sizes))  # places in the order that are not settled; of a group by position
        if not len(slots):
            break
        at = order[slots]
        follow = np.where(left[at] > width, rank[np.minimum(at + width, n - 1)] + 1, 0)
        open_sizes = sizes[sizes > 1]
        group = np.repeat(np.arange(len(open_sizes)), open_sizes)
        again = stable_order(group * (n + 1) + follow, len(open_sizes) * (n + 1))
        at, follow = at[again], follow[again]  # groups keep their places
        order[slots] = at
        split = np.concatenate(([True], (group[1:] != group[:-1]) | (follow[1:] != follow[:-1])))
        new[slots] = split
        first = slots[split]
        rank[at] = np.repeat(first, np.diff(np.append(np.flatnonzero(split), len(at))))
        width *= 2
    return order


def bounded_lcp(symbols: np.ndarray, order: np.ndarray, least: int) -> np.ndarray:
    """Whether each suffix shares fewer than ``least`` symbols with the one before it in order.

    Breadth first over the Burrows-Wheeler transform: the interval of every string is
    extended backward by each symbol before it, all intervals of one string length at a
    time. Where an extension ends at a place whose common prefix is still unknown, its
    length is that of the string before the extension; only such intervals go on. After the
    strings shorter than ``least`` the unknown places are those that share as much or more.
    """
    n = len(symbols)
    before = symbols[order - 1]  # position 0 follows the last end
    step = np.empty(n, np.int64)  # from a suffix to the one that is one symbol longer
    step[np.argsort(before, kind="stable")] = np.arange(n)
    known = np.zeros(n + 1, bool)
    known[0] = known[n] = True

    ends = int((symbols == 0).sum())  # each end is a symbol of its own
    firsts = symbols[order[ends:]]
    starts = ends + np.flatnonzero(np.concatenate(([True], firsts[1:] != firsts[:-1]))) if n > ends else np.empty(0, np.int64)
    low = np.concatenate((np.arange(ends), starts))
    high = np.append(low[1:], n) - 1
    fresh = ~known[high + 1] | (high == n - 1)
    known[high + 1] = True
    low, high = low[fresh], high[fresh]
    for _ in range(1, least):
        if not len(low):
            break
        sizes = high - low + 1
        inside = np.repeat(low - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) + np.arange(int(sizes.sum()))
        owner = np.repeat(np.arange(len(low)), sizes)
        letter = before[inside]
        inside, owner, letter = inside[letter > 0], owner[letter > 0], letter[letter > 0]
        if not len(inside):
            break
        by_letter = np.argsort(letter, kind="stable")
        inside, owner, letter = inside[by_letter], owner[by_letter], letter[by_letter]
        # an interval's places with one letter lead to neighbouring places
        cut = np.flatnonzero(np.concatenate(([True], (owner[1:] != owner[:-1]) | (letter[1:] != letter[:-1]))))
        low = step[inside[cut]]
        high = step[inside[np.append(cut[1:], len(inside)) - 1]]
        fresh = ~known[high + 1]
        low, high = low[fresh], high[fresh]
        known[high + 1] = True
    return known[:n]


def later_windows(pieces: list[bytes], owner: np.ndarray, place: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows of ``size`` bytes that also start earlier: their owners and places.

    Piece i lies at ``place[i]`` of ``owner[i]``; earlier is by owner, then by place.
    """
    lengths = np.array([len(p) + 1 for p in pieces], np.int64)
    total = int(lengths.sum())
    tails = np.cumsum(lengths) - 1
    symbols = np.empty(total, np.uint16)
    symbols[:] = np.frombuffer(b"\0".join(pieces) + b"\0", np.uint8)
    symbols += 1
    symbols[tails] = 0
    left = np.repeat(tails, lengths) - np.arange(total) + 1
    order = suffix_order(symbols, left)
    group = np.cumsum(bounded_lcp(symbols, order, size))
    whole = left[order] > size
    at, group = order[whole], group[whole]
    piece = np.repeat(np.arange(len(pieces)), lengths)[at]
    owners = owner[piece]
    places = place[piece] + at - (tails - lengths + 1)[piece]
    # groups are in order; those of one window have nothing earlier
    several = np.zeros(len(group) + 1, bool)
    several[1:-1] = group[1:] == group[:-1]
    several = several[1:] | several[:-1]
    group, owners, places = group[several], owners[several], places[several]
    first = np.lexsort((places, owners, group))
    group, owners, places = group[first], owners[first], places[first]
    later = np.zeros(len(group), bool)
    later[1:] = group[1:] == group[:-1]
    return owners[later], places[later]

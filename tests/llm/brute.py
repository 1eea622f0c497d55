"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

WORDS = re.compile("[^\x20\x09-\x0d]+")


def sha(text) -> str:
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def lower(text: str) -> str:
    return re.sub("[A-Z]+", lambda m: m.group().lower(), text)


def shingle_set(text, size):
    words = WORDS.findall(lower(text or ""))
    if not words:
        return set()
    size = min(size, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def near_components(texts: dict, size: int, percent: int = 80) -> dict:
    """Smallest id in reach for each id."""
    sets = {i: shingle_set(t, size) for i, t in texts.items()}
    parent = {i: i for i in texts}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(texts)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: root(i) for i in ids}


def without_repeats(texts, length: int = 100):
    """(bytes, removed, spans, kept) of each text, in the given order."""
    seen, out = set(), []
    for text in texts:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for at in range(len(data) - length + 1):
            window = data[at : at + length]
            if window in seen:
                gone[at : at + length] = b"\1" * length
            seen.add(window)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(data), sum(gone), spans, bytes(b for b, g in zip(data, gone) if not g)))
    return out


def rule_counts(text):
    text = text or ""
    words = WORDS.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if often[w] > 1:
            covered |= set(range(i, i + 5))
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(covered),
        failed,
    )


def targets(sizes: dict, weights=(3, 1, 2), share=1.5, most=2.0) -> dict:
    """Water filling by repeated sharing; ``sizes`` by source, None last."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = share * sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in full)
        rest = sum(weight[s] for s in names if s not in full)
        target = {s: most * sizes[s] if s in full else left * weight[s] / rest for s in names}
        more = {s for s in names if target[s] > most * sizes[s] + 1e-9}
        if not more:
            return target
        full |= more

"""Line dedup, vector codes and conversation repair against plain versions."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import block_tables as bt
from corpusloom.llm import line_dedup, vector_codes
from corpusloom.llm.conversation_repair import conversation_reports, repair_conversations
from corpusloom.llm.line_dedup import drop_repeated_lines, without_repeated_lines
from corpusloom.llm.vector_codes import compress_vectors
from tests.llm import brute

SPACES = " \t\n\x0b\f\r"


# --- lines ---------------------------------------------------------------------


def plain_lines(rows, least=10):
    """(lines, dropped, kept) per row; ids None last."""
    rank = lambda i: (i is None, i or 0)
    holders = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            key = brute.lower(line.strip(SPACES))
            if len(key) >= least:
                holders.setdefault(key, set()).add(rank(i))
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        left = [x for x in lines if len(held := holders.get(brute.lower(x.strip(SPACES)), ())) < 2 or rank(i) == min(held)]
        out.append((i, len(lines), len(lines) - len(left), "\n".join(left)))
    return sorted(out, key=str)


def line_rows(rng):
    common = ["All rights reserved by us.", "  all RIGHTS reserved by us.\t", "short", "ÄÖÜÄÖÜÄÖÜ", "ÄÖÜÄÖÜÄÖÜß", "Nine char", "İstanbul is far away", ""]
    rows = [(i, "\n".join(rng.choice(common) if rng.random() < 0.4 else f"line {rng.randint(0, 400)} of the text" for _ in range(rng.randint(0, 12)))) for i in range(120)]
    rows += [(5, "line 7 of the text\nmore of five here"), (5, "more of five here"), (None, "line 9 of the text\nonly without an id"), (None, "only without an id")]
    rows += [(200, None), (201, ""), (202, "\n\n"), (203, "\n".join(f"row {n} of a long text" for n in range(5000))), (-4, "row 17 of a long text\r\nrow 18 of a long text")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("hot_rows", [1_000_000, 3])
def test_lines(spark, hot_rows):
    rows = line_rows(random.Random(1))
    columns = "doc_id long, text string, kept string, lost_keys int, lost_doc int, cut_lines int"
    docs = spark.createDataFrame([(i, t, "k", 3, 4, 5) for i, t in rows], columns).repartition(6)
    got = without_repeated_lines(docs, hot_rows=hot_rows)
    assert got.columns == ["doc_id", "text", "kept", "lost_keys", "lost_doc", "cut_lines", "n_lines", "n_dropped"]
    assert sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in got.collect()), key=str) == plain_lines(rows)
    left = drop_repeated_lines(docs)
    assert left.columns == docs.columns and sorted(((r.doc_id, r.text, r.kept) for r in left.collect()), key=str) == sorted(
        ((i, kept, "k") for i, _, _, kept in plain_lines(rows)), key=str
    )
    assert without_repeated_lines(docs.limit(0)).collect() == []


def test_lines_by_several_slices_and_tiny_filters(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "KEYS_PER_SEGMENT", 300)
    monkeypatch.setattr(line_dedup, "SLICE_SEGMENTS", 4)
    rows = line_rows(random.Random(2))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = without_repeated_lines(docs)
    assert sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in got.collect()), key=str) == plain_lines(rows)


def test_filters_find_all_repeats_and_few_others(spark):
    rng = np.random.default_rng(3)
    keys = rng.integers(-(1 << 62), 1 << 62, 40_000)
    table = spark.createDataFrame([(int(k),) for k in np.concatenate((keys, keys[:500]))], "hash long").repartition(7)
    filters = line_dedup._twice_filter(table, 1)
    hit = {r.hash for r in table.filter(line_dedup._seen_twice(F.col("hash"), filters)).collect()}
    assert set(keys[:500].tolist()) <= hit
    assert len(hit) < 500 + 0.02 * len(keys)


# --- vectors -------------------------------------------------------------------


def plain_codes(rows):
    """(code, error) by (id, vector) and the codebooks, by full search."""
    kept = [(i, v) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    scaled = [[int(np.floor(256 * float(np.float32(x)))) for x in v] for _, v in kept]
    width = len(scaled[0]) // 16
    parts = [[v[p * width : p * width + width] for p in range(16)] for v in scaled]
    books = [[v[p] for v in parts[:64]] for p in range(16)]

    def nearest():
        return [
            [min((sum((a - b) ** 2 for a, b in zip(v[p], e)), n) for n, e in enumerate(books[p])) for p in range(16)] for v in parts
        ]

    for _ in range(2):
        found = nearest()
        for p in range(16):
            for e in range(len(books[p])):
                mine = [v[p] for v, f in zip(parts, found) if f[p][1] == e]
                if mine:
                    books[p][e] = [sum(c) // len(mine) for c in zip(*mine)]
    found = nearest()
    codes = [("".join(f"{n:02x}" for _, n in f), sum(d for d, _ in f)) for f in found]
    flat = ",".join(str(x) for book in books for e in book for x in e)
    return [(i, *c) for (i, _), c in zip(kept, codes)], brute.sha(flat)


@pytest.mark.parametrize("n,width,spread", [(300, 2, 1.0), (300, 4, 0.02), (40, 1, 1.0)])
def test_vector_codes(spark, n, width, spread):
    rng = random.Random(n + width)
    rows = [(rng.randint(0, 10**6), [rng.gauss(0, spread) for _ in range(16 * width)], rng.choice([1, 2, None])) for _ in range(n)]
    rows += [rows[0], rows[1], (None, rows[2][1], 5)]  # repeated rows, a row without an id
    rows += [(7, None, 1), (8, [None] + rows[0][1][1:], 1), (9, [float("nan")] + rows[0][1][1:], 1), (10, [float("-inf")] + rows[0][1][1:], 2)]
    table = spark.createDataFrame([(*r, "x", "y") for r in rows], "vec_id long, embedding array<float>, label int, code string, vector_parts string").repartition(5)
    got = compress_vectors(table)
    assert set(got.columns) == {"vec_id", "label", "vector_parts", "code", "error", "label_error", "codebooks_sha256"}
    got = got.collect()
    want, digest = plain_codes([r[:2] for r in rows])
    assert sorted([(r.vec_id, r.code, r.error) for r in got], key=str) == sorted(want, key=str)
    assert {r.codebooks_sha256 for r in got} == {digest}
    sums = {}
    for r in got:
        sums[r.label] = sums.get(r.label, 0) + r.error
    assert all(r.label_error == sums[r.label] for r in got)


def test_vectors_of_wrong_shape_and_none(spark):
    table = spark.createDataFrame([(1, [0.5] * 16, 1), (2, [0.5] * 32, 1)], "vec_id long, embedding array<float>, label int")
    with pytest.raises(ValueError):
        compress_vectors(table)
    assert compress_vectors(table.limit(0)).collect() == []
    (one,) = compress_vectors(table.filter("vec_id = 1")).collect()
    assert (one.code, one.error) == ("00" * 16, 0)


def test_pivots_prune_but_never_miss():
    rng = np.random.default_rng(5)
    entries, vectors = rng.integers(-100, 100, (64, 4)), rng.integers(-100, 100, (2000, 4))
    pivots = vector_codes.pick_pivots(entries)
    index, best, made = vector_codes.nearest_entries(vectors, vector_codes.pivot_distances(vectors, pivots), entries, pivots)
    exact = ((vectors[:, None] - entries[None]) ** 2).sum(2)
    assert (index == exact.argmin(1)).all() and (best == exact.min(1)).all()
    assert made < 0.3 * exact.size


# --- conversations ---------------------------------------------------------------


def plain_repair(rows):
    """Reports by conversation from (conv, turn, role, text)."""
    out = {}
    for conv in {r[0] for r in rows}:
        mine = []
        for _, turn, role, text in (r for r in rows if r[0] == conv):
            role, text = (" " if x is None else x for x in (role, text))
            key = ":".join(" " if x is None else str(x) for x in (conv, turn))
            fate = zlib.crc32(key.encode()) % 20
            if fate == 0:
                continue
            text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
            role = "user" if fate == 4 else role
            mine += [(turn is not None, turn or 0, role, text)] * (2 if fate == 3 else 1)
        mine.sort(key=lambda r: (r[0], r[1], r[2].encode(), r[3].encode()))
        turns = {r[1] for r in mine if r[0]}
        counts, seen, marks = [0, 0, 0], set(), []
        for _, _, role, text in mine:
            bare = text.strip(SPACES)
            fault = 0 if not bare else 1 if (role, text) in seen else 2 if bare[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                counts[fault] += 1
            marks.append(fault)
        initials = [r[2][:1] for r in mine]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, left = plain_search([(r[2], r[3], m) for r, m in zip(mine, marks)])
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out[conv] = (gaps, *counts, illegal, cost, audit, brute.sha("\n".join(left)))
    return out


def plain_search(rows):
    """Cheapest edits, by a forward search over (state, edits, rows left) with whole edit strings."""
    turn = {"": "u", "s": "u", "u": "a", "a": "u"}
    full = {"u": "user", "a": "assistant"}

    def insert(best):
        for state in ("", "s", "a", "u", "a", "u"):
            if state in best:
                cost, audit, left = best[state]
                way = (cost + 2, audit + "I", left + [full[turn[state]] + ":"])
                best[turn[state]] = min(best.get(turn[state], way), way)
        return best

    best = insert({"": (0, "", [])})
    for role, text, fault in rows:
        after = {}

        def put(state, way):
            after[state] = min(after.get(state, way), way)

        for state, (cost, audit, left) in best.items():
            put(state, (cost + 3, audit + "D", left))
            if fault not in (0, 1):
                extra = fault == 2
                put(turn[state], (cost + 2 + extra, audit + "R", left + [f"{full[turn[state]]}:{text}"]))
                initial = role[:1]
                if initial and (initial == turn[state] or (initial == "s" and state == "")):
                    put(initial, (cost + extra, audit + "K", left + [f"{role}:{text}"]))
        best = insert(after)
    cost, audit, left = min(best[s] for s in ("", "a") if s in best)
    return cost, audit, left


def conversation_rows(rng, conversations, most):
    rows = []
    for conv in [*range(conversations), None]:
        for turn in range(rng.randint(0, most)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None, "User"])
            text = rng.choice([f"text {rng.randint(0, 9)}.", f"open {turn}", "same answer!", " \t", "", None, "why? \n", "ends.\x0b"])
            rows.append((conv, rng.choice([turn, turn, turn, turn + 3, None]), role, text))
    return rows


def report_rows(df):
    return {
        r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in df.collect()
    }


@pytest.mark.parametrize("block_turns,chunk_rows", [(4096, 4096), (3, 2), (5, 4096)])
def test_repair(spark, block_turns, chunk_rows):
    rows = conversation_rows(random.Random(block_turns), 60, 14)
    table = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, codes string").repartition(6)
    reports = conversation_reports(table, block_turns, chunk_rows)
    assert reports.count() == len({r[0] for r in rows})
    assert report_rows(reports) == plain_repair(rows)
    pieces = repair_conversations(table, block_turns, chunk_rows).collect()
    totals = {}
    for p in sorted(pieces, key=lambda p: (str(p.conv_id), p.block is not None, p.block or 0, p["sub"])):
        totals.setdefault(p.conv_id, []).extend(f"{x.role}:{x.text}" for x in p.repaired)
    assert {c: brute.sha("\n".join(x)) for c, x in totals.items()} == {c: v[-1] for c, v in plain_repair(rows).items()}


def test_one_long_conversation(spark):
    rng = random.Random(9)
    rows = [(1, t, rng.choice(["user", "assistant", "assistant"]), f"turn {rng.randint(0, 300)}{rng.choice(['.', ''])}") for t in range(700)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert report_rows(conversation_reports(table, 64, 40)) == plain_repair(rows)


def test_dropped_and_empty(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    table = spark.createDataFrame([(gone, 0, "user", "hello.")], "conv_id long, turn long, role string, text string")
    assert report_rows(conversation_reports(table)) == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert conversation_reports(table.limit(0)).collect() == []


def test_tables_agree_with_single_steps():
    t = bt.tables()
    rng = random.Random(4)
    assert len(t.vectors) < 100
    for _ in range(300):
        codes = bytes(rng.randrange(bt.SYMBOLS) for _ in range(rng.randint(0, 17)))
        costs = bt.END
        for code in reversed(codes):
            costs = bt.before(code, costs)
        assert bt.costs_before(codes, bt.END) == costs
        edits, state = bt.trace(codes, bt.END, bt.START, True)
        assert state in (bt.START, bt.ASSISTANT)
        assert costs[bt.START] == sum(bt.COST[e] + ((codes[at] - 1) & 1 if e in "KR" else 0) for e, at, _ in edits)

"""Chat windows, near duplicates, fingerprints, mixing, language model scores, repeats: against brute force."""

import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpusloom.llm.bwt import later_windows
from corpusloom.llm.chat import escape, format_conversations, read_back, read_turns, unescape
from corpusloom.llm.components import components
from corpusloom.llm.mixing import mix_sources, mixed_documents
from corpusloom.llm.near_dedup import drop_near_duplicates, near_duplicates
from corpusloom.llm.queries import QUERIES
from corpusloom.llm.spotsigs import ANCHORS, similar_pairs, spot_signatures, with_edited_text
from corpusloom.llm.suffix_dedup import remove_repeats, repeated_spans, without_repeats
from corpusloom.llm.suffix_tree import score_texts
from tests.llm import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    return {r.doc_id: r.text for r in rows}


# --- chat --------------------------------------------------------------------


def test_escapes_are_reversible(spark):
    hard = ["\\", "<", '"', "\\l", "\\\\b<\\q", "</turn>\n", '<turn role="x">\n', "\\bl\\bq", ""]
    df = spark.createDataFrame([(h,) for h in hard], "t string")
    for r in df.select("t", escape(F.col("t")).alias("e"), unescape(escape(F.col("t"))).alias("u")).collect():
        assert r.u == r.t and "<" not in r.e and '"' not in r.e


def conversations():
    rng = random.Random(5)
    rows = []
    for c in range(30):
        n = rng.randint(1, 40)
        for t in range(n):
            role = "system" if t == 0 and c % 3 == 0 else rng.choice(["user", "assistant"])
            rows.append((c, t, role, " ".join(rng.choices(["</turn>", "a", "\\l", "né", '"', "x<y\n"], k=rng.choice([0, 3, 30, 200])))))
    rows += [(100, 0, None, None), (100, None, "assistant", "last"), (101, 5, "assistant", "same"), (101, 5, "assistant", "same")]
    rows += [(None, 0, "user", "no id"), (None, 1, "assistant", "none"), (102, 0, "system", "alone"), (103, 0, "assistant", "w " * 5000)]
    return rows


def test_windows_hold_every_turn_once(spark):
    rows = conversations()
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    windows = format_conversations(turns, budget=200, history=40).cache()
    for w in windows.collect():
        new = w.n_new - (1 if w.window_no == 0 and w.text.startswith('<turn role="system"') else 0)
        assert w.n_tokens <= 200 or (w.over_budget and new == 1)
    got = {r.conv_id: r for r in read_back(windows).collect()}
    key = lambda r: (r[1] is None, r[1] or 0, r[2] or "", r[3] or "")
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == conv), key=key)
        whole = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in mine)
        loss = "".join(r[3] or "" for r in mine if r[2] == "assistant")
        r = got[conv]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == (len(mine), brute.sha(whole), len(loss), brute.sha(loss))
    assert max(w.window_no for w in windows.collect()) > 3
    assert format_conversations(turns.limit(0)).collect() == []


def test_windows_keep_system_and_limited_history(spark):
    rows = [(1, 0, "system", "rules")] + [(1, t, ["user", "assistant"][t % 2], f"turn number {t} " * 5) for t in range(1, 60)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    windows = format_conversations(turns, budget=256, history=64)
    read = windows.select("window_no", "n_repeated", "n_new", read_turns(F.col("text")).alias("turns")).orderBy("window_no").collect()
    shown = 0
    for w in read:
        assert w.turns[0].role == "system" and len(w.turns) == w.n_repeated + w.n_new
        numbers = [int(t.text.split()[2]) for t in w.turns[1:]]
        assert numbers == list(range(numbers[0], numbers[-1] + 1))
        if w.window_no:
            assert 1 < w.n_repeated < 6
        shown += w.n_new
    assert shown == 60


# --- near duplicates -----------------------------------------------------------


def copies(rng, base, n, rate):
    words = base.split()
    return [" ".join(w if rng.random() > rate else f"e{rng.randint(0, 99)}" for w in words) for _ in range(n)]


def near_rows(rng):
    texts = []
    for g in range(12):
        base = " ".join(f"w{rng.randint(0, 400)}" for _ in range(rng.choice([6, 12, 40, 120])))
        texts += [base, base.upper(), *copies(rng, base, 8, rng.choice([0.0, 0.02, 0.05, 0.1]))]
    texts += [None, "", " \n ", "solo", "Solo", "a b", "b a", " ".join(f"u{i}" for i in range(3000)), " ".join(f"u{i}" for i in range(3005))]
    # a chain: neighbours are linked, the ends are not
    words = [f"c{i}" for i in range(60)]
    texts += [" ".join([f"x{i}" if i < k else w for i, w in enumerate(words)]) for k in range(0, 30, 3)]
    rng.shuffle(texts)
    return dict(enumerate(texts, 10))


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates(spark, size):
    rows = near_rows(random.Random(size))
    docs = spark.createDataFrame([(i, t, "k") for i, t in rows.items()], "doc_id long, text string, rep string")
    want = brute.near_components(rows, size)
    got = {r.doc_id: r for r in near_duplicates(docs, words=size).collect()}
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in got.items()} == {
        i: (len(brute.shingle_set(t, size)), want[i], want[i] == i) for i, t in rows.items()
    }
    left = drop_near_duplicates(docs, words=size)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == {i for i in rows if want[i] == i}


def test_near_duplicates_of_a_loose_group_in_small_blocks(spark, monkeypatch):
    """Edited copies of one text, some near enough to a few others only."""
    import corpusloom.llm.near_dedup as near_dedup

    monkeypatch.setattr(near_dedup, "BLOCK", 7)
    monkeypatch.setattr(near_dedup, "ROUNDS", 1)
    rng = random.Random(12)
    base = " ".join(f"w{rng.randint(0, 400)}" for _ in range(80))
    rows = dict(enumerate(copies(rng, base, 40, 0.04) + copies(rng, base, 40, 0.07) + copies(rng, base, 20, 0.12)))
    want = brute.near_components(rows, 2)
    assert 1 < len(set(want.values())) < 60
    docs = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_duplicates(docs, words=2).collect()}
    assert got == want


def test_near_duplicates_on_odd_tables(spark):
    long = " ".join(f"w{i}" for i in range(50))
    rows = [(None, long), (None, "other"), (3, long), (3, long), (5, long + " end"), (5, "quite different words in this text"), (9, "quite different words in this text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_duplicates(docs)
    ids = {r.doc_id: r.component_id for r in got.collect()}
    assert ids == {None: None, 3: 3, 5: 3, 9: 3} and got.count() == len(rows)
    assert near_duplicates(docs.limit(0)).collect() == []
    assert near_duplicates(docs.filter("doc_id is null")).filter("kept").count() == 2


def test_components(spark):
    rng = random.Random(6)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(150)] + [(i, i + 1) for i in range(1000, 1100)] + [(7, 7)]
    parent = {n: n for e in edges for n in e}

    def root(n):
        return n if parent[n] == n else root(parent[n])

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    got = {r.u: r.v for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {n: root(n) for n in parent if root(n) != n}
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


# --- fingerprints --------------------------------------------------------------


def test_edited_texts(spark, texts):
    rows = [(i, t, 1) for i, t in texts.items()] + [(5000, None, 1), (5001, "", 1), (None, "the end", 1), (5002, "ß🙂 é", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, body int")
    ordered = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    got = {r.doc_id: r for r in with_edited_text(docs).collect()}
    assert len(got) == len(rows)
    near = 0
    for (i, text, _), (_, after, _) in zip(ordered, ordered[1:] + ordered[:1]):
        text, after, r = text or "", after or "", got[i]
        half = len(text) // 2
        assert (r.n_chars, r.edited_sha256) == (len(text), brute.sha(text[: len(text) - half] + after[:half]))
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        near += r.near_edited > r.near_next
    assert near > 0.9 * len(rows)
    by_text = {}
    for i, text, _ in rows:
        assert by_text.setdefault(text or "", got[i].fingerprint) == got[i].fingerprint
    assert with_edited_text(docs.limit(0)).collect() == []
    assert with_edited_text(docs.limit(1)).count() == 1


def test_every_spot_has_its_chain(spark):
    texts = ["of the in the of a cat sat down now", "", "the the", "plain words here", "the end of", "A die, le x.y 7 – the Z of é"]
    rng = random.Random(9)
    texts += [" ".join(rng.choice(["the", "of", "der", "x", "y", "z", "w7"]) for _ in range(rng.randint(1, 60))) for _ in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in docs.select("doc_id", spot_signatures(F.col("text")).alias("sigs")).collect()}
    chains = set()
    for i, text in enumerate(texts):
        words = ["^", *re.findall(r"[^\W_]+", text.lower())]
        mine = set()
        for at, word in enumerate(words):
            after = [w for w in words[at + 1 :] if w not in ANCHORS][:3]
            if (at == 0 or word in ANCHORS) and after:
                mine.add(" ".join([word, *after]))
        assert len(got[i].sigs) == len(mine)
        chains |= {(i, c) for c in mine}
    hashed = spark.createDataFrame(list(chains), "doc_id long, chain string").groupBy("doc_id").agg(F.sort_array(F.collect_set(F.hash("chain"))).alias("sigs"))
    assert {r.doc_id: r.sigs for r in hashed.collect()} == {i: r.sigs for i, r in got.items() if r.sigs}


def test_likenesses_of_edited_texts(spark, texts):
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r for r in with_edited_text(docs).collect()}
    sets = {i: {r.fingerprint[k : k + 8] for k in range(0, len(r.fingerprint), 8)} for i, r in got.items()}
    ids = sorted(got, reverse=True)
    like = lambda a, b: 1.0 if a == b else len(a & b) / len(a | b)
    for i, after in zip(ids, ids[1:] + ids[:1]):
        r = got[i]
        edited = {r.edited_fingerprint[k : k + 8] for k in range(0, len(r.edited_fingerprint), 8)}
        assert r.near_next == pytest.approx(like(sets[i], sets[after])) and r.near_edited == pytest.approx(like(sets[i], edited))


def test_repeated_rows_are_neighbours(spark):
    docs = spark.createDataFrame([(1, "one and the same text here")] * 3, "doc_id long, text string")
    assert [r.near_next for r in with_edited_text(docs).collect()] == [1.0] * 3


def test_similar_pairs(spark, texts):
    rng = random.Random(7)
    rows = dict(list(texts.items())[:60])
    for k, text in enumerate(list(rows.values())[:20]):
        words = text.split()
        for _ in range(max(1, len(words) // 60)):
            words[rng.randrange(len(words))] = "edit"
        rows[1000 + k] = " ".join(words)
    docs = spark.createDataFrame(list(rows.items()) + [(2000, None), (None, "x y")], "doc_id long, text string")
    signed = docs.select("doc_id", spot_signatures(F.coalesce("text", F.lit(""))).alias("signatures")).cache()
    sets = {}
    for r in sorted(signed.filter("doc_id is not null").collect(), key=lambda r: r.doc_id):
        if r.signatures:
            sets.setdefault(tuple(r.signatures), r.doc_id)
    want = {}
    for a, i in sets.items():
        for b, j in sets.items():
            like = len(set(a) & set(b)) / len(set(a) | set(b))
            if i < j and like >= 0.6:
                want[i, j] = like
    got = {(r.left_id, r.right_id): r.likeness for r in similar_pairs(signed, at_least=0.6).collect()}
    assert got == pytest.approx(want) and want


# --- mixing --------------------------------------------------------------------


def test_mix(spark):
    rng = random.Random(8)
    rows = [(i, " ".join(["w"] * rng.choice([0, 1, 5, 50, 700])), rng.choice(["b", "a", "é", "Z", None]), 1, 2) for i in range(300)]
    rows += [(0, rows[0][1], rows[0][2], 1, 2), (None, "no id", "a", 1, 2), (1000, None, "only", 1, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, place int, mix_offset int")
    got = mix_sources(docs)
    assert set(docs.columns) <= set(got.columns)
    sizes = Counter()
    for _, text, source, *_ in rows:
        sizes[source] += len((text or "").split())
    want, taken = brute.targets(dict(sizes)), Counter()
    for r in got.collect():
        assert r.size == len((r.text or "").split()) and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source]) and 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[s] - want[s]) < 1 for s in sizes)
    again = mix_sources(docs.repartition(7)).select("doc_id", "size", "taken").collect()
    assert sorted(map(str, again)) == sorted(map(str, got.select("doc_id", "size", "taken").collect()))
    copies = mixed_documents(docs)
    assert copies.columns == docs.columns
    by_source = Counter()
    for r in copies.collect():
        by_source[r.source] += len(r.text.split())
    assert by_source == Counter({s: n for s, n in taken.items() if n})
    assert mix_sources(docs.limit(0)).collect() == [] and mixed_documents(docs.limit(0)).collect() == []


def test_the_mix_follows_the_schedule(spark, monkeypatch):
    """Documents come in the order of their slots, whatever the caller's columns are called; other points give another order."""
    from corpusloom.llm import mixing

    rng = random.Random(18)
    names = ("slice_start", "in_slice", "at_place", "key", "size", "taken", "copy", "slot", "row", "order")
    rows = [(i, " ".join(["w"] * rng.choice([1, 5, 50, 700])), rng.choice("abc"), *range(len(names))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join(f"{n} int" for n in names))
    got = mixing.mixed_documents(docs).collect()
    assert all(tuple(r)[3:] == tuple(range(len(names))) for r in got)
    kept = {n: i for i, n in enumerate(names) if n not in ("size", "taken")}
    slots = {r.doc_id: r.first_slot for r in mix_sources(docs).collect() if all(r[n] == i for n, i in kept.items())}
    seen, firsts = set(), []
    for r in got:
        if r.doc_id not in seen:
            firsts.append(slots[r.doc_id])
            seen.add(r.doc_id)
    assert firsts == sorted(firsts) and len(seen) == sum(s is not None for s in slots.values())
    early = Counter(r.source for r in got[: len(got) // 4])
    assert len(early) == 3  # sources are interleaved
    monkeypatch.setattr(mixing, "_point", lambda n: (n % 64) / 64.0)
    assert {r.doc_id: r.first_slot for r in mix_sources(docs).collect()} != slots


def test_slots_are_spread_evenly(spark):
    from corpusloom.llm.mixing import schedule

    plan = spark.createDataFrame([(0, 6400, 50), (1, 3200, 25), (2, 3200, 25)], "place int, words long, slots long")
    order = [r.place for r in schedule(plan, 128).filter("id is not null").orderBy("id").collect()]
    for n in range(10, len(order)):
        assert abs(order[:n].count(0) - n / 2) < 4


# --- language model ---------------------------------------------------------------


def test_scores(spark, texts):
    rows = [*texts.items(), (9000, None), (9001, ""), (None, "the"), (9002, "Of the zzz"), (9002, "Of the zzz")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    learn = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) != 2
    counts, tokens = Counter(), []
    for i, text in rows:
        words = brute.WORDS.findall(brute.lower(text or "")) + [None]
        held = i is None or zlib.crc32(str(i).encode()) % 7 == 2
        tokens.append((i, words, held))
        if not held:
            counts.update(words)
    total, distinct = sum(counts.values()), len(counts)
    got = {}
    for r in score_texts(docs, learn).collect():
        got.setdefault(r.doc_id, []).append(r)
    gain = 0
    for i, words, held in tokens:
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in words)
        for r in got[i]:
            assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, len(words), sum(counts[w] > 0 for w in words), total)
            assert r.base_score == pytest.approx(base)
            gain += (r.score - r.base_score) * held
    assert gain > 0
    assert score_texts(docs.limit(0), learn).collect() == []
    assert all(r.score == r.base_score for r in score_texts(docs.limit(3), F.lit(False)).collect())


def test_tree_chances_sum_to_one():
    import numpy as np

    from corpusloom.llm.suffix_tree import STRENGTH, Head, _context, _row_keys, row_keys_of_text

    root = np.array([0.5, 0.3, 0.2])
    ratio, rows = {(): np.ones(3)}, {}
    for context, after in {(0,): [10, 0, 20], (1,): [0, 7, 0], (0, 1): [0, 0, 5]}.items():
        n, shorter = np.array(after), ratio[context[1:]]
        number = _context(np.array([*context, 0]), len(context))
        ratio[context] = (n / root + STRENGTH * shorter) / (n.sum() + STRENGTH)
        rows[int(_row_keys(number, -1)[0])] = np.log(STRENGTH / (n.sum() + STRENGTH))
        for s in np.flatnonzero(n):
            rows[int(_row_keys(number, s)[0])] = np.log1p(n[s] / (root[s] * STRENGTH * shorter[s]))
    keys = np.array(sorted(rows), np.uint64)
    starts = np.append(np.searchsorted(keys, np.arange(4, dtype=np.uint64) << np.uint64(62)), len(keys))
    head = Head(keys, np.array([rows[int(k)] for k in keys]), starts, 62, None)
    gain = lambda text: head.gains(row_keys_of_text(np.array(text)))[0]
    for history, state in (((), ()), ((0,), (0,)), ((1,), (1,)), ((0, 1), (0, 1)), ((2, 1), (1,)), ((1, 2), ())):
        got = np.exp([gain([*history, s]) - (gain([*history]) if history else 0) for s in range(3)])
        assert got == pytest.approx(ratio[state])
        assert (got * root).sum() == pytest.approx(1)


def test_texts_ask_only_behind_kept_contexts():
    import numpy as np

    from corpusloom.llm.suffix_tree import FILTER_BITS, Head, _bits_of, _context, _row_keys, row_keys_of_text

    key = lambda context, symbol: _row_keys(_context(np.array([*context, 0]), len(context)), symbol)
    here = {(0,): 0.5, (0, 1): 0.25, (2,): 1.0}
    rows = {int(key(c, -1)[0]): v for c, v in here.items()} | {int(key((0,), 1)[0]): 2.0}
    keys = np.array(sorted(rows), np.uint64)
    starts = np.append(np.searchsorted(keys, np.arange(4, dtype=np.uint64) << np.uint64(62)), len(keys))
    elsewhere = np.zeros((2, 1 << (FILTER_BITS - 6)), np.int64)
    away = {1: [key((0, 1), 3), key((1, 3), 4)], 0: [key((3, 4), -1)]}  # context (1, 3) is kept nowhere
    for kind, found in away.items():
        for k in found:
            word, bits = _bits_of(k)
            elsewhere[kind, word] |= bits
    head = Head(keys, np.array([rows[int(k)] for k in keys]), starts, 62, elsewhere)
    texts = [np.array(t, np.int32) for t in ([0, 1, 3, 4, 0], [5], [2, 2], [], [0, 1, 3])]
    gain, owner, asked = head.gains_of_texts(texts)
    wanted = [head.gains(row_keys_of_text(t.astype(np.int64)))[0] if len(t) else 0 for t in texts]
    assert gain == pytest.approx(wanted) and wanted[0] == pytest.approx(2.75)
    want = [(0, int(away[1][0][0])), (0, int(away[0][0][0])), (4, int(away[1][0][0]))]
    assert sorted(zip(owner.tolist(), asked.tolist())) == sorted(want)


def test_packed_columns_keep_their_rows():
    import numpy as np
    import pyarrow as pa

    from corpusloom.llm.suffix_tree import _dealt, _unpacked

    values = np.random.default_rng(3).integers(-(1 << 62), 1 << 62, 1000)
    for parts in (1, 7, 70_000):
        numbers, sizes, packed = _dealt(values % parts, parts, values, values[::-1])
        table = pa.table({"size": sizes, "packed": pa.array(packed, pa.binary())})
        got = [(k, x, y) for k, (a, b) in zip(numbers, _unpacked(table, 2)) for x, y in zip(a.tolist(), b.tolist())]
        assert sorted(got) == sorted(zip((values % parts).tolist(), values.tolist(), values[::-1].tolist()))
    assert _dealt(values[:0], 5, values[:0]) == ([], [], [])


def test_packed_symbols_are_small():
    import numpy as np
    import pyarrow as pa

    from corpusloom.llm.suffix_tree import _dealt

    rng = np.random.default_rng(4)
    first, last = (np.minimum(rng.zipf(1.3, 50_000), 80_000) for _ in range(2))
    order = np.lexsort((last, first))
    columns = first[order], last[order], np.ones(50_000, np.int64)
    plain = len(pa.compress(b"".join(c.tobytes() for c in columns), codec="zstd", asbytes=True))
    _, _, packed = _dealt(np.zeros(50_000, np.int64), 1, *columns)
    assert len(packed[0]) < 0.8 * plain


def test_parts_give_back_groups_of_texts(spark):
    import numpy as np

    from corpusloom.llm.suffix_tree import FILTER_BITS, Head, _context, _row_keys, _sums, _unpacked

    rng = np.random.default_rng(5)
    texts = [rng.integers(0, 20, 60).astype(np.int32) for _ in range(300)]
    context = np.arange(20)
    rest = {int(k): 1.0 + i for i, k in enumerate(_row_keys(context, -1).view(np.int64))}
    nothing = np.empty(0, np.uint64)
    everywhere = np.full((2, 1 << (FILTER_BITS - 6)), -1, np.int64)
    head = spark.sparkContext.broadcast(Head(nothing, np.empty(0), np.zeros(3, np.int32), 63, everywhere))
    rows = spark.createDataFrame([(i, t.tobytes()) for i, t in enumerate(texts)], "row long, symbols binary")
    others = spark.createDataFrame(list(rest.items()), "key long, delta double")
    sums = _sums(rows, head, others, 6, 4).toArrow()
    assert sums.num_rows <= 6 * 4  # not one row for each text and part
    got = Counter()
    for row, gain in _unpacked(sums, 2):
        for i, g in zip(row.tolist(), gain.view(np.float64).tolist()):
            got[i] += g
    assert [got[i] for i in range(300)] == [sum(rest[int(k)] for k in _row_keys(_context(t.astype(np.int64), 1), -1).view(np.int64)) for t in texts]


def test_tables_of_the_tree_are_dropped(spark, texts):
    import glob

    from corpusloom.runtime import checkpoint_dir

    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, folder = spark.conf.get(key), checkpoint_dir(spark).removeprefix("file:")
    there = set(glob.glob(f"{folder}/tree-*"))
    docs = spark.createDataFrame(sorted(texts.items())[:20], "doc_id long, text string")
    scored = score_texts(docs, F.lit(True))
    assert len(set(glob.glob(f"{folder}/tree-*")) - there) == 3  # texts, what rare words add, gains
    assert scored.count() == 20 and spark.conf.get(key) == before


def word_of(key, classes=512):
    data = key + b" "
    return (data[0] * 37 + data[1]) % classes


def tree_scores(rows, symbol_count, context_count, pair_count, gain, strength=20.0):
    """Score of each (text, learn), from plain counts."""
    coded = [[w.encode() for w in brute.WORDS.findall(brute.lower(t))] + [None] for t, _ in rows]
    counts = Counter(w for c, (_, learn) in zip(coded, rows) for w in c if learn)
    base = sum(counts.values()) + len(counts) + 1
    symbol = lambda w: w if w is None or counts[w] >= symbol_count else word_of(w)
    mass = Counter({k: 1 for k in range(512)})
    for w, n in counts.items():
        mass[symbol(w)] += n + 1
    root = {s: n / base for s, n in mass.items()}
    strings = [[symbol(w) for w in c] for c in coded]
    tree = {}

    def ratio(context, s, longest):
        r = 1.0
        for d in range(1, min(longest, len(context)) + 1):
            if found := tree.get(context[-d:]):
                total, after = found
                left = total - sum(after.values())
                r = (after.get(s, 0) / root[s] + (strength + left) * r) / (total + strength)
        return r

    for d in (1, 2):
        behind = {}
        for c, (_, learn) in zip(strings, rows):
            for i in range(d, len(c) * learn):
                behind.setdefault(tuple(c[i - d : i]), Counter())[c[i]] += 1
        for context, after in behind.items():
            total = sum(after.values())
            shorter = {s: root[s] * ratio(context, s, d - 1) for s in after}
            mixed = {s: (n + strength * shorter[s]) / (total + strength) for s, n in after.items()}
            if total >= context_count and total * sum(m * math.log(m / shorter[s]) for s, m in mixed.items()) >= gain:
                tree[context] = total, {s: n for s, n in after.items() if n >= pair_count}
    scores = []
    for c, words in zip(strings, coded):
        score = sum(math.log10((counts[w] + 1) / base) for w in words)
        scores.append(score + sum(math.log10(ratio(tuple(c[max(i - 2, 0) : i]), s, 2)) for i, s in enumerate(c)))
    return scores, tree


@pytest.mark.parametrize("head, known, lookup", [(2_000_000, 1 / 2_000_000, 1_000_000), (60, 1 / 2_000_000, 0), (1, 1 / 300, 0)])
def test_scores_of_all_counts(spark, texts, monkeypatch, head, known, lookup):
    from corpusloom.llm import suffix_tree

    for name, value in {"HEAD_ROWS": head, "KNOWN_SHARE": known, "LOOKUP_ROWS": lookup, "SYMBOL_COUNT": 20, "CONTEXT_COUNT": 30}.items():
        monkeypatch.setattr(suffix_tree, name, value)
    rows = [(i, t or "", i % 5 > 0) for i, t in sorted(texts.items())[:80]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, learn boolean")
    wanted, tree = tree_scores([r[1:] for r in rows], 20, 30, suffix_tree.PAIR_COUNT, suffix_tree.GAIN)
    assert {len(c) for c in tree} == {1, 2}
    got = {r.doc_id: r.score for r in score_texts(docs, F.col("learn")).collect()}
    assert [got[r[0]] for r in rows] == pytest.approx(wanted)


# --- repeated strings --------------------------------------------------------------


def repeat_rows(texts):
    rng = random.Random(9)
    shared = "".join(rng.choice("abcdé fgh") for _ in range(160))
    rows = dict(texts)
    more = [None, "", "a" * 99, "a" * 100, "a" * 350, "xy" * 300 + "a" * 120, "q" + shared, shared + "zz" + shared, "é" * 400, shared[:37] * 6, shared[3:40] * 5 + "u", "b" * 3000]
    rows.update({5000 + i: t for i, t in enumerate(more)})
    return rows


def test_without_repeats(spark, texts):
    rows = repeat_rows(texts)
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows.items()], "doc_id long, text string, kept int")
    want = dict(zip(sorted(rows), brute.without_repeats([rows[i] for i in sorted(rows)])))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in without_repeats(docs).collect()}
    assert got == want
    cleaned = remove_repeats(docs)
    assert cleaned.columns == docs.columns
    for r in cleaned.collect():
        assert (r.text or "").encode() == want[r.doc_id][3].decode(errors="ignore").encode()


def test_hot_anchors_give_the_same_spans(spark, texts):
    rows = repeat_rows(texts)
    docs = spark.createDataFrame([(i, t) for i, t in rows.items()], "doc long, text string")

    def windows(df):
        from corpusloom.llm.suffix_dedup import _place

        return {(r.doc, s + k) for r in df.collect() for s, n in [_place(r.place)] for k in range(n)}

    assert windows(repeated_spans(docs, hot_runs=1)) == windows(repeated_spans(docs))


def test_repeats_on_odd_tables(spark):
    text = "".join(random.Random(10).choices("abcdefgh ", k=300))
    docs = spark.createDataFrame([(1, text), (1, text), (None, text), (2, text)], "doc_id long, text string")
    got = sorted((r.doc_id or 99, r.n_removed) for r in without_repeats(docs).collect())
    assert got == [(1, 0), (1, 0), (2, 300), (99, 300)]
    assert without_repeats(docs.limit(0)).collect() == []


def test_texts_of_one_id_are_kept_apart(spark):
    rng = random.Random(12)
    words = lambda n: "".join(rng.choices("abcdefgh ", k=n))
    shared = words(300)
    rows = [(1, shared), (2, shared), (2, words(306)), (2, words(400)), (None, words(250)), (None, shared + "x"), (3, words(200))]
    docs = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(rows)], "doc_id long, text string, doc_number long").repartition(4)
    got = {r.doc_number: (r.doc_id, r.n_removed, bytes(r.kept).decode()) for r in without_repeats(docs).collect()}
    for n, (i, t) in enumerate(rows):
        copy = n and shared in t
        assert got[n] == (i, 300 if copy else 0, t.replace(shared, "") if copy else t)


def test_later_windows():
    import numpy as np

    rng = random.Random(11)
    for _ in range(150):
        size, letters = rng.choice([1, 2, 3, 5, 8]), rng.choice([b"a", b"ab", b"abc"])
        pieces = [bytes(rng.choice(letters) for _ in range(size + rng.randint(0, 12))) for _ in range(rng.randint(1, 8))]
        owner, place = np.array([rng.randint(0, 3) for _ in pieces]), np.arange(len(pieces)) * 100
        seen, want = set(), []
        for a, b, w in sorted((owner[i], place[i] + k, p[k : k + size]) for i, p in enumerate(pieces) for k in range(len(p) - size + 1)):
            want += [(a, b)] if w in seen else []
            seen.add(w)
        owners, places = later_windows(pieces, owner, place, size)
        assert sorted(zip(owners.tolist(), places.tolist())) == sorted(want)


def test_suffix_order_by_packed_keys():
    import numpy as np

    from corpusloom.llm.bwt import stable_order, suffix_order

    rng = random.Random(13)
    for most in (1, 5, 1 << 40, (1 << 62) - 1):  # the last does not fit beside its places
        key = np.array([rng.choice([0, most, rng.randint(0, most)]) for _ in range(500)], np.int64)
        assert (stable_order(key, most) == np.argsort(key, kind="stable")).all()
    for letters in (range(1, 3), range(1, 257), [1, 256], range(90, 120)):
        pieces = [[rng.choice(list(letters)) for _ in range(rng.randint(0, 40))] for _ in range(30)]
        pieces += pieces[:5]
        symbols = np.array([x for p in pieces for x in [*p, 0]], np.uint16)
        left = np.array([k for p in pieces for k in range(len(p) + 1, 0, -1)])
        tails = [tuple(symbols[i : i + n]) for i, n in enumerate(left)]
        assert suffix_order(symbols, left).tolist() == sorted(range(len(tails)), key=lambda i: (tails[i], i))
    owners, places = later_windows([b"abc", b"xyz"], np.array([1, 2]), np.array([0, 0]), 3)
    assert len(owners) == len(places) == 0


# --- queries -----------------------------------------------------------------------


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))

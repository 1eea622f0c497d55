"""Registered queries without a SQL twin, run whole on the smallest tables and worked out again in plain Python."""

import math
import re
import zlib
from collections import Counter

import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry_module
from corpusloom.llm.queries import TRICKY, tokenizer_path
from tests.llm.brute import lower, sha

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def run(spark):
    registered = entry_module.queries()
    return lambda name: registered[name](spark, SF).collect()


@pytest.fixture(scope="module")
def texts():
    table = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pydict()
    return dict(zip(table["doc_id"], (t or "" for t in table["text"])))


def test_chat_format(run):
    table = pq.read_table(f"{SF}/conversations.parquet", columns=["conv_id", "turn", "role", "text"]).to_pylist()
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"] or "") for r in table]
    rows += [(-7, 0, "user", TRICKY), (-7, 1, "assistant", TRICKY)]
    turns = {}
    for conv_id, _, role, text in sorted(rows):
        turns.setdefault(conv_id, []).append((role, text))
    got = {r["conv_id"]: r for r in run("op1_chat_format")}
    assert set(got) == set(turns)
    for conv_id, mine in turns.items():
        learnt = "".join(text for role, text in mine if role == "assistant")
        r = got[conv_id]
        want = (len(mine), sha("".join(f"{role}\n{text}\n" for role, text in mine)), len(learnt), sha(learnt))
        assert (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) == want
        assert r["formatted_chars"] >= sum(len(text) for _, text in mine)
    assert got[-7]["loss_sha256"] == sha("\\### Assistant: </turn> ok")


def test_token_counts(run, texts):
    library = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    want = {i: len(library.encode(t, add_special_tokens=False).ids) for i, t in texts.items()}
    got = run("op2_token_counts")
    assert {r["doc_id"]: r["n_tokens"] for r in got} == want and len(got) == len(texts)
    assert all(r["n_bytes"] == len(texts[r["doc_id"]].encode()) and r["over_limit"] == (r["n_tokens"] > 1024) for r in got)


def test_spotsigs(run, texts):
    ids = sorted(texts)
    got = {r["doc_id"]: r for r in run("op4_spotsigs")}
    assert sorted(got) == ids
    prints = {}
    for i, following in zip(ids[::-1], [*ids[-2::-1], ids[-1]]):
        r, text, other = got[i], texts[i], texts[following]
        half = len(text) // 2
        edited = text[: len(text) - half] + other[:half]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), sha(edited))
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        for whole, fingerprint in ((text, r["fingerprint"]), (edited, r["edited_fingerprint"])):
            assert prints.setdefault(whole, fingerprint) == fingerprint
        assert edited != text or r["near_edited"] == 1
        assert other != text or r["near_next"] == 1


def test_bpe_round_trip(run, texts):
    library = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    library.no_truncation()
    library.no_padding()
    got = {r["doc_id"]: r for r in run("op6_bpe_round_trip")}
    assert set(got) == set(texts)
    for i, text in texts.items():
        ids = library.encode(text, add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want = (len(ids), sha(" ".join(map(str, ids))), sha(decoded))
        assert (got[i]["n_tokens"], got[i]["ids_sha256"], got[i]["decoded_sha256"]) == want


def test_lm_scores(run, texts):
    tokens = {i: [*re.findall(r"[^\x20\x09-\x0D]+", lower(t)), None] for i, t in texts.items()}
    held_out = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    counts = Counter(t for i, mine in tokens.items() if not held_out[i] for t in mine)
    total, distinct = sum(counts.values()), len(counts)
    got = {r["doc_id"]: r for r in run("op7_lm_scores")}
    assert set(got) == set(texts)
    gains = []
    for i, mine in tokens.items():
        r = got[i]
        known = sum(counts[t] > 0 for t in mine)
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held_out[i], len(mine), known, total)
        base = math.fsum(math.log10((counts[t] + 1) / (total + 1 * (distinct + 1))) for t in mine)
        assert r["base_score"] == pytest.approx(base, rel=1e-9) and r["score"] < 0
        gains.append(r["score"] - r["base_score"] if held_out[i] else 0.0)
    assert sum(gains) > 0  # contexts help on texts that were not learnt from


def test_quality_classifier(run, texts):
    got = {r["doc_id"]: r for r in run("op8_quality_classifier")}
    assert set(got) == set(texts)
    assert all(0 <= r[c] <= 1 for r in got.values() for c in ("quality_score", "content_score", "metadata_score"))
    by_text = {}
    for i, r in got.items():
        by_text.setdefault(texts[i], set()).add(round(r["content_score"], 9))
    assert all(len(scores) == 1 for scores in by_text.values())
    assert 0 < sum(r["accepted"] for r in got.values()) < len(got)

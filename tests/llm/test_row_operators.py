"""Token counts, BPE, quality rules, classifier: operators on single rows."""

import random

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from corpusloom.llm.bpe import PrefixEncoder, encode_texts, with_bpe_digests
from corpusloom.llm.classifier import classify, co_train, content_features, metadata_features, Rows
from corpusloom.llm.queries import tokenizer_path
from corpusloom.llm.quality_rules import host_verdicts, quality_rules, with_rule_counts
from corpusloom.llm.token_counts import TokenCounter, count_tokens, merge_symbols, prove_whole_tokens, read_model
from tests.llm.brute import rule_counts, sha

TEXTS = [
    None,
    "",
    " ",
    "Hello<|endoftext|> world <|startoftext|>x <|endoftext",
    "Σίσυφος ΣΑΣ İstanbul ﬁ é İ ẞ",
    "日本語テキスト 𝒳𝒴 Ṭ0 😀😀 ' 's 'S don't WE'LL",
    "a b c\x1c\x1dd\x85e\xa0 \n\n  tab\t\tend  ",
    "x" * 3000 + "ab" * 2000 + "!!" * 1000,
    "12345 ٣٤ Ⅷ ²½",
    "՘࢏ \U00010940 \U0001e6c0",
    "</w> <w> w</w> the the",
    "The quick brown fox. " * 500,
]
DOCS = "doc_id long, text string, n_tokens string, source string"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "old", "s") for i, t in enumerate(TEXTS)] + [(None, "twice told", "old", None)] * 2
    return spark.createDataFrame(rows, DOCS)


def real_texts(spark):
    return [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]


def test_token_counts_match_the_library(spark, docs):
    path = tokenizer_path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    got = count_tokens(docs, path)
    assert got.columns == ["doc_id", "text", "n_tokens", "source", "n_bytes", "over_limit"]
    rows = got.collect()
    assert len(rows) == len(TEXTS) + 2
    for r in rows:
        want = len(library.encode(r.text or "", add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((r.text or "").encode()), want, want > 1024)
    counter = TokenCounter(path, prove_whole_tokens(path))
    texts = real_texts(spark)
    assert [counter.count(t) for t in texts] == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert count_tokens(docs.limit(0), path).collect() == []


def test_whole_tokens_are_single_tokens():
    path = tokenizer_path("byte_bpe_50k.json")
    library, whole = Tokenizer.from_file(path), sorted(prove_whole_tokens(path))
    assert len(whole) > 49_000
    for text in random.Random(1).sample(whole, 500):
        if len(library.pre_tokenizer.pre_tokenize_str(text)) == 1:
            assert len(library.encode(text, add_special_tokens=False).ids) == 1


def test_scan_and_heap_merge_alike():
    _, ranks, _ = read_model(tokenizer_path("byte_bpe_50k.json"))
    rng = random.Random(2)
    for _ in range(200):
        symbols = [rng.choice("theraoin") for _ in range(rng.randint(1, 64))]
        padded = symbols + ["\x01"] * 70  # long enough for the heap; the padding never merges
        assert merge_symbols(padded, ranks)[: -70] == merge_symbols(symbols, ranks)


def test_bpe_matches_the_library(spark, docs):
    path = tokenizer_path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    for r in with_bpe_digests(docs, path).collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(" ".join(map(str, ids))), sha(decoded))
    for r in encode_texts(docs, path).collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert (r.token_ids, r.decoded) == (ids, library.decode(ids, skip_special_tokens=False))
    coder, texts = PrefixEncoder(path), real_texts(spark)
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        assert coder.encode(text) == " ".join(map(str, want.ids))
    assert with_bpe_digests(docs.limit(0), path).collect() == []


def test_rule_counts(spark, docs):
    more = ["a b c d e " * 3, "p q\np q\n \n\nr s", "#*$%&|<>", "one two three four five six seven eight nine ten eleven"]
    rows = docs.select("doc_id", "text", "source").unionByName(
        spark.createDataFrame([(100 + i, t, "h") for i, t in enumerate(more)], "doc_id long, text string, source string")
    )
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    for r in with_rule_counts(rows).collect():
        assert tuple(r[n] for n in names) == rule_counts(r.text), r.text


def test_host_verdicts(spark):
    rows = [("good", False)] * 95 + [("good", True)] * 5 + [("bad", True)] * 90 + [("bad", False)] * 10 + [(None, True)]
    judged = spark.createDataFrame(rows, "source string, base_failed boolean")
    verdicts = {r.source: r for r in host_verdicts(judged).collect()}
    assert verdicts["good"].host_kept and not verdicts["bad"].host_kept
    # one failure says little: the lone host is drawn to the mean of all
    assert verdicts[None].host_rate < 1
    assert 0.05 < verdicts["good"].host_rate < 0.1


def test_quality_rules_on_tables(spark):
    good = "one two three four five six seven eight nine ten eleven"
    rows = [(i, good, "a", 1) for i in range(30)] + [(100 + i, "bad", "b", 1) for i in range(30)] + [(200, good, "b", 1), (300, None, None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, kept int")
    result = quality_rules(docs)
    kept = {r.doc_id: r.kept for r in result.collect()}
    assert all(kept[i] for i in range(30)) and not kept[200] and not kept[300]
    assert result.count() == len(rows)
    assert quality_rules(docs.limit(0)).collect() == []


def labelled_rows(n):
    rng = random.Random(3)
    words = [f"w{rng.randint(0, 999)}x" for _ in range(300)]
    docs, labels = [], []
    for i in range(n):
        text = " ".join(rng.choices(words, k=60))
        quality, toxic = int(rng.random() > 0.25), int(rng.random() < 0.2)
        if toxic:
            text = f"vile {text} rotten"
        if not quality:
            text = text.upper().replace(" ", "!! ")
        docs.append((i, text, "en", f"src{i % 4}", "x"))
        labels.append((i, quality, toxic))
    return docs, labels


def test_classifier_on_held_out_rows(spark):
    rows, labels = labelled_rows(900)
    docs = spark.createDataFrame(rows + [(5000, None, None, None, "x"), (None, "", "en", "src0", "x")], "doc_id long, text string, lang string, source string, accepted string")
    known = spark.createDataFrame(labels[:600] + [(1, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    result = classify(docs, known)
    accepted = {r.doc_id: r.accepted for r in result.collect()}
    assert result.count() == len(rows) + 2
    right = [accepted[i] == (q == 1 and t == 0) for i, q, t in labels[600:]]
    assert sum(right) / len(right) > 0.95
    assert classify(docs.limit(0), known).collect() == []
    with pytest.raises(ValueError):
        classify(docs, known.limit(0))


def test_classifier_is_steady_and_bounded(spark):
    rows, labels = labelled_rows(300)
    docs = spark.createDataFrame([r[:4] for r in rows], "doc_id long, text string, lang string, source string")
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    one = {r.doc_id: r.quality_score for r in classify(docs, known, labelled=100, unlabelled=50).collect()}
    two = {r.doc_id: r.quality_score for r in classify(docs.repartition(5), known, labelled=100, unlabelled=50).collect()}
    assert one == two


def test_views_teach_each_other():
    rng = random.Random(4)
    parts, target = [[], []], []
    for _ in range(400):
        good = rng.random() < 0.5
        target.append(float(good))
        parts[0].append(content_features(("fine " if good else "poor ") + f"n{rng.randint(0, 50)}"))
        parts[1].append(metadata_features(("fine.org" if good else "poor.org",), "x"))
    views = [Rows.of(p) for p in parts]
    import numpy as np

    known, rest = np.arange(40), np.arange(40, 400)
    model = co_train([v.take(known) for v in views], np.array(target)[known], [v.take(rest) for v in views])
    whole, _ = model.score([v.take(rest) for v in views])
    assert ((whole > 0.5) == (np.array(target)[rest] > 0.5)).mean() > 0.98


def test_all_unlabelled_documents_teach(spark):
    import numpy as np

    from corpusloom.llm import classifier

    rows = [(i, f"w{i % 7} x{i % 11}", f"s{i % 3}") for i in range(7000)] + [(5, "other", "s0"), (6500, "other", "s0"), (None, "a", "s1"), (None, "a", "s1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    known = spark.createDataFrame([(i, i % 2, 0) for i in range(-50, 40)], "doc_id long, quality int, toxic int")
    with_label, without = classifier.samples(docs, known, "doc_id", "text", F.struct("source"), labelled=30)
    assert sorted(r.sample_id for r in with_label.collect()) == sorted({r.sample_id for r in with_label.collect()} & set(range(40)))
    assert with_label.count() == 30
    parts = without.toArrow()
    assert sorted(parts.column("sample_id").to_pylist(), key=lambda i: i or -1) == [None, None, *range(40, 7000)]
    rng = np.random.default_rng(1)
    views, scales = [rng.normal(size=n + 1) * 3 for n in classifier.SIZES], [np.array([1.0, 0.0])] * 2
    counts = classifier._taught(without)(views, scales)
    assert (counts == classifier.sure_counts(classifier._rows_of(parts), views, scales)).all()
    assert counts[classifier.SIZES[0]] + counts[2 * classifier.SIZES[0] + 1] > 0


def test_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b", "s", 5, 6)], "doc_id long, text string, source string, n_words int, salt int")
    row = quality_rules(docs).collect()[0]
    assert (row.n_words, row.salt) == (2, 6)

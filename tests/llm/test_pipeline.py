"""Every stage of the pipeline against its input, on the smallest tables."""

import hashlib

import pytest

import corpus_pipeline
from corpusloom.llm.queries import tokenizer_path
from tests.llm import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """The documents and what each stage makes of them, each written and read again."""
    folder = tmp_path_factory.mktemp("stages")
    docs = [spark.read.parquet(f"{SF}/documents.parquet")]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs[-1], SF).write.parquet(str(folder / str(number)))
        docs.append(spark.read.parquet(str(folder / str(number))))
    return docs


def rows(df):
    return {r.doc_id: r.asDict() for r in df.collect()}


def test_columns_stay_and_every_stage_keeps_rows(tables):
    for before, after in zip(tables[:4], tables[1:5]):
        assert after.columns == before.columns and after.count() > 0
    assert len(corpus_pipeline.STAGES) == 5


def test_accepted_documents_are_unchanged(tables):
    before, after = rows(tables[0]), rows(tables[1])
    assert len(after) > 0.5 * len(before) and all(before[i] == r for i, r in after.items())


def test_one_document_of_each_group_stays(tables):
    before, after = rows(tables[1]), rows(tables[2])
    groups = brute.near_components({i: r["text"] for i, r in before.items()}, 5)
    assert after == {i: r for i, r in before.items() if groups[i] == i}


def test_repeated_strings_go(tables):
    before, after = rows(tables[2]), rows(tables[3])
    ids = sorted(before)
    kept = brute.without_repeats([before[i]["text"] for i in ids])
    for i, (_, removed, _, left) in zip(ids, kept):
        assert after[i]["text"] == (left.decode(errors="ignore") if removed else before[i]["text"])


def test_sources_are_near_their_targets(tables):
    before, mixed = rows(tables[3]), tables[4].collect()
    words = lambda text: len(brute.WORDS.findall(text or ""))
    sizes, taken = {}, {}
    for r in before.values():
        sizes[r["source"]] = sizes.get(r["source"], 0) + words(r["text"])
    for r in mixed:
        assert r.doc_id in before
        taken[r.source] = taken.get(r.source, 0) + words(r.text)
    largest = max(words(r["text"]) for r in before.values())
    for source, target in brute.targets(sizes).items():
        assert abs(taken.get(source, 0) - target) <= largest + 1


def test_coded_texts_are_those_of_the_library(tables):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    library.no_truncation()
    want = []
    for r in tables[4].collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        want.append((r.doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()))
    assert sorted((r.doc_id, r.n_tokens, r.ids_sha256) for r in tables[5].collect()) == sorted(want)

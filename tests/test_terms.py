import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from corpusloom.operators import norm_index as N
from corpusloom.operators import range_finder
from corpusloom.operators import search as S
from corpusloom.operators import terms as T
from corpusloom.operators.lsa import lsa
from corpusloom.operators.range_finder import randomised_lsa

DOCS = [
    (0, "Apple apple apple banana banana BANANA banana the the the"),
    (1, "apple apple apple apple cat cat cat"),
    (2, "banana banana dog dog dog"),
    (3, ""),
    (4, "elk"),
]
LN2, LN5 = math.log(2), math.log(5)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id long, content string")


def _by_term(tdm, vocab):
    return {(r["doc_id"], r["term"]): r["weight"] for r in tdm.join(vocab, "term_id").collect()}


def test_counts(docs):
    got = {(r["doc_id"], r["term"]): r["cnt"] for r in T.term_counts(docs).collect()}
    assert got == {(0, "apple"): 3, (0, "banana"): 4, (1, "apple"): 4, (1, "cat"): 3, (2, "dog"): 3}


def test_weights(docs):
    got = _by_term(*T.build_tdm(docs))
    want = {
        (0, "apple"): 1.25 * LN2, (0, "banana"): 1.5 * LN5, (1, "apple"): 1.5 * LN2,
        (1, "cat"): 1.25 * LN5, (2, "dog"): 1.5 * LN5,
    }
    assert got == pytest.approx(want)


def test_exact_idf_and_augmented_tf(docs):
    got = _by_term(*T.build_tdm(docs, idf="exact"))
    assert got[(0, "apple")] == pytest.approx(1.25 * math.log(2.5))
    got = _by_term(*T.build_tdm(docs, tf="augmented"))
    assert got[(0, "apple")] == pytest.approx((0.5 + 0.5 * 3 / 4) * LN2)


def test_maximum_counts_vocabulary_terms_only(docs):
    # two terms kept: apple (7) and banana (4); ties go by term
    got = _by_term(*T.build_tdm(docs, vocab_size=1))
    assert set(got) == {(0, "apple"), (1, "apple")}
    assert got[(0, "apple")] == pytest.approx(1.5 * LN2)


@pytest.mark.parametrize(
    "k, query, expected",
    [
        (2, "apple", [1.10982684, 0.53130087, 0, 0, 0]),
        (2, "apple cat", [1.89335606, 0.9063952, 0, 0, 0]),
        (300, "apple", [0.86643398, 1.03972077, 0, 0, 0]),
        (300, "APPLE cat nothere", [0.86643398, 3.05151816, 0, 0, 0]),
    ],
)
def test_lsa_scores(spark, docs, k, query, expected):
    tdm, vocab = T.build_tdm(docs)
    doc_factors, term_factors = lsa(tdm, vocab, docs, k)
    terms = S.query_terms(spark, query, vocab)
    got = {r["doc_id"]: r["relevance"] for r in S.lsa_relevance(doc_factors, term_factors, terms).collect()}
    assert [got[i] for i in range(5)] == pytest.approx(expected, abs=1e-6)


def test_unknown_query(spark, docs):
    tdm, vocab = T.build_tdm(docs)
    terms = S.query_terms(spark, "zzz", vocab)
    assert S.tfidf_relevance(docs, tdm, terms).count() == 0
    doc_factors, term_factors = lsa(tdm, vocab, docs, 2)
    assert S.lsa_relevance(doc_factors, term_factors, terms).count() == 0
    assert [r["word"] for r in S.unknown_words(terms).collect()] == ["zzz"]


def test_results_follow_the_page_rank(spark):
    relevance = spark.createDataFrame([(1, 0.5), (2, 0.9), (3, 0.9), (4, 0.1)], "doc_id long, relevance double")
    ranks = spark.createDataFrame([(0, 3), (1, 1)], "rank long, page_id long")
    titles = spark.createDataFrame([(1, "one"), (2, "two")], "page_id long, title string")
    found = S.in_rank_order(S.most_relevant(relevance, 3), ranks, titles)
    assert [tuple(r) for r in found.collect()] == [(0, None, 0.9), (1, "one", 0.5)]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="abAB é\t\n.'\xa0", max_size=60), min_size=1, max_size=8))
def test_counts_agree_with_plain_counting(spark, texts):
    rows = [(i, t) for i, t in enumerate(texts)]
    got = T.term_counts(spark.createDataFrame(rows, "doc_id long, content string"), (), 1, 2).collect()
    want = {(i, w): n for i, t in rows for w, n in Counter(t.lower().split()).items() if n > 1}
    assert {(r["doc_id"], r["term"]): r["cnt"] for r in got} == want


def test_lsa_queries_take_the_whole_vocabulary(spark):
    from catalog import terms

    sf = "/root/testdata/sf0.001"
    vocab, doc_factors, term_factors = terms._factors(spark, sf)
    n_terms, n_docs = terms.term_totals(spark, sf).count(), terms.contents(spark, sf).count()
    assert n_terms > terms.VOCAB
    assert vocab.count() == term_factors.count() == min(n_terms, 30_000)
    assert doc_factors.count() == n_docs
    assert 20 < len(term_factors.first().v) <= 300


def _vectors(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, us array<double>")


@pytest.fixture(scope="module")
def factors(spark):

    random = np.random.default_rng(5)
    lengths = 2.0 ** random.uniform(-8, 4, 600)
    vectors = random.normal(size=(600, 6))
    vectors *= (lengths / np.linalg.norm(vectors, axis=1))[:, None]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    rows += [(600 + i, rows[i][1]) for i in range(40)]  # ties, by id
    return _vectors(spark, rows + [(900, [0.0] * 6), (901, None)])


@pytest.fixture(scope="module")
def asked(spark):
    terms = spark.createDataFrame([(0, "a", 0), (1, "b", 2), (2, "b", 2), (3, "zzz", None)], "pos int, word string, term_id long")
    vectors = [(0, [1.0, -2.0, 0.5, 0.0, 1.0, 3.0]), (1, [9.0] * 6), (2, [0.0, 1.0, 1.0, -1.0, 0.25, 0.0])]
    return spark.createDataFrame(vectors, "term_id long, v array<double>"), terms


@pytest.mark.parametrize("count, first", [(1, 1), (25, 25), (60, 100), (640, 10), (1000, 1)])
def test_search_by_norm_is_a_full_scan(spark, tmp_path, factors, asked, count, first):
    N.write_norm_index(factors, str(tmp_path))
    got = N.best_documents(spark, str(tmp_path), *asked, count, first).collect()
    want = S.most_relevant(S.lsa_relevance(factors.filter("us IS NOT NULL"), *asked), count).collect()
    assert got == want and len(got) == min(count, 641)


def test_search_by_norm_leaves_short_documents_unread(spark, tmp_path, factors, asked, monkeypatch):
    N.write_norm_index(factors, str(tmp_path))
    read = []
    products = N.factor_products
    monkeypatch.setattr(N, "factor_products", lambda part, q: read.append(part.count()) or products(part, q))
    N.best_documents(spark, str(tmp_path), *asked, 5, 5)
    assert sum(read) < 200


def test_search_by_norm_without_documents_or_words(spark, tmp_path, factors, asked):
    N.write_norm_index(factors.limit(0), str(tmp_path))
    assert N.best_documents(spark, str(tmp_path), *asked).count() == 0
    N.write_norm_index(factors, str(tmp_path))
    unknown = asked[1].filter("term_id IS NULL")
    assert N.best_documents(spark, str(tmp_path), asked[0], unknown).count() == 0
    assert N.best_documents(spark, str(tmp_path), *asked, 0).count() == 0


def test_steps_grow_and_cover_every_band():
    bands = [(band, 10, 2.0 ** (band / 4)) for band in range(-20, 20)] + [(N.EMPTY_BAND, 3, 0.0)]
    cut = N.steps(bands, 10, 2)
    assert cut[0][:2] == (19, 19) and cut[1][:2] == (18, 17) and cut[-1][1] == N.EMPTY_BAND
    assert all(a[1] > b[0] for a, b in zip(cut, cut[1:]))
    assert N.steps([], 10) == []


def test_range_finder_in_small_blocks(spark):
    """A matrix of many blocks with a falling spectrum, an empty document and an unused term."""
    rng = np.random.default_rng(3)
    left, right = np.linalg.qr(rng.normal(size=(60, 12)))[0], np.linalg.qr(rng.normal(size=(45, 12)))[0]
    whole = left * 0.5 ** np.arange(12) @ right.T
    whole[7], whole[:, 9] = 0, 0
    cells = [(int(i) * 3, int(j), float(whole[i, j])) for i, j in zip(*np.nonzero(whole))]
    tdm = spark.createDataFrame(cells, "doc_id long, term_id long, weight double")
    ids = spark.createDataFrame([(i * 3,) for i in range(60)], "doc_id long")
    vocab = spark.createDataFrame([(f"t{j}", j) for j in range(45)], "term string, term_id long")
    docs, terms = randomised_lsa(tdm, vocab, ids, 5, extra=4, powers=2, docs=9, terms=10, fan=2)
    us = np.array([r.us for r in sorted(docs.collect())])
    v = np.array([r.v for r in sorted(terms.collect())])
    u, sizes, vt = np.linalg.svd(whole)
    best = u[:, :5] * sizes[:5] @ vt[:5]
    assert us.shape == (60, 5) and v.shape == (45, 5) and not us[7].any() and not v[9].any()
    assert np.abs(us @ v.T - best).max() < 1e-6 and np.abs(v.T @ v - np.eye(5)).max() < 1e-9
    assert np.linalg.norm(us, axis=0) == pytest.approx(sizes[:5], rel=1e-6)


def test_range_finder_on_odd_tables(spark, docs):
    tdm, vocab = T.build_tdm(docs)
    none = randomised_lsa(tdm.limit(0), vocab, docs, 2)
    assert none[0].count() == docs.count() and none[1].count() == vocab.count()
    assert randomised_lsa(tdm.limit(0), vocab, docs.limit(0), 2)[0].count() == 0


def test_dense_blocks_reach_workers_in_small_batches(spark):
    def sizes(batches):
        for batch in batches:
            size = np.array([float(batch.num_rows)])
            yield pa.RecordBatch.from_pydict({"number": [0], "part": [0], "data": pa.array([size.tobytes()], pa.binary())})

    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    parts = spark.range(100).coalesce(1).mapInArrow(sizes, range_finder._PART)
    largest = range_finder._folded(parts, 8, 7, lambda found: np.max(found, axis=0)).first()["data"]
    assert np.frombuffer(largest)[0] == 7 and spark.conf.get(key) == before

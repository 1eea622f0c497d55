"""Term-document matrix, LSA and search queries over ``documents``."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.common import rank_rounds_sql, spread_table, sql_list, table
from corpusloom.fixed_values import TERM_STOPWORDS, UNICODE_SPACE
from corpusloom.operators import graph as G
from corpusloom.operators import search as S
from corpusloom.operators import terms as T
from corpusloom.operators.lsa import lsa
from corpusloom.operators.norm_index import best_documents, read_norm_index, write_norm_index
from corpusloom.operators.pagerank import pagerank_vector, rank_pages
from corpusloom.operators.range_finder import randomised_lsa
from corpusloom.runtime import scratch_path

QUERIES, ORACLES = {}, {}
VOCAB = 500
NO_STOPWORDS = ()


def query(name, sql=None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def contents(spark, sf):
    return spread_table(spark, sf, "documents").select("doc_id", F.col("text").alias("content"))


def _counts_sql(stop):
    not_stop = f"AND term NOT IN ({sql_list(stop)})" if stop else ""
    return f"""counts AS (SELECT doc_id, term, count(*) AS cnt FROM (
        SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[{UNICODE_SPACE}]+')) AS term FROM documents)
      WHERE length(term) > 2 {not_stop} GROUP BY doc_id, term HAVING count(*) > 2)"""


def _tdm_sql(stop=NO_STOPWORDS, size=VOCAB, idf="floor", tf="half_plus"):
    ratio = "(SELECT count(*) FROM documents) // df" if idf == "floor" else "(SELECT count(*) FROM documents)::DOUBLE / df"
    share = "cnt::DOUBLE / max(cnt) OVER (PARTITION BY doc_id)"
    frequency = f"0.5 + {share}" if tf == "half_plus" else f"0.5 + 0.5 * {share}"
    return f"""{_counts_sql(stop)},
    top AS (SELECT term, sum(cnt)::BIGINT AS total, count(*) AS df FROM counts GROUP BY term
            ORDER BY total DESC, term LIMIT {size}),
    vocab AS (SELECT term, row_number() OVER (ORDER BY term) - 1 AS term_id, df, ln({ratio}) AS idf FROM top),
    tdm AS (SELECT doc_id, term_id, ({frequency}) * idf AS weight FROM counts JOIN vocab USING (term))"""


def _asked_sql(words):
    return "asked AS (SELECT unnest([" + sql_list(words) + "]) AS word)"


def _relevance_sql(words):
    return f"""{_asked_sql(words)},
    relevance AS (SELECT d.doc_id, coalesce(s.r, 0) AS relevance FROM documents d LEFT JOIN
      (SELECT doc_id, sum(weight) AS r FROM tdm JOIN vocab USING (term_id) JOIN asked ON asked.word = vocab.term GROUP BY doc_id) s
      USING (doc_id))"""


@query("term_counts", f"WITH {_counts_sql(TERM_STOPWORDS)} SELECT doc_id, term, cnt FROM counts")
def term_counts(spark, sf):
    return T.term_counts(contents(spark, sf))


@query("term_counts_all", f"WITH {_counts_sql(())} SELECT doc_id, term, cnt FROM counts")
def term_counts_all(spark, sf):
    return T.term_counts(contents(spark, sf), stopwords=NO_STOPWORDS)


@query("term_totals", f"WITH {_counts_sql(())} SELECT term, sum(cnt)::BIGINT AS total FROM counts GROUP BY term")
def term_totals(spark, sf):
    return T.term_totals(T.term_counts(contents(spark, sf), stopwords=NO_STOPWORDS))


@query("doc_freq", f"WITH {_counts_sql(())} SELECT term, count(*) AS df FROM counts GROUP BY term")
def doc_freq(spark, sf):
    return T.document_frequency(T.term_counts(contents(spark, sf), stopwords=NO_STOPWORDS))


@query("document_count", "SELECT count(*) AS n_docs FROM documents")
def document_count(spark, sf):
    return contents(spark, sf).agg(F.count(F.lit(1)).alias("n_docs"))


@query("top_vocab", f"WITH {_tdm_sql()} SELECT term, total, df FROM top")
def top_vocab(spark, sf):
    return T.top_vocabulary(T.term_counts(contents(spark, sf), stopwords=NO_STOPWORDS), VOCAB)


def _counts_and_vocab(spark, sf, idf="floor"):
    docs = contents(spark, sf)
    counts = T.term_counts(docs, stopwords=NO_STOPWORDS)
    return counts, T.vocabulary(counts, docs.count(), VOCAB, idf)


@query("vocabulary", f"WITH {_tdm_sql()} SELECT term, term_id, df, round(idf, 9) AS idf FROM vocab")
def vocabulary(spark, sf):
    return _counts_and_vocab(spark, sf)[1].withColumn("idf", F.round("idf", 9))


@query(
    "doc_max_count",
    f"WITH {_tdm_sql()} SELECT doc_id, max(cnt) AS max_cnt FROM counts JOIN vocab USING (term) GROUP BY doc_id",
)
def doc_max_count(spark, sf):
    counts, vocab = _counts_and_vocab(spark, sf)
    return T.max_counts(counts, vocab, VOCAB)


@query("tdm_weights", f"WITH {_tdm_sql()} SELECT doc_id, term_id, round(weight, 9) AS weight FROM tdm")
def tdm_weights(spark, sf):
    tdm, _ = T.build_tdm(contents(spark, sf), VOCAB, stopwords=NO_STOPWORDS)
    return tdm.withColumn("weight", F.round("weight", 9))


@query(
    "tdm_exact_augmented",
    f"WITH {_tdm_sql(TERM_STOPWORDS, VOCAB, 'exact', 'augmented')} SELECT doc_id, term_id, round(weight, 9) AS weight FROM tdm",
)
def tdm_exact_augmented(spark, sf):
    tdm, _ = T.build_tdm(contents(spark, sf), VOCAB, idf="exact", tf="augmented")
    return tdm.withColumn("weight", F.round("weight", 9))


@query(
    "query_terms",
    f"WITH {_tdm_sql()}, {_asked_sql(['that', 'zzzunknown', 'with', 'that'])}, "
    "placed AS (SELECT row_number() OVER () - 1 AS pos, word FROM asked) "
    "SELECT pos::INTEGER AS pos, word, term_id FROM placed LEFT JOIN vocab ON placed.word = vocab.term",
)
def query_terms(spark, sf):
    _, vocab = _counts_and_vocab(spark, sf)
    return S.query_terms(spark, "that ZZZunknown with THAT", vocab)


@query(
    "query_unknown_words",
    f"WITH {_tdm_sql()}, {_asked_sql(['that', 'zzzunknown', 'with'])} SELECT word FROM asked "
    "WHERE word NOT IN (SELECT term FROM vocab)",
)
def query_unknown_words(spark, sf):
    _, vocab = _counts_and_vocab(spark, sf)
    return S.unknown_words(S.query_terms(spark, "that ZZZunknown with", vocab))


@query(
    "search_tfidf",
    f"WITH {_tdm_sql()}, {_relevance_sql(['that', 'with'])} "
    "SELECT doc_id, round(relevance, 8) AS relevance FROM relevance ORDER BY round(relevance, 8) DESC, doc_id LIMIT 25",
)
def search_tfidf(spark, sf):
    return S.most_relevant(_tfidf_relevance(spark, sf, "that with"))


@query(
    "search_tfidf_all",
    f"WITH {_tdm_sql()}, {_relevance_sql(['that', 'with', 'that'])} SELECT doc_id, round(relevance, 8) AS relevance FROM relevance",
)
def search_tfidf_all(spark, sf):
    return _tfidf_relevance(spark, sf, "that with that")


@query(
    "search_nothing_known",
    "SELECT doc_id, 0.0::DOUBLE AS relevance FROM documents WHERE false",
)
def search_nothing_known(spark, sf):
    return _tfidf_relevance(spark, sf, "zzzunknown")


def _tfidf_relevance(spark, sf, text):
    docs = contents(spark, sf)
    tdm, vocab = T.build_tdm(docs, VOCAB, stopwords=NO_STOPWORDS)
    scored = S.tfidf_relevance(docs, tdm, S.query_terms(spark, text, vocab))
    return scored.withColumn("relevance", F.round("relevance", 8))


# Every document links to the first document of its source: a graph over the documents
# themselves, so that ranks and relevance meet on the same ids.
def document_links(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source", "lang")
    first = docs.groupBy("source").agg(F.min("doc_id").alias("dst"))
    return docs.join(first, "source").select(F.col("doc_id").alias("src"), "dst")


_HUB_SQL = """
edges AS (SELECT d.doc_id AS src, f.dst FROM documents d JOIN
    (SELECT source, min(doc_id) AS dst FROM documents GROUP BY source) f USING (source)),
trans AS (SELECT dst, src, 1.0::DOUBLE / count(*) OVER (PARTITION BY src) AS p FROM edges),
vec AS (SELECT doc_id AS id, 1.0::DOUBLE / (SELECT count(*) FROM documents) AS p FROM documents)
"""


def _ranks(spark, sf, rounds=5):
    edge_rows = G.edges(document_links(spark, sf))
    vector = G.uniform_vector(table(spark, sf, "documents").select(F.col("doc_id").alias("id")))
    ranked = pagerank_vector(G.transition_matrix(edge_rows), vector, epsilon=0.0, max_iter=rounds)
    return rank_pages(ranked.withColumn("p", F.round("p", 12)))


def _titles(spark, sf):
    return table(spark, sf, "documents").select(
        F.col("doc_id").alias("page_id"), F.concat_ws(" ", "source", F.col("doc_id").cast("string")).alias("title")
    )


def _ranked_search_sql():
    return f"""WITH {_tdm_sql()}, {_relevance_sql(['that', 'with'])}, {_HUB_SQL}, {rank_rounds_sql(5)},
    ranked AS (SELECT row_number() OVER (ORDER BY round(p, 12) DESC, id) - 1 AS page_rank, id FROM r5),
    best AS (SELECT doc_id, round(relevance, 8) AS relevance FROM relevance
             ORDER BY round(relevance, 8) DESC, doc_id LIMIT 25)
    SELECT page_rank, source || ' ' || doc_id AS title, relevance
    FROM best JOIN ranked ON best.doc_id = ranked.id JOIN documents USING (doc_id)"""


@query("ranked_search", _ranked_search_sql())
def ranked_search(spark, sf):
    relevant = S.most_relevant(_tfidf_relevance(spark, sf, "that with"))
    return S.in_rank_order(relevant, _ranks(spark, sf), _titles(spark, sf))


def _factors(spark, sf):
    docs = contents(spark, sf)
    tdm, vocab = T.build_tdm(docs, stopwords=NO_STOPWORDS)  # 30,000 terms and rank 300, as the operators' own
    return vocab, *lsa(tdm, vocab, docs)


@query("lsa_factors")
def lsa_factors(spark, sf):
    _, doc_factors, _ = _factors(spark, sf)
    length = F.aggregate("us", F.lit(0.0), lambda acc, x: acc + x * x)
    return doc_factors.select("doc_id", F.round(F.sqrt(length), 6).alias("norm"))


@query("search_lsa")
def search_lsa(spark, sf):
    vocab, doc_factors, term_factors = _factors(spark, sf)
    found = S.search(spark, "that with", vocab, doc_factors, term_factors, _ranks(spark, sf), _titles(spark, sf))
    return found.withColumn("relevance", F.round("relevance", 6))


# At full rank the factors give back the matrix, so relevance equals the summed weights.
@query(
    "lsa_full_rank",
    f"WITH {_tdm_sql(NO_STOPWORDS, 200)}, {_relevance_sql(['that', 'with'])} SELECT doc_id, round(relevance, 6) AS relevance FROM relevance",
)
def lsa_full_rank(spark, sf):
    docs = contents(spark, sf)
    tdm, vocab = T.build_tdm(docs, 200, stopwords=NO_STOPWORDS)
    doc_factors, term_factors = lsa(tdm, vocab, docs, k=200)
    scored = S.lsa_relevance(doc_factors, term_factors, S.query_terms(spark, "that with", vocab))
    return scored.select("doc_id", (F.round(F.round("relevance", 6) + 0.0, 6)).alias("relevance"))


# The cells of a nation are the outer product of five numbers and its customers' balances, and no
# other nation has these terms or documents: its one singular value is the product of both lengths. The
# nations' largest ten are the truncated spectrum, and a document has its length in its nation's factor.
_SPECTRUM = 10
_BLOCKS_SQL = """balances AS (SELECT c_custkey AS doc_id, c_nationkey AS block, abs(c_acctbal)::DOUBLE AS b FROM customer),
blocks AS (SELECT block, sqrt(sum(b * b)) * sqrt(55.0) AS sigma FROM balances GROUP BY block)"""


def _block_factors(spark, sf, decompose=lsa):
    customers = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("doc_id"), "c_nationkey", F.abs(F.col("c_acctbal").cast("double")).alias("b")
    )
    numbers = F.explode(F.sequence(F.lit(1), F.lit(5))).alias("u")  # their squares add up to 55
    cells = customers.select("doc_id", "c_nationkey", "b", numbers)
    cells = cells.select("doc_id", (F.col("c_nationkey") * 5 + F.col("u") - 1).cast("long").alias("term_id"), (F.col("b") * F.col("u")).alias("weight"))
    terms = table(spark, sf, "nation").select("n_nationkey", numbers)
    term = F.concat(F.lit("nation"), F.col("n_nationkey").cast("string"), F.lit("x"), F.col("u").cast("string")).alias("term")
    vocab = terms.select(term, (F.col("n_nationkey") * 5 + F.col("u") - 1).cast("long").alias("term_id"))
    return vocab, *decompose(cells, vocab, customers, k=_SPECTRUM)


_NORMS_SQL = (
    f"WITH {_BLOCKS_SQL} SELECT doc_id, round(CASE WHEN rank <= {_SPECTRUM} THEN b * sqrt(55.0) ELSE 0 END, 3) AS norm "
    "FROM balances JOIN (SELECT block, row_number() OVER (ORDER BY sigma DESC) AS rank FROM blocks) USING (block)"
)


def _norms(doc_factors):
    length = F.aggregate("us", F.lit(0.0), lambda acc, x: acc + x * x)
    return doc_factors.select("doc_id", F.round(F.sqrt(length), 3).alias("norm"))


@query("lsa_truncated", _NORMS_SQL)
def lsa_truncated(spark, sf):
    return _norms(_block_factors(spark, sf)[1])


@query("lsa_range_finder", _NORMS_SQL)
def lsa_range_finder(spark, sf):
    return _norms(_block_factors(spark, sf, randomised_lsa)[1])


# The third term of every nation is asked once, the fifth of nation 0 twice.
_ASKED = " ".join([f"nation{i}x3" for i in range(25)] + ["nation0x5", "nation0x5"])
_SCORED_SQL = f"""SELECT doc_id, round(CASE WHEN rank <= {_SPECTRUM} THEN b * CASE WHEN block = 0 THEN 13.0::DOUBLE ELSE 3 END ELSE 0 END, 3) AS relevance
FROM balances JOIN (SELECT block, row_number() OVER (ORDER BY sigma DESC) AS rank FROM blocks) USING (block)"""


@query(
    "search_truncated",
    f"WITH {_BLOCKS_SQL} {_SCORED_SQL}",
)
def search_truncated(spark, sf):
    return _scored(spark, *_block_factors(spark, sf))


@query(
    "search_range_finder",
    f"WITH {_BLOCKS_SQL} {_SCORED_SQL}",
)
def search_range_finder(spark, sf):
    return _scored(spark, *_block_factors(spark, sf, randomised_lsa))


def _scored(spark, vocab, doc_factors, term_factors):
    scored = S.lsa_relevance(doc_factors, term_factors, S.query_terms(spark, _ASKED, vocab))
    return scored.select("doc_id", (F.round("relevance", 3) + 0.0).alias("relevance"))


@query("norm_index", f"""WITH {_BLOCKS_SQL}, lengths AS (SELECT doc_id, CASE WHEN rank <= {_SPECTRUM} THEN b * sqrt(55.0) ELSE 0 END AS norm
FROM balances JOIN (SELECT block, row_number() OVER (ORDER BY sigma DESC) AS rank FROM blocks) USING (block))
SELECT count(*) AS n, round(max(norm), 3) AS longest FROM lengths WHERE norm > 1e-3 GROUP BY floor(log2(norm) * 4)""")
def norm_index(spark, sf):
    _, doc_factors, _ = _block_factors(spark, sf)
    path = scratch_path(spark, "norm-index")
    write_norm_index(doc_factors, path)
    stored = read_norm_index(spark, path).filter("norm > 1e-3")
    return stored.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.round(F.max("norm"), 3).alias("longest")).drop("band")


@query("search_by_norm", f"WITH {_BLOCKS_SQL}, scored AS ({_SCORED_SQL}) SELECT doc_id, relevance FROM scored ORDER BY relevance DESC, doc_id LIMIT 25")
def search_by_norm(spark, sf):
    vocab, doc_factors, term_factors = _block_factors(spark, sf)
    path = scratch_path(spark, "norm-index")
    write_norm_index(doc_factors, path)
    found = best_documents(spark, path, term_factors, S.query_terms(spark, _ASKED, vocab))
    return found.withColumn("relevance", F.round("relevance", 3))

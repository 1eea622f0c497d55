"""Page, link, lemma, source and sink queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.common import spread_table, sql_list, sql_text, table
from corpusloom.fixed_values import CONTENT_STOPWORDS, NOUN_ENDINGS
from corpusloom.functions.titles import page_url
from corpusloom.operators import abbreviations as A
from corpusloom.operators import graph as G
from corpusloom.operators import lemmas as L
from corpusloom.operators import links as K
from corpusloom.operators.expansion import expand_templates
from corpusloom.operators.pagerank import rank_pages
from corpusloom.operators.pages import article_filter
from corpusloom.operators.templates import load_templates
from corpusloom.plans.extract import clean_articles, extract_corpus
from corpusloom.plans.index import rank_and_search
from corpusloom.runtime import scratch_path
from corpusloom.sinks import tables as W
from corpusloom.sources import tables as R
from corpusloom.sources import wiki_xml as X

QUERIES, ORACLES = {}, {}


def query(name, sql=None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


# --- pages ---------------------------------------------------------------------


@query("page_title", "SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title FROM pages")
def page_title(spark, sf):
    return table(spark, sf, "pages").select("page_id", K.first_title(F.col("html")).alias("title"))


@query(
    "page_first_id",
    "SELECT page_id, CASE WHEN page_id % 7 = 0 OR page_id % 5 = 0 THEN 0 ELSE page_id END AS first_id FROM pages",
)
def page_first_id(spark, sf):
    """Of the ids of a page and its revision the first counts; pages without one, or with no number there, have 0."""
    own = F.when(F.col("page_id") % 7 == 0, F.lit("")).when(F.col("page_id") % 5 == 0, F.lit("<id>none</id>\n<id>8</id>\n"))
    own = own.otherwise(F.format_string("<id>%d</id>\n<revision>\n<id>9</id>\n</revision>\n", "page_id"))
    source = F.concat(F.lit("<page>\n"), own, "html", F.lit("\n</page>"))
    return table(spark, sf, "pages").select("page_id", K.first_id(source).alias("first_id"))


@query("page_text", "SELECT page_id, regexp_replace(html, '<[^>]*>', ' ', 'g') AS text FROM pages")
def page_text(spark, sf):
    return table(spark, sf, "pages").select("page_id", K.html_text(F.col("html")).alias("text"))


_LINKS_SQL = """links AS (SELECT DISTINCT page_id AS src, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS title FROM pages),
known AS (SELECT title, min(src) AS page_id FROM links GROUP BY title HAVING count(*) > 4)"""


@query("page_links", f"WITH {_LINKS_SQL} SELECT src, title FROM links")
def page_links(spark, sf):
    return K.extract_links(table(spark, sf, "pages"), "html")


def _known_pages(links):
    """Targets that several pages share, numbered by the first of them."""
    return (
        links.groupBy("title")
        .agg(F.min("src").alias("page_id"), F.count(F.lit(1)).alias("n"))
        .filter("n > 4")
        .select("page_id", "title")
    )


@query("link_resolve", f"WITH {_LINKS_SQL} SELECT DISTINCT src, page_id AS dst FROM links JOIN (SELECT title, max(page_id) AS page_id FROM known GROUP BY title) USING (title)")
def link_resolve(spark, sf):
    links = page_links(spark, sf)
    return K.resolve_links(links, _known_pages(links))


@query("link_unresolved", f"WITH {_LINKS_SQL} SELECT src, title FROM links WHERE title NOT IN (SELECT title FROM known)")
def link_unresolved(spark, sf):
    links = page_links(spark, sf)
    return K.unresolved_links(links, _known_pages(links))


_NORMAL_SQL = """bare AS (SELECT src, ltrim(title, '/') AS title FROM links),
normal AS (SELECT DISTINCT src, CASE title[1] WHEN 'ß' THEN 'SS' ELSE upper(title[1]) END || title[2:] AS title FROM bare),
pages_known AS (SELECT title, min(src) AS page_id FROM bare GROUP BY title HAVING count(*) > 4),
by_title AS (SELECT CASE title[1] WHEN 'ß' THEN 'SS' ELSE upper(title[1]) END || title[2:] AS title, max(page_id) AS dst FROM pages_known GROUP BY 1),
hops AS (SELECT CASE title[1] WHEN 'ß' THEN 'SS' ELSE upper(title[1]) END || title[2:] AS title, 'The' AS target FROM bare WHERE length(title) = 2 GROUP BY 1)"""


@query(
    "link_resolve_normalized",
    f"WITH {_LINKS_SQL}, {_NORMAL_SQL} SELECT DISTINCT src, dst FROM (SELECT src, coalesce(target, title) AS title FROM normal "
    "LEFT JOIN hops USING (title)) JOIN by_title USING (title)",
)
def link_resolve_normalized(spark, sf):
    bare = page_links(spark, sf).withColumn("title", F.ltrim(F.col("title"), F.lit("/")))
    sections = bare.withColumn("title", F.concat("title", F.lit("#part")))
    hops = bare.filter(F.length("title") == 2).select("title", F.lit("the").alias("target")).distinct()
    return K.resolve_links(sections, _known_pages(bare), normalize=True, redirects=hops)


# --- tokens and lemmas -----------------------------------------------------------

_TREEBANK_SQL = "regexp_replace(text, '\\s+', ' ', 'g') || ' '"
for _pattern, _replacement in L._TREEBANK:
    _TREEBANK_SQL = (
        f"regexp_replace({_TREEBANK_SQL}, {sql_text(_pattern)}, {sql_text(_replacement.replace('$', chr(92)))}, 'g')"
    )
_TOKENS_SQL = f"list_filter(regexp_split_to_array({_TREEBANK_SQL}, '\\s+'), lambda t: t <> '')"


@query("tokens", f"SELECT doc_id, array_to_string({_TOKENS_SQL}, ' ') AS tokens FROM documents")
def tokens(spark, sf):
    return spread_table(spark, sf, "documents").select("doc_id", F.array_join(L.tokenize(F.col("text")), " ").alias("tokens"))


# Words of one or two letters from b to h get a full stop behind them, so that the texts have abbreviations.
_STOPPED_SQL = r"stopped AS (SELECT doc_id, regexp_replace(text, '(^| )([b-hB-H][a-z]?) ', '\1\2. ', 'g') AS content FROM documents)"
_ABBREVIATIONS_SQL = rf"""{_STOPPED_SQL},
bare AS (SELECT regexp_replace(regexp_replace(lower(unnest(regexp_split_to_array(content, '\s+'))), '^[\[({{<''`"]+', ''), '[\])}}>''",;:!?]+$', '') AS w FROM stopped),
counted AS (SELECT regexp_replace(w, '\.$', '') AS form, count(*) FILTER (regexp_matches(w, '[^.]\.$')) AS with_stop,
    count(*) FILTER (NOT regexp_matches(w, '[^.]\.$')) AS without FROM bare
    WHERE regexp_matches(regexp_replace(w, '\.$', ''), '^\pL+(\.\pL+)*$') GROUP BY 1),
measured AS (SELECT *, least((SELECT sum(with_stop)::DOUBLE / sum(with_stop + without) FROM counted), 1 - 1e-12) AS p,
    length(replace(form, '.', '')) AS letters FROM counted WHERE with_stop >= 5),
abbreviated AS (SELECT form, with_stop, without, 2 * (with_stop * (ln(0.99::DOUBLE) - ln(p)) + without * (ln(1 - 0.99::DOUBLE) - ln(1 - p)))
    * exp(-letters) * (length(form) - letters + 1) * pow(letters, -without) AS score FROM measured)"""


def _stopped(spark, sf):
    content = F.regexp_replace("text", "(^| )([b-hB-H][a-z]?) ", "$1$2. ")
    return spread_table(spark, sf, "documents").select("doc_id", content.alias("content"))


@query("abbreviations", f"WITH {_ABBREVIATIONS_SQL} SELECT form, with_stop, without, round(score, 6) AS score FROM abbreviated WHERE score >= 0.3")
def abbreviations(spark, sf):
    return A.learn_abbreviations(_stopped(spark, sf)).withColumn("score", F.round("score", 6))


def _kept_stops_sql():
    at = L._TREEBANK.index(L._FINAL_STOP)
    before, after = L._TREEBANK[:at], L._TREEBANK[at + 1 :]

    def spaced(sql, rules):
        for pattern, replacement in rules:
            sql = f"regexp_replace({sql}, {sql_text(pattern)}, {sql_text(replacement.replace('$', chr(92)))}, 'g')"
        return sql

    words = f"string_split(rtrim({spaced(r"regexp_replace(content, '\s+', ' ', 'g') || ' '", before)}), ' ')"
    form = r"""regexp_replace(regexp_replace(lower(w), '^[\[({<''`"]+', ''), '\.$', '')"""
    stop = r"""regexp_matches(regexp_replace(lower(w), '^[\[({<''`"]+', ''), '[^.]\.$')"""
    pattern, replacement = L._FINAL_STOP
    cut = f"regexp_replace(w, {sql_text(pattern)}, {sql_text(replacement.replace('$', chr(92)))}, 'g')"
    kept = f"list_transform(words, lambda w, i: CASE WHEN i < len(words) AND {stop} AND list_contains(forms, {form}) THEN w ELSE {cut} END)"
    last = spaced(f"array_to_string({kept}, ' ') || ' '", after)
    return rf"""WITH {_ABBREVIATIONS_SQL},
    words AS (SELECT doc_id, {words} AS words, (SELECT coalesce(list(form), []) FROM abbreviated WHERE score >= 0.3) AS forms FROM stopped)
    SELECT doc_id, array_to_string(list_filter(regexp_split_to_array({last}, '\s+'), lambda t: t <> ''), ' ') AS tokens FROM words"""


@query("tokens_abbreviations", _kept_stops_sql())
def tokens_abbreviations(spark, sf):
    docs = _stopped(spark, sf)
    own = A.attach_abbreviations(docs, A.learn_abbreviations(docs))
    return own.select("doc_id", F.array_join(L.tokenize(F.col("content"), F.col("abbreviations")), " ").alias("tokens"))


_CONTENT_SQL = (
    f"list_filter(list_transform({_TOKENS_SQL}, lambda t: lower(t)), lambda t: t NOT IN ({sql_list(CONTENT_STOPWORDS)}))"
)


@query("stopword_filter", f"SELECT doc_id, array_to_string({_CONTENT_SQL}, ' ') AS tokens FROM documents")
def stopword_filter(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", F.array_join(L.content_tokens(F.col("text")), " ").alias("tokens")
    )


# The lexicon holds every word of the documents that some document also uses with an
# ending behind it, so that lemmas are found in the given text itself.
_WORDS_SQL = "words AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]{3,}')) AS w FROM documents)"
_FORMS_SQL = (
    "forms AS (SELECT w AS form, w AS lemma, 0 AS rule FROM words UNION ALL "
    + " UNION ALL ".join(
        f"SELECT a.w AS form, b.w AS lemma, {i} AS rule FROM words a JOIN words b ON ends_with(a.w, '{e}') AND b.w = a.w[:length(a.w) - {len(e)}] || '{r}'"
        for i, (e, r) in enumerate(NOUN_ENDINGS, start=1)
    )
    + "), lemma_of AS (SELECT form, arg_min(lemma, length(lemma) * 100 + rule) AS lemma FROM forms GROUP BY form)"
)


def _lexicon(spark, sf):
    found = F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{3,}"), F.lit(0)))
    return spread_table(spark, sf, "documents").select(found.alias("lemma")).distinct()


@query(
    "lemmas",
    f"""WITH {_WORDS_SQL}, {_FORMS_SQL}, toks AS (SELECT doc_id, {_CONTENT_SQL} AS ts FROM documents),
    each AS (SELECT doc_id, unnest(ts) AS t, generate_subscripts(ts, 1) AS i FROM toks)
    SELECT doc_id, string_agg(coalesce(lemma, t), ' ' ORDER BY i) AS content FROM each LEFT JOIN lemma_of ON form = t GROUP BY doc_id
    UNION ALL SELECT doc_id, '' AS content FROM toks WHERE len(ts) = 0""",
)
def lemmas(spark, sf):
    docs = spread_table(spark, sf, "documents").select("doc_id", F.col("text").alias("content"))
    return L.lemmatize(docs, _lexicon(spark, sf))


# --- sources and sinks -------------------------------------------------------------


def _xml_pages(spark, sf, *others):
    """The documents as one XML element each."""
    escaped = F.replace(F.replace(F.replace("text", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    redirect = F.when(F.col("lang") == "es", '\n  <redirect title="Other &amp; more" />').otherwise("")
    return spread_table(spark, sf, "documents").select(
        *others,
        F.concat(
            F.lit("  <page>\n    <title>"), "source", F.lit(" &amp; "), F.col("doc_id").cast("string"), F.lit("</title>\n    <ns>0</ns>\n    <id>"),
            F.col("doc_id").cast("string"), F.lit("</id>"), redirect, F.lit("\n    <revision>\n      <id>7</id>\n      <text xml:space=\"preserve\">"),
            escaped, F.lit("</text>\n    </revision>\n  </page>"),
        ).alias("value")
    )


def _dump(spark, sf):
    """A dump folder: the header in front of the first page of every part."""
    langs = table(spark, sf, "documents").groupBy("lang").count()
    names = langs.agg(
        F.sum("count").alias("n"),
        F.array_join(
            F.array_sort(F.collect_list(F.concat(F.lit('<namespace key="'), F.ascii("lang").cast("string"), F.lit('">'), "lang", F.lit("</namespace>")))), ""
        ).alias("names")
    )
    header = names.select(
        F.concat(
            F.lit("<mediawiki>\n<siteinfo><base>http://x.org/wiki/Main_Page</base><namespaces><namespace key=\"0\" />"),
            "names", F.lit('<namespace key="10">Template'), F.col("n").cast("string"), F.lit("</namespace></namespaces></siteinfo>"),
        ).alias("value")
    )
    path = scratch_path(spark, "dump")
    header.unionByName(_xml_pages(spark, sf)).write.text(path, compression="bzip2")
    return path


@query(
    "wiki_xml_pages",
    "SELECT doc_id AS page_id, source || ' & ' || doc_id AS title, 0::INTEGER AS ns, CASE WHEN lang = 'es' THEN 'Other & more' END AS redirect, "
    "text FROM documents",
)
def wiki_xml_pages(spark, sf):
    return X.read_wiki_dump(spark, _dump(spark, sf))


@query(
    "wiki_xml_malformed",
    "SELECT doc_id AS page_id, source || ' & ' || doc_id AS title, 0::INTEGER AS ns, CASE WHEN lang = 'es' THEN 'Other & more' END AS redirect, "
    "CASE WHEN lang IN ('de', 'es') THEN 'a & b <x ' ELSE '' END || text AS text FROM documents",
)
def wiki_xml_malformed(spark, sf):
    """Some pages are no well-formed XML: a bare & and an open < in their text; all have a second revision."""
    broken = F.regexp_replace("value", r"(<text[^>]*>)", "$1a & b <x ")
    mended = F.when(F.col("lang").isin("de", "es"), broken).otherwise(F.col("value"))
    later = "</revision>\n    <revision><id>8</id><text>later</text></revision>"
    second = F.replace(mended, F.lit("</revision>"), F.lit(later))
    pages = _xml_pages(spark, sf, "lang")
    path = scratch_path(spark, "dump")
    pages.select(second.alias("value")).write.text(path)
    return X.read_wiki_dump(spark, path)


@query(
    "siteinfo",
    "SELECT 'http://x.org/wiki' AS url_base, string_agg(name, ';' ORDER BY name) AS names FROM (SELECT DISTINCT ascii(lang) || '=' || lang AS name "
    "FROM documents UNION ALL SELECT '0=' UNION ALL SELECT '10=Template' || count(*) FROM documents)",
)
def siteinfo(spark, sf):
    named = F.transform("namespaces", lambda n: F.concat(n["key"].cast("string"), F.lit("="), n["name"]))
    info = X.read_siteinfo(spark, _dump(spark, sf))
    return info.select("url_base", F.array_join(F.array_sort(named), ";").alias("names"))


@query("template_namespace", "SELECT 'Template' || count(*) AS template_namespace FROM documents")
def template_namespace(spark, sf):
    return X.template_namespace(X.read_siteinfo(spark, _dump(spark, sf))).select("template_namespace")


@query(
    "dump_files",
    """SELECT doc_id AS page_id, source || ' & ' || doc_id AS title, CASE WHEN lang IN ('de', 'fr') THEN 'http://a.org/wiki' ELSE 'http://b.org/w' END
      || '?curid=' || doc_id AS url, text || ' [a ' || lang || '] (b ' || lang || ')' AS text FROM documents WHERE lang <> 'es'""",
)
def dump_files(spark, sf):
    """Two dumps read at once, each with its own base and its own name of the template namespace."""
    path = scratch_path(spark, "dumps")
    pages = _xml_pages(spark, sf, "lang").withColumn("value", F.replace("value", F.lit("</text>"), F.concat(F.lit(" {{sig a|"), "lang", F.lit("}} {{sig b|"), "lang", F.lit("}}</text>"))))
    dumps = [("a", "http://a.org/wiki/Main", "Vorlage", "[a {{{1}}}]", F.col("lang").isin("de", "fr")), ("b", "http://b.org/w/Main", "Template", "(b {{{1}}})", ~F.col("lang").isin("de", "fr"))]
    for name, base, namespace, body, mine in dumps:
        header = f'<siteinfo><base>{base}</base><namespaces><namespace key="10">{namespace}</namespace></namespaces></siteinfo>\n'
        page = f"<page><title>{namespace}:Sig {name}</title><ns>10</ns><id>-1</id><revision><text>{body}</text></revision></page>"
        rows = pages.filter(mine).select("value").unionByName(spark.range(1).select(F.lit(page).alias("value")))
        rows.select(F.concat(F.lit(header), "value")).write.text(f"{path}/{name}")
    read = X.with_siteinfo(X.read_wiki_dump(spark, f"{path}/*", with_file=True), X.read_siteinfo(spark, f"{path}/*"))
    namespace = F.col("template_namespace")
    articles = article_filter(read, template_namespace=namespace).withColumn("url", page_url(F.col("url_base"), F.col("page_id")))
    templates, redirects = load_templates(read, namespace)
    expanded = expand_templates(articles.select("page_id", "title", "url", "text"), templates, redirects, F.lit("2024-05-06").cast("timestamp"))
    return expanded.select("page_id", "title", "url", "text")


@query(
    "page_files",
    "SELECT row_number() OVER (ORDER BY source || ' & ' || doc_id) - 1 AS page_id, source || ' & ' || doc_id AS title, text FROM documents",
)
def page_files(spark, sf):
    path = scratch_path(spark, "files")
    W.write_page_files(_xml_pages(spark, sf), path)
    return X.read_page_files(spark, path)


@query("page_ids_file", "SELECT doc_id AS page_id, source || ' ' || lang || CASE WHEN lang = 'de' THEN ' \"q\" x' ELSE '' END AS title FROM documents")
def page_ids_file(spark, sf):
    path = scratch_path(spark, "page-ids")
    quoted = F.when(F.col("lang") == "de", ' "q" x').otherwise("")
    ids = table(spark, sf, "documents").select(
        F.col("doc_id").alias("page_id"), F.concat("source", F.lit(" "), "lang", quoted).alias("title")
    )
    W.write_page_ids(ids, path)
    return R.read_page_ids(spark, path)


def _number_links(spark, sf):
    """Links between part and supplier numbers, as the text files hold numbers only."""
    rows = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("src"), F.col("l_suppkey").alias("dst"))
    return G.edges(rows)


@query(
    "adjacency_parse",
    "SELECT src, string_agg(dst::VARCHAR, ' ' ORDER BY dst) AS dsts FROM (SELECT DISTINCT l_partkey AS src, l_suppkey AS dst FROM lineitem) "
    "GROUP BY src UNION ALL SELECT -1 - s_suppkey, '' FROM supplier",
)
def adjacency_parse(spark, sf):
    path = scratch_path(spark, "links")
    lonely = table(spark, sf, "supplier").select((-1 - F.col("s_suppkey")).alias("id"))
    W.write_page_links(G.adjacency(_number_links(spark, sf), lonely), path)
    return R.read_page_links(spark, path).select("src", F.array_join(F.col("dsts").cast("array<string>"), " ").alias("dsts"))


@query(
    "adjacency_parts",
    """WITH edges AS (SELECT DISTINCT l_partkey AS src, l_suppkey AS dst FROM lineitem),
    placed AS (SELECT *, (row_number() OVER (PARTITION BY src ORDER BY dst) - 1) // 3 AS part FROM edges)
    SELECT src, part, string_agg(dst::VARCHAR, ' ' ORDER BY dst) AS dsts FROM placed GROUP BY src, part""",
)
def adjacency_parts(spark, sf):
    """Neighbourhoods of more than three targets, cut into numbered parts."""
    return G.adjacency(_number_links(spark, sf), row_limit=3).select("src", "part", F.concat_ws(" ", F.col("dsts").cast("array<string>")).alias("dsts"))


@query("adjacency_edges", "SELECT DISTINCT l_partkey AS src, l_suppkey AS dst FROM lineitem")
def adjacency_edges(spark, sf):
    path = scratch_path(spark, "links")
    W.write_page_links(G.adjacency(_number_links(spark, sf), row_limit=3), path)
    return G.adjacency_edges(R.read_page_links(spark, path))


@query("contents_file", "SELECT doc_id, regexp_replace(text, '[\\r\\n]+', ' ', 'g') AS content FROM documents")
def contents_file(spark, sf):
    path = scratch_path(spark, "contents")
    W.write_contents(table(spark, sf, "documents").select("doc_id", F.col("text").alias("content")), path)
    return R.read_contents(spark, path)


@query(
    "transitions_file",
    "SELECT dst, src, round(1.0::DOUBLE / count(*) OVER (PARTITION BY src), 10) AS p FROM (SELECT DISTINCT l_partkey AS src, l_suppkey AS dst FROM lineitem)",
)
def transitions_file(spark, sf):
    path = scratch_path(spark, "matrix")
    W.write_transitions(G.transition_matrix(_number_links(spark, sf)), path)
    return R.read_transitions(spark, path).withColumn("p", F.round("p", 10))


@query("vector_file", "SELECT doc_id AS id, round(1.0::DOUBLE / (SELECT count(*) FROM documents), 10) AS p FROM documents")
def vector_file(spark, sf):
    path = scratch_path(spark, "vector")
    W.write_vector(G.uniform_vector(table(spark, sf, "documents").select(F.col("doc_id").alias("id"))), path)
    return R.read_vector(spark, path).withColumn("p", F.round("p", 10))


@query(
    "page_rank_file",
    "SELECT row_number() OVER (ORDER BY n_chars DESC, doc_id) - 1 AS rank, doc_id AS page_id, n_chars::DOUBLE AS score FROM documents",
)
def page_rank_file(spark, sf):
    path = scratch_path(spark, "ranks")
    scores = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("n_chars").cast("double").alias("p"))
    W.write_page_rank(rank_pages(scores), path)
    return R.read_page_rank(spark, path)


@query(
    "document_files",
    "SELECT doc_id, '<doc id=\"' || doc_id || '\" url=\"http://x.org/wiki?curid=' || doc_id || '\" title=\"' || source || '\">' || chr(10) "
    "|| source || chr(10) || chr(10) || text || chr(10) || '</doc>' || chr(10) AS written FROM documents",
)
def document_files(spark, sf):
    path = scratch_path(spark, "docs")
    docs = table(spark, sf, "documents")
    value = W.document_text(F.col("doc_id"), page_url("http://x.org/wiki", F.col("doc_id")), F.col("source"), F.col("text"))
    W.write_documents(docs.select("doc_id", value.alias("value")), path, compress=True, order=["doc_id"])
    back = spark.read.option("lineSep", "\n</doc>\n\n").text(path)
    number = F.regexp_extract("value", r'^<doc id="(\d+)"', 1).cast("long")
    return back.select(number.alias("doc_id"), F.concat("value", F.lit("\n</doc>\n")).alias("written"))


_FILE_LIMIT = 200 * 1024
_PACKED_SQL = """WITH RECURSIVE sized AS (
  SELECT row_number() OVER (ORDER BY doc_id) AS i, strlen(text) + 1 AS n FROM documents WHERE text IS NOT NULL),
packed AS (
  SELECT i, 0::BIGINT AS f, n AS held FROM sized WHERE i = 1
  UNION ALL
  SELECT s.i, CASE WHEN held + n > {limit} THEN f + 1 ELSE f END, CASE WHEN held + n > {limit} THEN n ELSE held + n END
  FROM packed p JOIN sized s ON s.i = p.i + 1),
files AS (SELECT f, count(*) AS documents, sum(n) AS bytes FROM packed JOIN sized USING (i) GROUP BY f)
SELECT 'A' || chr((65 + f // 100)::INT) AS folder, count(*) AS files, sum(documents)::BIGINT AS documents, sum(bytes)::BIGINT AS bytes,
  max(bytes)::BIGINT AS largest FROM files GROUP BY f // 100"""


@query("document_packing", _PACKED_SQL.format(limit=_FILE_LIMIT))
def document_packing(spark, sf):
    """Files, documents and bytes of every folder of packed documents."""
    docs = table(spark, sf, "documents").select("doc_id", F.col("text").alias("value"))
    packed = W.pack_documents(docs, _FILE_LIMIT, ["doc_id"]).groupBy("folder", "file")
    files = packed.agg(F.count(F.lit(1)).alias("documents"), F.sum(F.octet_length("value").cast("long") + 1).alias("bytes"))
    return files.groupBy("folder").agg(
        F.count(F.lit(1)).alias("files"), F.sum("documents").alias("documents"), F.sum("bytes").alias("bytes"), F.max("bytes").alias("largest")
    )


# --- end to end ----------------------------------------------------------------------


@query(
    "article_content",
    "SELECT source || ' ' || doc_id AS title, 'if x < 5 & y > 3 ' || source || 'es ' || lang || 's end' AS content FROM documents",
)
def article_content(spark, sf):
    """Text of cleaned pages: decoded brackets stay, the trail of a kept link stays on its word."""
    pages = table(spark, sf, "documents").select(
        F.col("doc_id").alias("page_id"),
        F.concat("source", F.lit(" "), F.col("doc_id").cast("string")).alias("title"),
        F.lit(None).cast("string").alias("redirect"),
        F.concat(F.lit("if x &lt; 5 &amp; y &gt; 3 [["), "source", F.lit("]]es [[hub|"), "lang", F.lit("]]s end")).alias("text"),
    )
    cleaned = clean_articles(pages)
    return cleaned.select("title", K.without_anchors(F.col("text")).alias("content"))


@query("corpus_search")
def corpus_search(spark, sf):
    """Pages made of the documents, linked by source name, extracted, ranked and searched."""
    docs = table(spark, sf, "documents")
    first = docs.groupBy("source").agg(F.min("doc_id").alias("hub"))
    pages = docs.join(first, "source").select(
        F.col("doc_id").alias("page_id"),
        F.concat("source", F.lit(" "), F.col("doc_id").cast("string")).alias("title"),
        F.lit(None).cast("string").alias("redirect"),
        F.concat("text", F.lit(" [["), "source", F.lit(" "), F.col("hub").cast("string"), F.lit("|hub]]")).alias("text"),
    )
    corpus = extract_corpus(pages, _lexicon(spark, sf))
    found = rank_and_search(spark, scratch_path(spark, "index"), "tion ment", corpus)
    return found.withColumn("relevance", F.round("relevance", 5))

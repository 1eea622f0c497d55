"""Markup cleaning queries.

The given texts hold no markup, so each query writes some into the whole of
``documents.text`` with plain regular expressions, the same on both sides, and
then cleans it.
"""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import functions as F

from catalog.common import sql_text, spread_table, table
from corpusloom.fixed_values import BEHAVIOUR_SWITCHES
from corpusloom.functions.entities import unescape
from corpusloom.functions.titles import normalize_title, page_url, template_title
from corpusloom.functions.text import lower_first, upper_first, url_quote, url_unquote
from corpusloom.operators import markup as M
from corpusloom.operators import sections as S
from corpusloom.operators.pages import article_filter

QUERIES, ORACLES = {}, {}


def query(name, sql=None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def spark_rules(column, rules):
    for pattern, replacement in rules:
        column = F.regexp_replace(column, pattern, replacement)
    return column


def sql_rules(expression, rules):
    for pattern, replacement in rules:
        replacement = replacement.replace("$", "\\")
        expression = f"regexp_replace({expression}, {sql_text(pattern)}, {sql_text(replacement)}, 'g')"
    return expression


def marked_documents(spark, sf, rules):
    docs = spread_table(spark, sf, "documents")
    return docs.select(F.col("doc_id").alias("page_id"), spark_rules(F.col("text"), rules).alias("text"))


def cleaning_query(name, rules, operator, cleaned_by=None, sql_expression=None):
    """A query that marks up every document and applies one operator."""
    marked = sql_rules("text", rules)
    result = sql_expression(marked) if sql_expression else sql_rules(marked, cleaned_by or [])

    @query(name, f"SELECT doc_id AS page_id, {result} AS text FROM documents")
    def run(spark, sf):
        return marked_documents(spark, sf, rules).withColumn("text", operator(F.col("text")))

    return run


TABLE_RULES = [(r"\. ([A-Z][a-z]+) ([a-z]+)", r". {| $1 {| inner |} {| $2 {| deep |} |} cell |} $2")]
NESTED_TABLE = (r"\{\|[^{}]*\|\}", "")
cleaning_query("clean_tables", TABLE_RULES, M.drop_tables, [NESTED_TABLE] * 3)

TEMPLATE_RULES = [(r"\. ([A-Z][a-z]+) ([a-z]+)", r". {{cite|$1 {{lang|{{x}}}} {{ $2 }} }} $2 {{a}}")]
NESTED_TEMPLATE = (r"\{\{[^{}]*\}\}", "")
cleaning_query("drop_nested", TEMPLATE_RULES, M.drop_templates, [NESTED_TEMPLATE] * 3)

EXTERNAL_RULES = [
    (r" (the|le|der|el) ([a-z]+)", r" $1 [http://$2.org/$1 x-$2 site]"),
    (r" (and|et|und|y) ([a-z]+)", r" $1 [//$2.org/$1 x-$2 label]"),
    (r" (of|de|von) ([a-z]+)", r" $1 [mailto:$2 $2] [//$2 https://a.org/b/$2.png]"),
]
cleaning_query(
    "clean_external_links",
    EXTERNAL_RULES,
    M.replace_external_links,
    [
        (r"\[(?:http:|mailto:)[^\]\s]+ [^\]]*\]", ""),
        (r"\[//[^\]\s]+ https://[^\]\s]*\.png\]", ""),
        (r"\[//[^\]\s]+ ([^\]]*)\]", r"$1"),
    ],
)
cleaning_query(
    "clean_external_labels",
    EXTERNAL_RULES,
    lambda c: M.replace_external_links(c, keep_labels=True),
    [
        (r"\[//[^\]\s]+ https://[^\]\s]*\.png\]", ""),
        (r"\[(?:http:|mailto:|//)[^\]\s]+ ([^\]]*)\]", r"$1"),
    ],
)

LINK_RULES = [
    (r" (the|le|der|el) ([a-z]+)", r" [[$1 $2|$2 page]]s"),
    (r" (and|et|und|y) ([a-z]+)", r" [[$2]] [[File:$2.png|thumb|$1]]$2"),
    (r" (of|de|von) ([a-z]+)", r" [[w:$2 | $1 ]] [[:Category:$2]] [[:$2]]"),
]
FLAT_LINKS = [
    (r"\[\[:?(?:File|Category):[^\[\]]*\]\]", ""),
    (r"\[\[[^\[\]|]*\|\s*([^\[\]]*?)\s*\]\]", r"$1"),
    (r"\[\[([^\[\]|]*)\]\]", r"$1"),
]
cleaning_query("clean_internal_links", LINK_RULES, M.replace_internal_links, FLAT_LINKS)

NESTED_LINK_RULES = [
    (r" (the|le|der|el) ([a-z]+)", r" [[File:$2|thumb|about [[$2]] and [[a|$1]] here]]s"),
    (r" (and|et|und|y) ([a-z]+)", r" [[$2|x|see [[in|$1]] end]]ed"),
]
cleaning_query(
    "clean_nested_links",
    NESTED_LINK_RULES,
    M.replace_internal_links,
    [
        (r"\[\[File:[^\[\]]*\[\[[^\[\]]*\]\][^\[\]]*\[\[[^\[\]]*\]\][^\[\]]*\]\]", ""),
        (r"\[\[[^\[\]|]*\|x\|(see \[\[in\|[^\[\]]*\]\] end)\]\]", r"$1"),
    ],
)

KEPT_LINK_RULES = [
    (r" (the|le|der|el) ([a-z]+)", r" [[$1 $2|$2 page]]s"),
    (r" (and|et|und|y) ([a-z]+)", r" [[File:$2.png|thumb|$1]]"),
]
cleaning_query(
    "clean_kept_links",
    KEPT_LINK_RULES,
    lambda c: M.replace_internal_links(c, keep_links=True),
    [
        (r"\[\[File:[^\[\]]*\]\]", ""),
        (r"\[\[([a-z]*) ([a-z]*)\|([^\[\]]*)\]\]", r'<a href="$1%20$2">$3</a>'),
    ],
)

SWITCH_RULES = [(r"\. ", ". __TOC__ __NOTOC__x__KEEP__ ")]
cleaning_query("clean_switches", SWITCH_RULES, M.drop_switches, [("|".join(BEHAVIOUR_SWITCHES), "")])

QUOTE_RULES = [
    (r" (the|le|der|el) ([a-z]+)", r" '''''$1''''' $2"),
    (r" (and|et|und|y) ([a-z]+)", r" '''$1''' ''$2''"),
    (r" (of|de|von) ([a-z]+)", " ''\"$1\"'' \"\"$2\"\""),
]
cleaning_query(
    "clean_quotes",
    QUOTE_RULES,
    M.replace_quotes,
    [
        (r"'''''([^'\n]*)'''''", "$1"), (r"'''([^'\n]*)'''", "$1"), ("''\"([^\"\n]*)\"''", '"$1"'),
        (r"''([^'\n]*)''", '"$1"'), ('""([^"\n]*)""', '"$1"'),
    ],
)
cleaning_query(
    "html_quotes",
    QUOTE_RULES[:2],
    lambda c: M.replace_quotes(c, html=True),
    [(r"'''''([^'\n]*)'''''", "<b>$1</b>"), (r"'''([^'\n]*)'''", "<b>$1</b>"), (r"''([^'\n]*)''", "<i>$1</i>")],
)

TAG_RULES = [
    (r" (the|le|der|el) ([a-z]+)", r" <span class='$1'>$2</span> <!-- $1 - $2 -->"),
    (r" (and|et|und|y) ([a-z]+)", r' $1<br /> <ref name="$2"/> <B>$2</B>'),
    (r" (of|de|von) ([a-z]+)", r" <h2>$1</ h2> <other>$2</other>"),
]
cleaning_query(
    "clean_tags",
    TAG_RULES,
    M.drop_tags,
    [
        (r"<!--[^>]*-->", ""), (r"<(?:br|ref)\b[^>]*/\s*>", ""), (r"<(?:span|B|h2)\b[^>/]*>", ""), (r"</\s*(?:span|B|h2)>", ""),
    ],
)

ELEMENT_RULES = [
    (r" (the|le|der|el) ([a-z]+)", r" <ref name=$1>$2 <ref>inner</ref> $1</ref> $2"),
    (r" (and|et|und|y) ([a-z]+)", r" <ul><li>$1</li><li>$2</li></ul> <small>$2</small> $2"),
    (r" (of|de|von) ([a-z]+)", r" <gallery>$1 <pre>$2</pre></gallery> <keep>$2</keep>"),
]
cleaning_query(
    "clean_elements",
    ELEMENT_RULES,
    M.drop_elements,
    [
        (r"<(?:ref|li|small|pre)\b[^>/]*>[^<>]*</(?:ref|li|small|pre)>", ""),
        (r"<(?:ref|ul|gallery)\b[^>/]*>[^<>]*</(?:ref|ul|gallery)>", ""),
    ],
)


def _numbered_sql(marked):
    found = "regexp_extract_all(t, '<math>[^<>]*</math>')"
    gaps = "regexp_split_to_array(t, '<math>[^<>]*</math>')"
    label = "CASE WHEN i <= len(ms) THEN 'formula_' || list_position(ms, ms[i]) ELSE '' END"
    return (
        f"(SELECT array_to_string(list_transform(range(1, len(gs) + 1), lambda i: gs[i] || {label}), '') "
        f"FROM (SELECT {found} AS ms, {gaps} AS gs FROM (SELECT {marked} AS t)))"
    )


MATH_RULES = [(r" (the|le|der|el|and|et|und|y|of|de|von) ([a-z])", r" <math>$1</math> $2")]
cleaning_query("clean_placeholders", MATH_RULES, M.replace_placeholders, sql_expression=_numbered_sql)

TIDY_RULES = [(r" (the|le|der|el) ", " <<$1>>   ..... ,, "), (r"\n", "\n--!--\n"), (r" (and|et) ", " $1\t,. ")]
cleaning_query(
    "clean_tidy",
    TIDY_RULES,
    M.tidy,
    [
        ("<<", "«"), (">>", "»"), ("\t", " "), (" {2,}", " "), (r"\.{4,}", "..."),
        (r"\n[^\p{L}\p{N}_]+?\n", "\n"), (",,", ","), (r",\.", "."),
    ],
)


def _entity_sql(text):
    names = ", ".join(f"{sql_text(n)}: chr({c})" for n, c in name2codepoint.items())
    gaps, found = f"regexp_split_to_array({text}, '&#?[A-Za-z0-9_]+;')", f"regexp_extract_all({text}, '&#?[A-Za-z0-9_]+;')"
    code = "ms[i][2:len(ms[i]) - 1]"
    decoded = (
        f"CASE WHEN i > len(ms) THEN '' WHEN regexp_matches(ms[i], '^&#[0-9]+;$') THEN chr(CAST(ms[i][3:len(ms[i]) - 1] AS INTEGER)) "
        f"ELSE coalesce(names[{code}], ms[i]) END"
    )
    return (
        f"(SELECT array_to_string(list_transform(range(1, len(gs) + 1), lambda i: gs[i] || {decoded}), '') "
        f"FROM (SELECT {found} AS ms, {gaps} AS gs, MAP {{{names}}} AS names))"
    )


@query("unescape", f"SELECT page_id, {_entity_sql('html')} AS text FROM pages")
def unescape_pages(spark, sf):
    return spread_table(spark, sf, "pages").select("page_id", unescape(F.col("html")).alias("text"))


NUMERIC_RULES = [(r" (the|le|der|el) ", r" $1 &#233;&eacute;&#8364;&euro;&amp;lt;&unknown; ")]
cleaning_query("unescape_numeric", NUMERIC_RULES, unescape, sql_expression=_entity_sql)

CODE_RULES = [(r" (the|le|der|el) ", r" &lt;syntaxhighlight lang=x&gt;&amp;lt;$1&amp;gt;&lt;/syntaxhighlight&gt; &lt; ")]
cleaning_query(
    "syntax_highlight",
    CODE_RULES,
    M.unescape_outside_code,
    [(r"&lt;syntaxhighlight lang=x&gt;(&amp;lt;[a-z]+&amp;gt;)&lt;/syntaxhighlight&gt; &lt; ", r"$1 < ")],
)

# --- whole pipeline -----------------------------------------------------------

PAGE_RULES = [
    (r" (the|le|der|el) ([a-z]+)", r" '''$1''' [[$2|$2 page]]s<ref>$1</ref>"),
    (r" (and|et|und|y) ([a-z]+)", r" {{cite|$1}} [http://$2.org $2] ''$2''"),
    (r" (of|de|von) ([a-z]+)", r" {| $1 |} <b>$2</b> &lt;x&gt; __TOC__"),
]
CLEANED = [
    (r"\{\{[^{}]*\}\}", ""), (r"\{\|[^{}]*\|\}", ""), (r"\[http:[^\]]*\]", ""), (r"\[\[[^\[\]|]*\|([^\[\]]*)\]\]", "$1"),
    ("__TOC__", ""), ("&lt;", "<"), ("&gt;", ">"), (r"'''([^'\n]*)'''", "$1"), (r"''([^'\n]*)''", '"$1"'), (r"</?b>", ""),
    (r"<ref>[^<>]*</ref>", ""), (" {2,}", " "), (r"\.{4,}", "..."), (r"\n[^\p{L}\p{N}_]+?\n", "\n"), (",,", ","), (r",\.", "."),
]


@query(
    "clean_wikitext",
    f"SELECT doc_id AS page_id, {sql_rules(sql_rules('text', PAGE_RULES), CLEANED)} AS text FROM documents",
)
def clean_wikitext(spark, sf):
    return M.clean_wikitext(marked_documents(spark, sf, PAGE_RULES))


TWICE_RULES = [(r" (the|le|der|el) ", r" &amp;lt;$1&amp;gt; ")]


@query(
    "clean_twice_escaped",
    f"SELECT doc_id AS page_id, {sql_rules(sql_rules('text', TWICE_RULES), [('&amp;lt;', '<'), ('&amp;gt;', '>'), *CLEANED[-5:]])} AS text FROM documents",
)
def clean_twice_escaped(spark, sf):
    """What was escaped twice is text after cleaning, and no tag."""
    return M.clean_wikitext(marked_documents(spark, sf, TWICE_RULES))


# --- sections -----------------------------------------------------------------

SECTION_RULES = [
    (r"\n([A-ZÀ-Ý][^\s.]*) ([^\s.]+)", "\n==$1==\n===Sub $2===\n* item $1\n$1 $2"),
    (r"\. ([A-Z][a-z]*) ([a-z]+)", ".\n== $1 ==\n==== $2! ====\n=== low ===\n(gone $2)\n$1 $2"),
    (r"([a-z]+), ", "$1\n: indented\n-..-\n$1}\n"),
]
_LINES_SQL = f"""
lines AS (SELECT page_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM
  (SELECT doc_id AS page_id, string_split({sql_rules("text", SECTION_RULES)}, chr(10)) AS ls FROM documents)),
parts AS (SELECT page_id, i, line, length(regexp_extract(line, '^(==+)\\s*(?:[^=]*?)\\s*==', 1)) AS lev,
  regexp_extract(line, '^==+\\s*([^=]*?)\\s*==', 1) AS title FROM lines WHERE line <> ''),
kinds AS (SELECT *, CASE WHEN lev > 0 THEN 'h'
  WHEN regexp_matches(line, '^[:*#;{{|]') OR regexp_matches(line, '\\}}$') OR regexp_matches(line, '^\\(.*\\)$')
    OR regexp_matches(line, '^[.-]+$') THEN 'x' ELSE 'b' END AS kind FROM parts),
blocks AS (SELECT *, coalesce(sum(CASE WHEN kind = 'b' THEN 1 ELSE 0 END) OVER (PARTITION BY page_id ORDER BY i
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS block FROM kinds WHERE kind <> 'x'),
judged AS (SELECT *, min(CASE WHEN kind = 'h' THEN lev END) OVER later AS low,
    max(CASE WHEN kind = 'b' THEN 1 ELSE 0 END) OVER (PARTITION BY page_id, block) AS filled FROM blocks
  WINDOW later AS (PARTITION BY page_id, block ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
kept AS (SELECT page_id, i, CASE WHEN kind = 'b' THEN line WHEN title = '' OR regexp_matches(title, '[!?]$') THEN title ELSE title || '.' END AS line
  FROM judged WHERE kind = 'b' OR (filled = 1 AND (low IS NULL OR low > lev)))
"""


@query(
    "sections",
    f"WITH {_LINES_SQL} SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS pos, line FROM kept",
)
def sections(spark, sf):
    pages = S.compact_sections(marked_documents(spark, sf, SECTION_RULES))
    return pages.select("page_id", F.posexplode("lines").alias("pos", "line")).withColumn("pos", F.col("pos").cast("long"))


@query(
    "sections_bodies_only",
    f"WITH {_LINES_SQL} SELECT page_id, line, count(*) AS n FROM kinds WHERE kind = 'b' GROUP BY page_id, line",
)
def sections_bodies_only(spark, sf):
    pages = S.compact_sections(marked_documents(spark, sf, SECTION_RULES), keep_sections=True)
    lines = pages.select("page_id", F.explode("lines").alias("line"))
    return lines.groupBy("page_id", "line").agg(F.count(F.lit(1)).alias("n"))


HTML_RULES = [(r"\n([A-ZÀ-Ý][^\s.]*) ([^\s.]+)", "\n==$1==\n* one $1\n** two $2\n# three\n$1 $2")]


@query("sections_html")
def sections_html(spark, sf):
    pages = S.compact_sections(marked_documents(spark, sf, HTML_RULES), html=True)
    return pages.select("page_id", F.posexplode("lines").alias("pos", "line"))


# --- titles -------------------------------------------------------------------


def _titles(spark, sf):
    return table(spark, sf, "documents").select(
        F.col("doc_id").alias("page_id"),
        F.when(F.col("lang") == "fr", F.concat(F.lit("Template:"), F.col("source")))
        .when(F.col("lang") == "de", F.concat(F.lit("wikt:"), F.col("source")))
        .when(F.col("lang") == "es", F.concat(F.lit("Talk:"), F.col("source")))
        .otherwise(F.col("source"))
        .alias("title"),
        F.when(F.col("source") == "src1", F.lit("src2")).alias("redirect"),
    )


_TITLES_SQL = """titles AS (SELECT doc_id AS page_id, CASE lang WHEN 'fr' THEN 'Template:' || source WHEN 'de' THEN 'wikt:' || source
  WHEN 'es' THEN 'Talk:' || source ELSE source END AS title, CASE WHEN source = 'src1' THEN 'src2' END AS redirect FROM documents)"""


@query(
    "article_filter",
    f"WITH {_TITLES_SQL} SELECT page_id, title FROM titles WHERE redirect IS NULL AND NOT starts_with(title, 'Template') "
    "AND (NOT contains(title, ':') OR split_part(title, ':', 1) IN ('w', 'wiktionary', 'wikt'))",
)
def articles(spark, sf):
    return article_filter(_titles(spark, sf)).select("page_id", "title")


@query(
    "article_filter_namespaces",
    f"WITH {_TITLES_SQL} SELECT page_id, title FROM titles WHERE redirect IS NULL AND NOT starts_with(title, 'Template') "
    "AND (NOT contains(title, ':') OR split_part(title, ':', 1) IN ('Talk'))",
)
def articles_of_namespaces(spark, sf):
    return article_filter(_titles(spark, sf), accepted=("Talk",)).select("page_id", "title")


@query(
    "ucfirst_title",
    "SELECT doc_id AS page_id, upper(source[1]) || source[2:] AS upper_title, "
    "lower(upper(source)[1]) || upper(source)[2:] AS lower_title FROM documents",
)
def ucfirst_title(spark, sf):
    return table(spark, sf, "documents").select(
        F.col("doc_id").alias("page_id"),
        upper_first(F.col("source")).alias("upper_title"),
        lower_first(F.upper("source")).alias("lower_title"),
    )


@query(
    "template_title",
    "SELECT doc_id AS page_id, CASE lang WHEN 'fr' THEN upper(source[1]) || source[2:] WHEN 'de' THEN 'Template:' || source "
    "WHEN 'es' THEN 'Template:Talk:' || source ELSE 'Template:' || upper(source[1]) || source[2:] END AS title FROM documents",
)
def template_titles(spark, sf):
    name = (
        F.when(F.col("lang") == "fr", F.concat(F.lit(":"), F.col("source")))
        .when(F.col("lang") == "de", F.concat(F.lit("template:"), F.col("source")))
        .when(F.col("lang") == "es", F.concat(F.lit("talk:"), F.col("source")))
        .otherwise(F.col("source"))
    )
    return table(spark, sf, "documents").select(F.col("doc_id").alias("page_id"), template_title(name).alias("title"))


@query(
    "normalize_title",
    "SELECT doc_id AS page_id, CASE WHEN lang = 'fr' THEN 'Template:' || upper(source[1]) || source[2:] WHEN lang = 'de' "
    "THEN '3001: ' || upper(source[1]) || source[2:] ELSE upper(source[1]) || source[2:] || ' x' END AS title FROM documents",
)
def normalized_titles(spark, sf):
    raw = (
        F.when(F.col("lang") == "fr", F.concat(F.lit("_template:  "), F.col("source"), F.lit("__")))
        .when(F.col("lang") == "de", F.concat(F.lit(" 3001:  _"), F.col("source")))
        .otherwise(F.concat(F.lit("_"), F.col("source"), F.lit("_ _x ")))
    )
    return table(spark, sf, "documents").select(F.col("doc_id").alias("page_id"), normalize_title(raw).alias("title"))


@query("page_url", "SELECT page_id, 'http://x.org/wiki?curid=' || page_id AS url FROM pages")
def page_urls(spark, sf):
    return table(spark, sf, "pages").select("page_id", page_url("http://x.org/wiki", F.col("page_id")).alias("url"))


@query(
    "url_quote",
    "SELECT page_id, replace(replace(url_encode(url), '%2F', '/'), '~', '%7E') AS quoted, url AS unquoted FROM pages",
)
def quoted_urls(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", url_quote(F.col("url")).alias("quoted"), url_unquote(url_quote(F.col("url"))).alias("unquoted")
    )

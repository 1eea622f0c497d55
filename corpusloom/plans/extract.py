"""From raw pages to the tables that ranking and search read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.fixed_values import ACCEPTED_NAMESPACES, CONTENT_STOPWORDS, TEMPLATE_NAMESPACE
from corpusloom.operators import graph as G
from corpusloom.operators.abbreviations import learn_abbreviations
from corpusloom.operators.lemmas import lemmatize
from corpusloom.operators.links import extract_links, resolve_links, without_anchors
from corpusloom.operators.markup import clean_wikitext
from corpusloom.operators.pages import article_filter, with_dense_ids
from corpusloom.operators.sections import compact_sections
from corpusloom.operators.expansion import expand_templates
from corpusloom.operators.templates import load_templates
from corpusloom.runtime import checkpoint
from corpusloom.sources.wiki_xml import with_siteinfo


def clean_articles(
    pages: DataFrame,
    as_of: Column | None = None,
    accepted=ACCEPTED_NAMESPACES,
    siteinfo: DataFrame | None = None,
) -> DataFrame:
    """(page_id, title, text): articles with dense ids and cleaned text that keeps its links.

    Templates defined among ``pages`` are expanded when ``as_of`` is given, else dropped.
    ``siteinfo`` names the template namespace of the dump, or of each of its files; without it, it is ``Template``.
    """
    prefix = TEMPLATE_NAMESPACE
    if siteinfo is not None:
        pages, prefix = with_siteinfo(pages, siteinfo), F.col("template_namespace")
    articles = with_dense_ids(article_filter(pages, accepted, prefix).select("title", "text"))
    if as_of is not None:
        templates, redirects = load_templates(pages, prefix)
        articles = expand_templates(articles, templates, redirects, as_of)
    cleaned = clean_wikitext(articles, keep_links=True, accepted=accepted, templates_expanded=as_of is not None)
    lines = compact_sections(cleaned)
    return lines.select("page_id", "title", F.array_join("lines", " ").alias("text"))


def extract_corpus(
    pages: DataFrame,
    lexicon: DataFrame,
    as_of: Column | None = None,
    normalize_links: bool = False,
    stopwords=CONTENT_STOPWORDS,
    accepted=ACCEPTED_NAMESPACES,
    siteinfo: DataFrame | None = None,
    abbreviations: bool = False,
) -> dict[str, DataFrame]:
    """page_ids, contents, edges, adjacency, transitions and vector of raw pages.

    With ``abbreviations`` those of the texts are learnt, and keep their full stop in the contents.
    """
    cleaned = checkpoint(clean_articles(pages, as_of, accepted, siteinfo))
    page_ids = cleaned.select("page_id", "title")
    text = cleaned.select(F.col("page_id").alias("doc_id"), without_anchors(F.col("text")).alias("content"))
    redirects = pages.filter("redirect IS NOT NULL").select("title", F.col("redirect").alias("target"))
    links = extract_links(cleaned)
    edges = resolve_links(links, page_ids, normalize_links, redirects if normalize_links else None)
    edges = checkpoint(edges)
    nodes = page_ids.select(F.col("page_id").alias("id"))
    return {
        "page_ids": page_ids,
        "contents": lemmatize(text, lexicon, stopwords, abbreviations=learn_abbreviations(text) if abbreviations else None),
        "edges": edges,
        "adjacency": G.adjacency(edges, nodes),
        "transitions": G.transition_matrix(edges),
        "vector": G.uniform_vector(nodes),
    }

"""Titles, text and links of HTML pages; link targets resolved to page ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.entities import unescape
from corpusloom.functions.text import url_unquote
from corpusloom.functions.titles import KNOWN_NAMESPACES, normalize_title
from corpusloom.operators.key_filter import keep_known
from corpusloom.runtime import attach_by_key, checkpoint

_ANCHOR = r"""(?i)<a\b[^>]*?\bhref\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)"""


def first_title(markup: Column) -> Column:
    return F.regexp_extract(markup, r"(?d)<title>(.*)</title>", 1)


def first_id(markup: Column) -> Column:
    """First id of a page's source; 0 if there is none."""
    return F.coalesce(F.regexp_extract(markup, r"(?d)<id>(.*)</id>", 1).try_cast("long"), F.lit(0).cast("long"))


def html_text(html: Column) -> Column:
    """Text between the tags."""
    return F.regexp_replace(html, r"<[^>]*>", " ")


def without_anchors(text: Column) -> Column:
    """A cleaned page's text without the tags of its kept links; anchors are all the markup it has."""
    return F.regexp_replace(text, r"(?i)</?a\b[^>]*>", "")


def anchor_targets(markup: Column) -> Column:
    """Distinct decoded targets of all anchors."""
    raw = F.regexp_extract_all(markup, F.lit(_ANCHOR), F.lit(1))
    return F.array_distinct(
        F.transform(raw, lambda t: url_unquote(unescape(F.regexp_replace(t, r"""^["']|["']$""", ""))))
    )


def extract_links(pages: DataFrame, column: str = "text") -> DataFrame:
    """(src, title): each page's distinct link targets."""
    return pages.select(
        F.col("page_id").alias("src"), F.explode(anchor_targets(F.col(column))).alias("title")
    )


def _linkable(title: Column, normalize: bool, namespaces) -> Column:
    return normalize_title(F.regexp_replace(title, "#.*$", ""), namespaces) if normalize else title


def resolve_links(
    links: DataFrame,
    page_ids: DataFrame,
    normalize: bool = False,
    redirects: DataFrame | None = None,
    namespaces=KNOWN_NAMESPACES,
    min_hot_rows: int | None = None,
) -> DataFrame:
    """Distinct edges (src, dst) of the links whose target is a known page.

    Titles must match exactly; ``normalize`` compares normal forms without the
    part behind ``#`` and follows one redirect of ``redirects(title, target)``.
    Links to neither a page nor a redirect leave by a filter of the titles, before any shuffle.
    The page ids are stored once, as they are counted, filtered by and joined.
    """
    page_ids = checkpoint(page_ids.select("page_id", "title"))
    known = page_ids.groupBy(_linkable(F.col("title"), normalize, namespaces).alias("title")).agg(
        F.max("page_id").alias("dst")
    )
    titles = page_ids.select(_linkable(F.col("title"), normalize, namespaces).alias("title"))
    follows = normalize and redirects is not None
    if follows:
        titles = titles.unionByName(redirects.select(_linkable(F.col("title"), True, namespaces).alias("title")))
    wanted = links.select("src", _linkable(F.col("title"), normalize, namespaces).alias("title"))
    wanted = keep_known(wanted, titles, "title").distinct()
    if follows:
        hops = redirects.groupBy(_linkable(F.col("title"), True, namespaces).alias("title")).agg(
            F.max(_linkable(F.col("target"), True, namespaces)).alias("target")
        )
        hopped = attach_by_key(wanted, hops, "title", "left", min_hot_rows)
        wanted = hopped.select("src", F.coalesce("target", "title").alias("title"))
    return attach_by_key(wanted, known, "title", min_rows=min_hot_rows).select("src", "dst").distinct()


def unresolved_links(links: DataFrame, page_ids: DataFrame) -> DataFrame:
    """Links to titles that no page has."""
    known = page_ids.select("title").distinct().withColumn("_known", F.lit(True))
    return attach_by_key(links, known, "title", "left").filter("_known IS NULL").select("src", "title")

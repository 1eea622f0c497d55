"""Which pages count as articles, and their ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.fixed_values import ACCEPTED_NAMESPACES, TEMPLATE_NAMESPACE
from corpusloom.operators.ranking import with_position


def article_filter(
    pages: DataFrame, accepted=ACCEPTED_NAMESPACES, template_namespace: str | Column = TEMPLATE_NAMESPACE
) -> DataFrame:
    """Pages that are no redirect, no template, and in no namespace but the accepted ones.

    The template namespace is a name, or a column of ``pages`` where dumps differ in it.
    """
    title = F.col("title")
    return pages.filter(
        F.col("redirect").isNull()
        & ~title.startswith(template_namespace)
        & (~title.contains(":") | F.substring_index(title, ":", 1).isin(*accepted))
    )


def with_dense_ids(pages: DataFrame) -> DataFrame:
    """Number the pages from 0 in title order; pages without a title are left out.

    Only titles and 64-bit hashes are compared and sampled, never the texts.
    """
    titled = pages.filter(F.col("title").isNotNull()).drop("page_id")
    others = [c for c in titled.columns if c != "title"]
    return with_position(titled, F.col("title"), F.xxhash64(*others) if others else F.lit(0), name="page_id")

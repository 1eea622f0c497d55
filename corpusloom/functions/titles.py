"""Page titles, template titles and page addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.fixed_values import TEMPLATE_NAMESPACE
from corpusloom.functions.text import upper_first

KNOWN_NAMESPACES = (TEMPLATE_NAMESPACE,)


def normalize_title(title: Column, namespaces=KNOWN_NAMESPACES) -> Column:
    """Trim and squeeze spaces and underscores; capitalise the namespace and the rest.

    The space after the colon goes only behind a known namespace.
    """
    squeezed = F.regexp_replace(F.regexp_replace(title, r"^[ _]+|[ _]+$", ""), r"[\s_]+", " ")
    shape = r"(?s)^([^:]*):(\s*)(\S.*)$"
    prefix = upper_first(F.regexp_extract(squeezed, shape, 1))
    rest = upper_first(F.regexp_extract(squeezed, shape, 3))
    gap = F.when(prefix.isin(*namespaces) | (F.regexp_extract(squeezed, shape, 2) == ""), "").otherwise(" ")
    return F.when(squeezed.rlike(shape), F.concat(prefix, F.lit(":"), gap, rest)).otherwise(upper_first(squeezed))


def template_title(name: Column, namespaces=KNOWN_NAMESPACES) -> Column:
    """Full title of the page a template call includes."""
    prefix = upper_first(F.substring_index(name, ":", 1))
    after = F.regexp_extract(name, r"(?s)^[^:]*(:.*)$", 1)
    return (
        F.when(name == "", "")
        .when(name.startswith(":"), upper_first(F.regexp_replace(name, "^:", "")))
        .when(name.contains(":") & prefix.isin(*namespaces), F.concat(prefix, after))
        .otherwise(F.concat(F.lit(TEMPLATE_NAMESPACE + ":"), upper_first(name)))
    )


def page_url(url_base, page_id: Column) -> Column:
    base = url_base if isinstance(url_base, Column) else F.lit(url_base)
    return F.concat(base, F.lit("?curid="), page_id.cast("string"))

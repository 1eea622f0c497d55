"""Wiki markup turned into plain text (or HTML), as a chain of column steps.

Every step works inside its row: cleaning a corpus needs no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.fixed_values import (
    ACCEPTED_NAMESPACES,
    BEHAVIOUR_SWITCHES,
    DISCARDED_ELEMENTS,
    EXTERNAL_LINK,
    IGNORED_TAGS,
    IMAGE_URL,
    PLACEHOLDERS,
    SELF_CLOSING_TAGS,
)
from corpusloom.functions.entities import unescape
from corpusloom.functions.text import (
    CLOSE,
    INNER_OPEN,
    OPEN,
    drop_nested,
    let,
    mark_outermost,
    replace_each,
    strip_marks,
    trim_space,
    url_quote,
    without_marks,
)

TABLE = ("{|", "|}")
TEMPLATE = ("{{", "}}")
LINK = ("[[", "]]")

_LINK_SPAN = rf"{OPEN}[^{OPEN}{CLOSE}]*+{CLOSE}[A-Za-z0-9_]*+"


def drop_tables(text: Column) -> Column:
    return drop_nested(text, *TABLE, literal=True)


def drop_templates(text: Column) -> Column:
    return drop_nested(text, *TEMPLATE, literal=True)


def _outside(target: Column, accepted) -> Column:
    """True where a link target names a namespace that is not kept, also as ``:ns:title``."""
    first = F.substring_index(target, ":", 1)
    second = F.regexp_extract(target, r"(?s)^:([^:]+):", 1)
    plain = target.contains(":") & ~target.startswith(":") & ~first.isin(*accepted)
    return plain | (target.startswith(":") & (second != "") & ~second.isin(*accepted))


def replace_external_links(
    text: Column, keep_labels: bool = False, keep_links: bool = False, accepted=ACCEPTED_NAMESPACES
) -> Column:
    """``[url label]``: a url with a scheme goes with its label, ``//host`` leaves the label.

    ``keep_labels`` leaves every label; ``keep_links`` writes anchors.
    """

    def shown(match):
        url = F.regexp_extract(match, EXTERNAL_LINK, 1)
        label = F.regexp_extract(match, EXTERNAL_LINK, 2)
        image = F.concat(F.lit('<img src="'), label, F.lit('" alt="">')) if keep_links else F.lit("")
        label = F.when(label.rlike(IMAGE_URL), image).otherwise(label)
        if keep_links:
            label = F.concat(F.lit('<a href="'), url_quote(url), F.lit('">'), label, F.lit("</a>"))
        return label if keep_labels else F.when(_outside(url, accepted), "").otherwise(label)

    return replace_each(text, EXTERNAL_LINK, shown)


def replace_internal_links(text: Column, accepted=ACCEPTED_NAMESPACES, keep_links: bool = False) -> Column:
    """``[[title|label]]trail`` becomes label and trail; links into other namespaces go.

    Only outermost links count. With links inside the label, it starts at the last
    pipe of its own before the last of them.
    """
    parts = rf"(?s)^{OPEN}\[\[(.*)\]\]{CLOSE}(\w*)$"

    def label_of(inner):
        after_pipe = (
            F.when(inner.rlike(rf"(?s)\|.*{INNER_OPEN}"), F.regexp_extract(inner, rf"(?s)^.*\|(?=.*{INNER_OPEN})(.*)$", 1))
            .otherwise(F.regexp_extract(inner, r"(?s)^[^|]*\|(.*)$", 1))
        )
        return strip_marks(F.when(inner.contains("|"), trim_space(after_pipe)).otherwise(inner))

    def linked(inner):
        target = F.regexp_replace(F.substring_index(inner, "|", 1), r"\s+\z", "")
        title = strip_marks(F.when(inner.contains("|"), target).otherwise(inner))
        label = label_of(inner)
        if keep_links:
            label = F.concat(F.lit('<a href="'), url_quote(title), F.lit('">'), label, F.lit("</a>"))
        return let(title, lambda t: F.when(t.contains(":") & _outside(t, accepted), "").otherwise(label))

    def shown(match):
        return F.concat(let(F.regexp_extract(match, parts, 1), linked), F.regexp_extract(match, parts, 2))

    marked = let(mark_outermost(text, *LINK, literal=True), lambda t: strip_marks(replace_each(t, _LINK_SPAN, shown)))
    return F.when(text.contains("[["), marked).otherwise(text)


def drop_switches(text: Column) -> Column:
    return F.regexp_replace(text, "|".join(BEHAVIOUR_SWITCHES), "")


SYNTAX_BLOCK = r"(?s)(?:&lt;|<)syntaxhighlight .*?(?:&gt;|>).*?(?:&lt;|<)/syntaxhighlight(?:&gt;|>)"
_SYNTAX_BODY = r"(?s)^(?:&lt;|<)syntaxhighlight .*?(?:&gt;|>)(.*)(?:&lt;|<)/syntaxhighlight(?:&gt;|>)$"


def unescape_outside_code(text: Column) -> Column:
    """Decode references except inside syntax-highlighted code, whose tag is dropped."""
    blocks = replace_each(text, SYNTAX_BLOCK, lambda m: F.regexp_extract(m, _SYNTAX_BODY, 1), unescape)
    return F.when(text.contains("syntaxhighlight"), blocks).otherwise(unescape(text))


def replace_quotes(text: Column, html: bool = False) -> Column:
    """Bold and italic marks; doubled quotes become one."""
    if html:
        steps = (("'''''(.*?)'''''", "<b>$1</b>"), ("'''(.*?)'''", "<b>$1</b>"), ("''(.*?)''", "<i>$1</i>"))
    else:
        steps = (
            ("'''''(.*?)'''''", "$1"), ("'''(.*?)'''", "$1"), ("''\"([^\"]*?)\"''", '"$1"'),
            ("''(.*?)''", '"$1"'), ('""([^"]*?)""', '"$1"'),
        )
    for pattern, replacement in steps:
        text = F.regexp_replace(text, "(?d)" + pattern, replacement)
    return F.replace(F.replace(text, F.lit("'''"), F.lit("")), F.lit("''"), F.lit('"'))


def drop_tags(text: Column, keep_links: bool = False) -> Column:
    """Comments, self-closing tags and ignored tags; what the latter enclose stays."""
    closed = "|".join(SELF_CLOSING_TAGS)
    ignored = "|".join(IGNORED_TAGS if keep_links else IGNORED_TAGS + ("a",))
    return F.regexp_replace(
        text, rf"(?i)<!--[\s\S]*?-->|<\s*(?:{closed})\b[^>]*/\s*>|<(?:{ignored})\b[^>/]*>|</\s*(?:{ignored})>", ""
    )


def drop_elements(text: Column, elements=DISCARDED_ELEMENTS) -> Column:
    """Elements dropped with their content, one kind after the other, nested ones too."""

    present = F.array_distinct(F.regexp_extract_all(text, F.lit(rf"<\s*/\s*({'|'.join(elements)})>"), F.lit(1)))
    in_order = let(
        present, lambda found: F.filter(F.array(*[F.lit(e) for e in elements]), lambda e: F.array_contains(found, e))
    )

    def without(state, element):
        return drop_nested(
            state,
            F.concat(F.lit(r"<\s*"), element, F.lit(r"\b[^>/]*>")),
            F.concat(F.lit(r"<\s*/\s*"), element, F.lit(">")),
        )

    return F.when(text.rlike(r"<\s*/"), F.aggregate(in_order, text, without)).otherwise(text)


def _numbered(text: Column, element: str, word: str) -> Column:
    def with_numbers(t):
        return let(
            F.regexp_extract_all(t, F.lit(element), F.lit(0)),
            lambda found: replace_each(
                t, element, lambda m: F.concat(F.lit(word + "_"), F.array_position(found, m).cast("string"))
            ),
        )

    return F.when(text.rlike(element), let(text, with_numbers)).otherwise(text)


def replace_placeholders(text: Column) -> Column:
    """Formulas and code become numbered words; equal ones share the first one's number."""
    for tag, word in PLACEHOLDERS.items():
        text = _numbered(text, rf"(?is)<\s*{tag}(?:\s*| [^>]+?)>.*?<\s*/\s*{tag}\s*>", word)
    return text


def tidy(text: Column) -> Column:
    """Guillemets, spaces, dots, lines of punctuation only, doubled commas."""
    for found, wanted in (("<<", "«"), (">>", "»"), ("\t", " ")):
        text = F.replace(text, F.lit(found), F.lit(wanted))
    text = F.regexp_replace(text, " {2,}", " ")
    text = F.regexp_replace(text, r"\.{4,}", "...")
    text = F.regexp_replace(text, r"\n[^\p{L}\p{N}_]+?\n", "\n")
    return F.replace(F.replace(text, F.lit(",,"), F.lit(",")), F.lit(",."), F.lit("."))


def clean_wikitext(
    pages: DataFrame,
    keep_external_labels: bool = False,
    keep_links: bool = False,
    html: bool = False,
    accepted=ACCEPTED_NAMESPACES,
    templates_expanded: bool = False,
    column: str = "text",
) -> DataFrame:
    """Clean the markup of ``column``; HTML output keeps links.

    Template calls still in the text are dropped unless ``templates_expanded``.
    """
    keep_links = keep_links or html
    steps = [without_marks]
    if not templates_expanded:
        steps.append(drop_templates)
    steps += [
        drop_tables,
        lambda t: replace_external_links(t, keep_external_labels, keep_links, accepted),
        lambda t: replace_internal_links(t, accepted, keep_links),
        drop_switches,
        unescape_outside_code,
        lambda t: replace_quotes(t, html),
        lambda t: drop_tags(t, keep_links),
        drop_elements,
    ]
    if not html:
        steps.append(unescape)
    steps += [replace_placeholders, tidy]
    for step in steps:
        pages = pages.withColumn(column, step(F.col(column)))
    return pages

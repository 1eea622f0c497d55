"""Lines of a cleaned page: filled sections, dropped residuals, lists in HTML mode.

Works inside each row: headers are compared with regular expressions, so a page
is never spread over several rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import CLOSE, OPEN, let, replace_each, trim_space, without_marks

_GAP = r"[ \t\x0b\f\r]*"
_HEADER = rf"(==+){_GAP}(.*?){_GAP}\1"
# (?d): only \n ends a line
_RESIDUAL = rf"(?md)^(?!{_HEADER})(?!\+\+)(?:[:*#;{{|].*|.*\}}|\(.*\)|[.\-]+)$\n?"
_RESIDUAL_HTML = rf"(?md)^(?!{_HEADER})(?!\+\+)(?::.*|(?![*#;])(?:[{{|].*|.*\}}|\(.*\)|[.\-]+))$\n?"
_SUPERSEDED = rf"(?md)^{OPEN}(=++){CLOSE}.*\n(?=(?:{OPEN}\1=++{CLOSE}.*\n|\+\+.*\n)*+{OPEN}(?!\1=))"
_UNFILLED = rf"(?md)^{OPEN}=++{CLOSE}.*\n?(?=(?:{OPEN}.*\n?|\+\+.*\n?)*+\z)"
_HEADER_LINE = rf"(?md)^{OPEN}.*\n?"
_PENDING = rf"(?md)(?:^{OPEN}.*\n|^\+\+.*\n)++"


def _with_marked_headers(text: Column, residual: str) -> Column:
    lines = F.regexp_replace(without_marks(text), r"\n{2,}", "\n")
    kept = F.regexp_replace(lines, residual, "")
    return F.regexp_replace(kept, rf"(?md)^{_HEADER}.*$", f"{OPEN}$1{CLOSE}$2")


def _stopped(title: Column) -> Column:
    return F.when((title == "") | title.rlike(r"[!?]\z"), title).otherwise(F.concat(title, F.lit(".")))


def _titles_first(text: Column) -> Column:
    """Page-title lines come before the headers still waiting for their section."""

    def reorder(block):
        def pick(pattern):
            return F.array_join(F.regexp_extract_all(block, F.lit(pattern), F.lit(0)), "")

        return F.concat(pick(r"(?md)^\+\+.*\n"), pick(rf"(?md)^{OPEN}.*\n"))

    return let(text, lambda t: F.when(t.rlike(r"(?m)^\+\+"), replace_each(t, _PENDING, reorder)).otherwise(t))


def section_lines(text: Column, keep_sections: bool = False) -> Column:
    """The lines of a page as text.

    A header stays only if a body line follows before a header of its own or a
    higher level; the headers kept come before that line. ``keep_sections`` emits
    no header text.
    """
    marked = _with_marked_headers(text, _RESIDUAL)
    if keep_sections:
        marked = F.regexp_replace(marked, _HEADER_LINE, "")
    else:
        marked = F.regexp_replace(F.regexp_replace(marked, _SUPERSEDED, ""), _UNFILLED, "")
    lines = F.filter(F.split(_titles_first(marked), "\n", -1), lambda line: line != "")
    shown = F.transform(
        lines,
        lambda line: F.when(line.startswith(OPEN), _stopped(F.regexp_extract(line, f"(?s){CLOSE}(.*)$", 1)))
        .when(line.rlike(r"(?s)^\+\+.+..$"), _stopped(F.regexp_extract(line, r"(?s)^\+\+(.*)..$", 1)))
        .when(line.startswith("++"), F.lit(None))
        .otherwise(line),
    )
    return F.filter(shown, lambda line: line.isNotNull())


_LIST_TAG = {"*": "ul", "#": "ol", ";": "dl", ":": "dl"}


def _by_list_mark(mark: Column, names: dict) -> Column:
    chosen = F.when(F.lit(False), "")
    for key, name in names.items():
        chosen = chosen.when(mark == key, name)
    return chosen


def section_html(text: Column) -> Column:
    """The lines of a page as HTML: headings, paragraphs and nested lists."""
    marked = _with_marked_headers(text, _RESIDUAL_HTML)
    lines = F.filter(F.split(marked, "\n", -1), lambda line: line != "")

    def marks(line):
        return F.when(line.isNull(), "").otherwise(F.regexp_extract(line, r"^([*#;][*#;:]*)", 1))

    def same_levels(old, new):
        def head(value, n):
            return F.left(F.translate(value, ";", ":"), n)

        levels = F.sequence(F.lit(0), F.least(F.length(old), F.length(new)))
        return F.size(F.filter(levels, lambda n: head(old, n) == head(new, n))) - 1

    def tags(levels, shape):
        each = F.filter(F.split(levels, ""), lambda c: c != "")
        return F.transform(each, lambda c: F.format_string(shape, _by_list_mark(c, _LIST_TAG)))

    def rendered(line, old):
        new = marks(line)
        level = same_levels(old, new)
        after = F.lit(2_147_483_647)
        closing = tags(F.reverse(F.substring(old, level + 1, after)), "</%s>")
        opening = tags(F.substring(new, level + 1, after), "<%s>")
        item = trim_space(F.substring(line, F.length(new) + 1, after))
        item_tag = _by_list_mark(F.right(new, F.lit(1)), {"*": "li", "#": "li", ";": "dt", ":": "dd"})
        heading = F.length(F.regexp_extract(line, f"^{OPEN}(=+)", 1)).cast("string")
        title = F.regexp_extract(line, f"(?s){CLOSE}(.*)$", 1)
        body = (
            F.when(line.isNull() | (line.startswith("++") & ~line.rlike(r"(?s)^\+\+.+..$")), "")
            .when(line.startswith(OPEN), F.concat(F.lit("<h"), heading, F.lit(">"), title, F.lit("</h"), heading, F.lit(">")))
            .when(line.startswith("++"), _stopped(F.regexp_extract(line, r"(?s)^\+\+(.*)..$", 1)))
            .when((new != "") & (item != ""), F.concat(F.lit("<"), item_tag, F.lit(">"), item, F.lit("</"), item_tag, F.lit(">")))
            .when(new != "", "")
            .otherwise(line)
        )
        return F.concat(closing, opening, F.filter(F.array(body), lambda part: part != ""))

    def render(all_lines):
        ended = F.concat(all_lines, F.array(F.lit(None).cast("string")))
        return F.flatten(
            F.transform(ended, lambda line, i: rendered(line, marks(F.when(i > 0, F.get(all_lines, i - 1)))))
        )

    return let(lines, render)


def compact_sections(pages: DataFrame, keep_sections: bool = False, html: bool = False, column: str = "text") -> DataFrame:
    """Replace ``column`` by ``lines``, the array of output lines."""
    lines = section_html(F.col(column)) if html else section_lines(F.col(column), keep_sections)
    return pages.withColumn("lines", lines).drop(column)

"""Column helpers for text: bind once, replace each match, nested delimiters.

Marks are control characters that XML text cannot contain; ``without_marks``
removes them from anything that did not come through an XML reader.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

OPEN, CLOSE = "\x01", "\x02"  # an outermost pair
INNER_OPEN, INNER_CLOSE = "\x03", "\x04"  # a pair inside another
PIPE = "\x05"  # a pipe that separates nothing
PIECE, PIECE_END = "\x10", "\x11"  # around the number of a piece that is kept elsewhere
RAW_OPEN, RAW_CLOSE, RAW_PIPE = "\x12", "\x13", "\x14"  # braces and pipes that wait to be read
_MARKS = OPEN + CLOSE + INNER_OPEN + INNER_CLOSE + PIPE + PIECE + PIECE_END + RAW_OPEN + RAW_CLOSE + RAW_PIPE


def without_marks(text: Column) -> Column:
    return F.translate(text, _MARKS, "")


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), body), 1)


def replace_each(text: Column, pattern: str, on_match, on_gap=None) -> Column:
    """Replace each match of ``pattern`` by ``on_match(match)``, the text between by ``on_gap(gap)``."""

    def rebuild(t):
        gaps = F.split(t, pattern, -1)
        matches = F.regexp_extract_all(t, F.lit(pattern), F.lit(0))
        joined = F.zip_with(
            gaps,
            matches,
            lambda g, m: F.concat(
                on_gap(g) if on_gap else g, F.when(m.isNull(), F.lit("")).otherwise(F.coalesce(on_match(m), F.lit("")))
            ),
        )
        return F.array_join(joined, "")

    return F.when(text.rlike(pattern) if on_gap is None else F.lit(True), let(text, rebuild)).otherwise(text)


def _mark(text: Column, opening: str | Column, closing: str | Column, literal: bool) -> Column:
    if literal:
        marked = F.replace(text, F.lit(opening), F.lit(OPEN + opening))
        return F.replace(marked, F.lit(closing), F.lit(closing + CLOSE))
    marked = F.regexp_replace(text, opening, OPEN + "$0")
    return F.regexp_replace(marked, closing, "$0" + CLOSE)


_FLAT = f"^[^{OPEN}{CLOSE}]*+(?:{OPEN}[^{OPEN}{CLOSE}]*+{CLOSE}[^{OPEN}{CLOSE}]*+)*+\\z"


_LEVELS = 4  # of nesting that one constant pattern covers


def _balanced(levels: int) -> str:
    """A pair with pairs inside it, ``levels`` deep in all."""
    plain = f"[^{OPEN}{CLOSE}]*+"
    return f"{OPEN}{plain}(?:{_balanced(levels - 1)}{plain})*+{CLOSE}" if levels > 1 else f"{OPEN}{plain}{CLOSE}"


_NESTED = f"^[^{OPEN}{CLOSE}]*+(?:{_balanced(_LEVELS)}[^{OPEN}{CLOSE}]*+)*+\\z"


def _outermost_by_pattern(marked: Column) -> Column:
    """The same for texts that one pattern covers: pairs of few levels, none open."""
    inner = _balanced(_LEVELS - 1)

    def outer(span):
        # in the inner pairs a pipe separates nothing of the outer one
        body = replace_each(F.substring(span, 2, F.length(span) - 2), inner, lambda m: F.translate(m, "|", PIPE))
        return F.concat(F.lit(OPEN), F.translate(body, OPEN + CLOSE, INNER_OPEN + INNER_CLOSE), F.lit(CLOSE))

    return replace_each(marked, _balanced(_LEVELS), outer)


def _outermost_by_walk(marked: Column) -> Column:
    """Turn the marks of pairs inside other pairs into inner marks."""
    pieces = F.split(marked, f"(?=[{OPEN}{CLOSE}])", -1)

    def step(state, piece):
        first, depth = F.substring(piece, 1, 1), state["depth"]
        opens = first == OPEN
        closes = (first == CLOSE) & (depth > 0)
        stray = (first == CLOSE) & (depth == 0)
        inner = F.when(opens, depth > 0).when(closes, depth > 1).otherwise(F.lit(False))
        shown = (
            F.when(inner, F.translate(piece, OPEN + CLOSE, INNER_OPEN + INNER_CLOSE))
            .when(stray, F.translate(piece, CLOSE, ""))
            .otherwise(piece)
        )
        after = depth + F.when(opens, 1).when(closes, -1).otherwise(0)
        # a pipe inside an inner span separates nothing of the outer one
        shown = F.when(after > 1, F.translate(shown, "|", PIPE)).otherwise(shown)
        return F.struct(after.alias("depth"), F.concat(state["out"], F.array(shown)).alias("out"))

    start = F.struct(F.lit(0).alias("depth"), F.array().cast("array<string>").alias("out"))
    return F.aggregate(pieces, start, step, lambda state: F.array_join(state["out"], ""))


def mark_outermost(text: Column, opening: str | Column, closing: str | Column, literal: bool = False) -> Column:
    """Put OPEN before and CLOSE after each outermost balanced span, inner marks inside.

    Spans may nest to any depth. Only texts that nest deep, or leave a delimiter
    unmatched, are walked delimiter by delimiter; a constant pattern settles the others. The delimiters are patterns, or
    plain strings if ``literal``.
    """
    return let(
        _mark(text, opening, closing, literal),
        lambda m: F.when(m.rlike(_FLAT), m).when(m.rlike(_NESTED), _outermost_by_pattern(m)).otherwise(_outermost_by_walk(m)),
    )


def strip_marks(text: Column) -> Column:
    return F.translate(text, PIPE + OPEN + CLOSE + INNER_OPEN + INNER_CLOSE, "|")


def trim_space(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+\z", "")


def drop_nested(text: Column, opening: str | Column, closing: str | Column, literal: bool = False) -> Column:
    """Remove balanced spans with all they hold.

    A span left open ends at the last closing delimiter after it, if any.
    """
    dropped = F.regexp_replace(
        mark_outermost(text, opening, closing, literal),
        f"{OPEN}[^{OPEN}{CLOSE}]*+{CLOSE}|{OPEN}[^{OPEN}{CLOSE}]*{INNER_CLOSE}",
        "",
    )
    found = text.contains(closing) if literal else F.regexp_like(text, F.lit(closing))
    return F.when(found, strip_marks(dropped)).otherwise(text)


def upper_first(text: Column) -> Column:
    return F.concat(F.upper(F.substring(text, 1, 1)), F.substring(text, 2, 2_147_483_647))


def lower_first(text: Column) -> Column:
    return F.concat(F.lower(F.substring(text, 1, 1)), F.substring(text, 2, 2_147_483_647))


def url_quote(text: Column) -> Column:
    """Percent-encoding of UTF-8 bytes that keeps ``/``."""
    quoted = F.url_encode(text)
    for found, wanted in (("+", "%20"), ("%2F", "/"), ("*", "%2A")):
        quoted = F.replace(quoted, F.lit(found), F.lit(wanted))
    return quoted


def url_unquote(text: Column) -> Column:
    """The reverse; text that is not well-formed stays as it is."""
    return F.coalesce(F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B"))), text)

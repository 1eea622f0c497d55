"""Template definitions, and what one call of a page says and gives."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.fixed_values import NAMED_PARAMETER, TEMPLATE_NAMESPACE
from corpusloom.functions.entities import unescape
from corpusloom.functions.text import (
    CLOSE,
    OPEN,
    RAW_OPEN,
    let,
    mark_outermost,
    replace_each,
    strip_marks,
    trim_space,
)
from corpusloom.operators.parser_functions import MAGIC_WORDS, evaluate, magic_word

PLAIN_PIPE = "\x0e"  # a pipe in an expanded text: it separates no arguments
_BODY = r"(?:[^{}]++|\{(?!\{)|\}(?!\}))*+"
_ARGUMENT = r"\{\{\{(?!\{)" + _BODY + r"\}\}\}"
INNERMOST = _ARGUMENT + r"|\{\{(?!\{)" + _BODY + r"\}\}"
_SUBST = r"(?i)^(?:subst:|safesubst:)"
# Innermost calls that need no template: arguments, words, functions; none that holds raw braces.
_WORDS = "|".join(("!", *MAGIC_WORDS))
SETTLED_CALL = _ARGUMENT + rf"|\{{\{{(?!\{{)(?=[^|{{}}]*:|(?i:\s*(?:{_WORDS})\s*[|}}]))(?![^{{}}]*{RAW_OPEN})" + _BODY + r"\}\}"
_PASSES = 3  # over one text, in its row; calls nested deeper are settled in rounds
PARAMS = "array<struct<name: string, value: string>>"


# --- definitions ---------------------------------------------------------------


def load_templates(pages: DataFrame, template_namespace: str | Column = TEMPLATE_NAMESPACE) -> tuple[DataFrame, DataFrame]:
    """Definitions among all pages: those whose title is in the template namespace.

    The namespace is a name, or a column of ``pages`` where dumps differ in it. Titles and
    redirects bear the usual name of the namespace, as calls do.
    """
    own = template_namespace if isinstance(template_namespace, Column) else F.lit(template_namespace)
    prefix, usual = F.concat(own, F.lit(":")), F.lit(TEMPLATE_NAMESPACE + ":")
    found = pages.filter(F.col("title").startswith(prefix)).withColumn("_prefix", prefix)
    renamed = found.withColumn("title", F.concat(usual, F.substring("title", F.length("_prefix") + 1, F.length("title"))))
    redirect = F.col("text").startswith("#REDIRECT") & (F.col("_prefix") != usual)
    text = F.when(redirect, F.replace("text", F.concat(F.lit("[["), "_prefix"), F.concat(F.lit("[["), usual))).otherwise(F.col("text"))
    return define_templates(renamed.withColumn("text", text).drop("_prefix"))


def define_templates(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(templates(title, body), redirects(title, target)) of ``pages(page_id, title, text)``.

    Of several definitions of a title the last page's wins.
    """
    target = F.regexp_extract("text", r"\A#REDIRECT[^\n]*?\[\[([^\]]*)\]\]", 1)
    is_redirect = F.col("text").rlike(r"\A#REDIRECT[^\n]*?\[\[[^\]]*\]\]")
    redirects = (
        pages.filter(is_redirect)
        .groupBy("title")
        .agg(F.max_by(target, F.col("page_id")).alias("target"))
    )
    bodies = pages.filter(~is_redirect).select("page_id", "title", unescape(F.col("text")).alias("body"))
    for pattern in (
        r"<!--[\s\S]*?-->",
        r"<noinclude>[\s\S]*?</noinclude>",
        r"<noinclude\s*>[\s\S]*\z",
        r"<noinclude/>",
    ):
        bodies = bodies.withColumn("body", F.regexp_replace("body", pattern, ""))
    only = F.array_join(
        F.regexp_extract_all("body", F.lit(r"<onlyinclude>([\s\S]*?)</onlyinclude>"), F.lit(1)), ""
    )
    shown = F.when(only != "", only).otherwise(F.regexp_replace("body", r"</?includeonly>", ""))
    templates = (
        bodies.withColumn("body", shown)
        .filter("body != ''")
        .groupBy("title")
        .agg(F.max_by("body", "page_id").alias("body"))
    )
    return templates, redirects


# --- one call ------------------------------------------------------------------


def split_parts(text: Column) -> Column:
    """Split at pipes outside links; the text holds no further calls."""

    def protect(t):
        marked = mark_outermost(t, "[[", "]]", literal=True)
        span = f"{OPEN}[^{OPEN}{CLOSE}]*+{CLOSE}"
        guarded = replace_each(marked, span, lambda m: F.translate(m, "|", "\x0f"))
        return F.transform(F.split(guarded, r"\|", -1), lambda p: F.translate(strip_marks(p), "\x0f", "|"))

    return F.when(text.contains("[["), let(text, protect)).otherwise(F.split(text, r"\|", -1))


def bind_parameters(parts: Column) -> Column:
    """ARRAY<STRUCT<name, value>> of the parts behind the title, in their order; the last of a name counts."""
    named = NAMED_PARAMETER

    def placed(part, at, name, value):
        trimmed = F.when(value.contains("]]"), value).otherwise(trim_space(value))
        return F.struct(at.alias("at"), name.alias("name"), trimmed.alias("value"))

    def bind(numbered):
        by_name = F.transform(
            F.filter(numbered, lambda p: p["named"]),
            lambda p: placed(p, p["at"], trim_space(F.regexp_extract(p["part"], named, 1)), F.regexp_extract(p["part"], named, 2)),
        )
        by_number = F.transform(
            F.filter(numbered, lambda p: ~p["named"]),
            lambda p, i: placed(p, p["at"], (i + 1).cast("string"), p["part"]),
        )
        return F.transform(F.array_sort(F.concat(by_name, by_number)), lambda p: F.struct(p["name"].alias("name"), p["value"].alias("value")))

    numbered = F.transform(parts, lambda part, i: F.struct(i.alias("at"), part.rlike(named).alias("named"), part.alias("part")))
    return let(numbered, bind)


def _value_of(params: Column, name: Column) -> Column:
    return F.try_element_at(F.filter(params, lambda p: p["name"] == name), F.lit(-1))["value"]


def _call_body(call: Column) -> Column:
    return F.regexp_replace(call, r"\A\{\{|\}\}\z", "")


def _call_title(parts: Column) -> Column:
    return F.regexp_replace(trim_space(F.get(parts, F.lit(0))), _SUBST, "")


def _is_function(title: Column) -> Column:
    return F.instr(title, ":") > 2


def _rest(parts: Column) -> Column:
    return F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))


def invocations(pages: DataFrame) -> DataFrame:
    """(page_id, pos, name, params) of the innermost calls of every page."""
    calls = pages.select("page_id", F.posexplode(F.regexp_extract_all("text", F.lit(INNERMOST), F.lit(0))).alias("pos", "call"))
    parts = calls.filter(~F.col("call").startswith("{{{")).withColumn("parts", split_parts(_call_body(F.col("call"))))
    params = F.map_from_entries(_last_of_each(bind_parameters(_rest(F.col("parts")))))
    return parts.select("page_id", "pos", _call_title(F.col("parts")).alias("name"), params.alias("params"))


def _last_of_each(params: Column) -> Column:
    """The last of each name, in order."""

    def keep_last(entries):
        return F.filter(entries, lambda e, i: F.coalesce(F.get(entries, i + 1)["name"] != e["name"], F.lit(True)))

    numbered = F.transform(params, lambda p, i: F.struct(p["name"].alias("name"), i.alias("at"), p["value"].alias("value")))
    last = let(F.array_sort(numbered), keep_last)
    in_order = F.array_sort(F.transform(last, lambda e: F.struct(e["at"].alias("at"), e["name"].alias("name"), e["value"].alias("value"))))
    return F.transform(in_order, lambda e: F.struct(e["name"].alias("name"), e["value"].alias("value")))


def argument_value(match: Column, params: Column) -> Column:
    """Value of ``{{{name|default}}}``; nothing where no template is called (``params`` null)."""
    parts = split_parts(F.regexp_replace(match, r"\A\{\{\{|\}\}\}\z", ""))
    named = let(parts, lambda p: F.coalesce(_value_of(params, F.get(p, F.lit(0))), F.get(p, F.lit(1)), F.lit("")))
    return F.when(params.isNull(), "").otherwise(named)


def with_arguments(body: Column, params: Column) -> Column:
    """A body with its innermost arguments in place; nothing else is settled."""
    steps = F.sequence(F.lit(1), F.lit(_PASSES))
    return F.aggregate(steps, body, lambda t, _: replace_each(t, _ARGUMENT, lambda m: argument_value(m, params)))


def _function_value(name: Column, parts: Column, frame: Column) -> Column:
    """Result of a parser function; the one module function gives what its frame holds."""
    args = F.concat(F.array(trim_space(F.regexp_extract(name, r"(?s)^[^:]*:(.*)$", 1))), _rest(parts))
    function = F.substring_index(name, ":", 1)
    convert = (function == "#invoke") & (F.get(args, F.lit(0)) == "convert") & (trim_space(F.get(args, F.lit(1))) == "convert")
    return F.when(convert, F.coalesce(frame, F.lit(""))).otherwise(let(args, lambda a: evaluate(function, a)))


def call_value(call: Column, title: Column, as_of: Column, frame: Column) -> Column:
    """Value of a magic word or parser function; null for a template call."""

    def value(parts):
        return let(
            _call_title(parts),
            lambda name: F.coalesce(
                magic_word(F.lower(name), title, as_of, PLAIN_PIPE), F.when(_is_function(name), _function_value(name, parts, frame))
            ),
        )

    return let(split_parts(_call_body(call)), value)


def settled_text(text: Column, title: Column, as_of: Column, frame: Column | None = None, params: Column | None = None) -> Column:
    """A text with its innermost arguments, magic words and parser functions settled.

    ``params`` are those of the template whose body the text is, ``frame`` what a module function finds there.
    """
    frame = F.lit(None).cast("string") if frame is None else frame
    params = F.lit(None).cast(PARAMS) if params is None else params

    def one(call):
        value = F.when(call.startswith("{{{"), argument_value(call, params)).otherwise(call_value(call, title, as_of, frame))
        return F.coalesce(value, call)

    passes = F.aggregate(F.sequence(F.lit(1), F.lit(_PASSES)), text, lambda t, _: replace_each(t, SETTLED_CALL, one))
    return F.when(text.contains("{{"), passes).otherwise(text)


def eval_parser_functions(pages: DataFrame, as_of: Column) -> DataFrame:
    """Settle innermost arguments, magic words and parser functions in every page."""
    return pages.withColumn("text", settled_text(F.col("text"), F.col("title"), as_of))

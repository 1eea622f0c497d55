import pytest
from pyspark.sql import functions as F

from corpusloom.functions.entities import unescape
from corpusloom.functions.text import drop_nested
from corpusloom.functions.titles import normalize_title, template_title
from corpusloom.operators import markup as M
from corpusloom.operators import sections as S


def run(spark, operator, *texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string").coalesce(1)
    return [r["r"] for r in rows.select("i", operator(F.col("text")).alias("r")).orderBy("i").collect()]


CASES = [
    (M.drop_tables, "x {| a {| b |} c |} y", "x  y"),
    (M.drop_tables, "a {| b", "a {| b"),
    (M.drop_tables, "{| a {| b |} c {| d |} e", " e"),
    (M.drop_tables, "a |} b {| c |} d", "a |} b  d"),
    (M.drop_tables, "{| a | b |} c | d {| e {| f | g |} |}", " c | d "),
    (M.replace_external_links, "see [http://x.org site] now", "see  now"),
    (M.replace_external_links, "a [//x.org label] [//h http://a.b/c/x.png]", "a label "),
    (lambda c: M.replace_external_links(c, keep_labels=True), "see [http://x.org site]", "see site"),
    (M.replace_internal_links, "[[Cat|big cat]]s and [[Dog]]", "big cats and Dog"),
    (M.replace_internal_links, "a [[File:x.png|thumb]] b", "a  b"),
    (M.replace_internal_links, "[[File:x|t|c [[a]] d]] x [[a|b|c]]", " x b|c"),
    (M.replace_internal_links, "[[t|u|v [[in|ner]] w]]s", "v [[in|ner]] ws"),
    (M.replace_internal_links, "[[un [[b]] c", "[[un [[b]] c"),
    (M.replace_internal_links, "[[a]] [[un [[b]] c", "a [[un [[b]] c"),
    (M.replace_internal_links, "[[:File:x]] [[:foo]] [[w:foo|bar]]", " :foo bar"),
    (lambda c: M.replace_internal_links(c, keep_links=True), "[[Cat é|x]]", '<a href="Cat%20%C3%A9">x</a>'),
    (M.drop_switches, "a__TOC__b__NOINDEX__", "ab"),
    (M.unescape_outside_code, "&lt; &lt;syntaxhighlight x&gt;&amp;y&lt;/syntaxhighlight&gt; &amp;", "< &amp;y &"),
    (M.replace_quotes, "'''b''' and ''i''", 'b and "i"'),
    (lambda c: M.replace_quotes(c, html=True), "'''b''' and ''i''", "<b>b</b> and <i>i</i>"),
    (M.drop_tags, 'a<!-- x\n --><br/><ref name="x" /><b>c</b><SPAN k=x>d</span>', "acd"),
    (lambda c: M.drop_tags(c, keep_links=True), "<a href='x'>y</a>", "<a href='x'>y</a>"),
    (M.drop_elements, "a <ref>x <ref>y</ref></ref> b <ul><li>q</li></ul> <li>un", "a  b  <li>un"),
    (M.replace_placeholders, "<math>a</math> <math>b</math> <math>a</math> <MATH x=1>c</math>", "formula_1 formula_2 formula_1 formula_4"),
    (M.replace_placeholders, "<code>z</code>", "codice_1"),
    (M.tidy, "a  b\t c..... <<d>> e,,f,.g\n---\nh", "a b c... «d» e,f.g\nh"),
    (unescape, "&amp;lt; &#65;&#x41; &#x1F600; &zzz; &#xZZ; &#99999999999;", "&lt; AA 😀 &zzz; &#xZZ; &#99999999999;"),
    (normalize_title, "template:  foo_bar_", "Template:Foo bar"),
    (normalize_title, "3001:   the_x", "3001: The x"),
    (template_title, "other:x", "Template:Other:x"),
    (template_title, ":bar", "Bar"),
]


@pytest.mark.parametrize("operator, text, expected", CASES)
def test_step(spark, operator, text, expected):
    assert run(spark, operator, text) == [expected]


LINES = [
    ("==A==\n===B===\n==C==\ntext", ["C.", "text"]),
    ("==A==\n===B===\ntext", ["A.", "B.", "text"]),
    ("intro\n\n==A==\n* x\n: y\n==B!==\nbody\n(drop)\n----\nx}\n{| y\nmore\n==Z==", ["intro", "B!", "body", "more"]),
    ("++T++\n==A==\n++U++\n==B==\n===C===\n++V++\nbody", ["T.", "U.", "V.", "B.", "C.", "body"]),
    ("===A==\n=====\nx", ["", "x"]),
    ("", []),
]


@pytest.mark.parametrize("text, expected", LINES)
def test_section_lines(spark, text, expected):
    assert run(spark, S.section_lines, text) == [expected]


def test_section_options(spark):
    assert run(spark, lambda c: S.section_lines(c, keep_sections=True), "==A==\nx") == [["x"]]
    html = run(spark, S.section_html, "==A==\nintro\n* a\n** b\n# c\n: drop\n; t\nafter")[0]
    assert html == (
        "<h2>A</h2> intro <ul> <li>a</li> <ul> <li>b</li> </ul> </ul> <ol> <li>c</li> </ol> <dl> <dt>t</dt> </dl> after".split(" ")
    )


def test_deep_nesting(spark):
    deep = "a" + "{|" * 400 + "x" + "|}" * 400 + "b"
    assert run(spark, lambda c: drop_nested(c, r"\{\|", r"\|\}"), deep) == ["ab"]


def test_long_texts_do_not_overflow(spark):
    body = "word [[a|b]] ''i'' <b>x</b> &amp; \n" * 20000
    pages = spark.createDataFrame([(1, body)], "page_id long, text string")
    text = M.clean_wikitext(pages).first()["text"]
    assert text == 'word b "i" x & \n' * 20000
    headers = "==h==\n" * 20000 + "end"
    assert run(spark, S.section_lines, headers) == [["h.", "end"]]


def test_cleaning_leaves_plain_text_alone(spark):
    pages = spark.createDataFrame([(1, "Plain text, twice.\nMore.")], "page_id long, text string")
    once = M.clean_wikitext(pages)
    assert once.first()["text"] == "Plain text, twice.\nMore."
    assert M.clean_wikitext(once).first()["text"] == once.first()["text"]


def test_html_output(spark):
    # bold marks become tags that are then among the ignored ones
    pages = spark.createDataFrame([(1, "'''b''' [[Dog|d]] &lt;x")], "page_id long, text string")
    assert M.clean_wikitext(pages, html=True).first()["text"] == 'b <a href="Dog">d</a> <x'

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import templates as T
from corpusloom.operators.expansion import expand_calls, expand_templates, template_lookup
from corpusloom.runtime import checkpoint_dir
from corpusloom.sinks.tables import save_templates
from corpusloom.sources.tables import read_templates

DEFINITIONS = [
    ("Template:T", "1={{{1}}} 2={{{2|d2}}} n={{{name|}}}"),
    ("Template:Inner", "<{{{1|{{PAGENAME}}}}}>"),
    ("Template:Outer", "[{{inner|{{{1}}}}}|{{{x|{{inner}}}}}]"),
    ("Template:Rec", "r{{rec}}"),
    ("Template:Ppp", "{{{{{{p}}}}}}"),
    ("Template:Noi", "a<noinclude>b</noinclude>c<includeonly>d</includeonly><!-- x -->&amp;"),
    ("Template:Only", "zz<onlyinclude>q</onlyinclude>y<onlyinclude>w</onlyinclude>"),
    ("Template:Al", "#REDIRECT [[Template:T]]"),
    ("Template:Convert", "{{#invoke:convert|convert}}"),
    ("Template:Bar", "{{!}} x {{!}}"),
    ("Template:Sw", "{{#switch:{{{1}}}|a=1|b|c=2|#default=3}}"),
    ("Template:Nom", "{{#if:{{{nominee|}}}|{{{{{nominee}}}|z}}|cand}}"),
    ("Template:Emp", "<noinclude>x</noinclude>"),
    ("Template:Dist", "{{unit|x}} and {{twice|{{unit}}}}"),
    ("Template:Unit", "<{{#invoke:convert|convert}}>"),
    ("Template:Twice", "{{{1}}}{{{1}}}"),
    ("Template:Eq", "a=b"),
    ("Template:Show", "[{{{1|no first}}}|{{{a|no a}}}]"),
    ("Template:Low", "{{lc:{{{1}}}}}"),
    ("Template:Pick", "{{{pre{{#if:{{{long|}}}|Long|Short}}|none}}}"),
    ("Template:Conv", "#REDIRECT [[Template:Convert]]"),
    ("Plain", "no template"),
]
CASES = [
    ("{{t|a|b|c|2=B}}", "1=a 2=B n="),
    ("{{T|name= n |x}}", "1=x 2=d2 n=n"),
    ("{{inner}} {{inner|v}}", "<Page> <v>"),
    ("{{outer|p}}", "[<p>|<Page>]"),
    ("{{outer|p|x=q}}", "[<p>|q]"),
    ("{{ppp|p=q|q=r}}{{ppp|q=r|p=q}}", "rr"),
    ("{{noi}} {{only}} {{al|z}}", "acd& qw 1=z 2=d2 n="),
    ("{{convert|5|km}} {{convert|5}}", "5 km "),
    ("{{t|{{bar}}|k}}", "1=| x | 2=k n="),
    ("{{sw|a}}{{sw|b}}{{sw|c}}{{sw|zz}}", "1223"),
    ("{{nom}} {{nom|nominee=noi}}", "cand acd&"),
    ("{{#if: |yes|no}}{{#if:x|yes|no}}{{#if:x|}}{{#if:x}}", "noyes"),
    ("{{#switch:b|a=1|b|c=2|#default=3}} {{#switch:q|a=1|dd}} {{#switch:x| x | y = {{lc:AB}} }}", "2 dd ab"),
    ("{{#ifeq:a| a |eq|ne}}{{#ifeq:a|b|eq|ne}}{{#ifeq:|  |eq|ne}}", "eqne"),
    ('{{#iferror:<span class="error">x</span>|bad|good}} {{#iferror: ok }}', "bad ok"),
    ("{{lc:ABC}}{{uc:abc}}{{ucfirst:abc}}{{lcfirst:ABC}}{{urlencode:a b/c}}{{int: 007}}{{int:x}}{{int:1.5}}", "abcABCAbcaBCa%20b/c7"),
    ("{{#time:Y}}|{{#unknown:x}}|{{#invoke:convert|convert}}", "||"),
    ("{{CURRENTYEAR}}-{{currentmonth}}-{{CURRENTDAY}} {{CURRENTHOUR}} {{CURRENTTIME}} {{FULLPAGENAME}}", "2020-03-04 05 05:06:07 Page"),
    ("{{{1}}} {{{1|d}}}", " "),
    ("un {{ closed", "un {{ closed"),
    ("{{subst:t|a}} {{safesubst:T|b}}", "1=a 2=d2 n= 1=b 2=d2 n="),
    ("{{Template:T|a}}{{emp}}{{nope}}", ""),
    ("{{t|[[x|y]]|[[ a | b]] }}", "1=[[x|y]] 2=[[ a | b]]  n="),
    ("{{t|[[x|{{inner|i}}]] }}", "1=[[x|<i>]]  2=d2 n="),
    ("{{t|{x}}} {{{{{1}}}|x}}", "1={x 2=d2 n=} "),
    ("a | b {{bar}} c", "a | b | x | c"),
    ("plain", "plain"),
    ("{{show|{{eq}}}} {{subst:show|{{eq}}}}", "[no first|b] [a=b|no a]"),
    ("{{subst:low|X{{uc:y}}{{inner|{{uc:z}}}}}} {{twice|{{subst:low|A{{!}}B}}}}", "xy<z> a|ba|b"),
    ("{{subst:t|{{{p|q}}}|k}} {{SafeSubst:T|{{t|{{subst:inner|{{uc:i}}}}}}}}", "1= 2=k n= 1=1=<I> 2=d2 n= 2=d2 n="),
    ("{{subst:#if:{{uc:}}|{{inner|a}}|{{inner|b}}}}", "<b>"),
    ("{{pick|preLong=L|preShort=S}}{{pick|preLong=L|preShort=S|long=1}}{{pick}}", "SLnone"),
    ("{{conv|7|mi}} {{unit|1|km}}", "7 mi <>"),
]


def test_convert_reads_its_frame(spark):
    rows = [
        ("Template:Convert", "{{dist|9|lb}}"),
        ("Template:Dist", "{{unit|x}} and {{twice|{{unit}}}} {{convert|1|kg}}"),
        ("Template:Unit", "<{{#invoke: convert | convert }}>"),
        ("Template:Twice", "{{{1}}}{{{1}}}"),
    ]
    definitions = spark.createDataFrame([(i, t, b) for i, (t, b) in enumerate(rows)], "page_id long, title string, text string")
    pages = spark.createDataFrame([(1, "P", "{{convert|5|km}}|{{unit}}"), (2, "Q", "{{dist|3|m}}")], "page_id long, title string, text string")
    got = expand_templates(pages, *T.load_templates(definitions), F.lit("2020-03-04").cast("timestamp"), max_depth=6)
    shown = {r["page_id"]: r["text"] for r in got.collect()}
    # the outermost frame counts; convert calls itself through dist until the depth bound
    assert shown[1] == "<5 km> and <5 km><5 km> " * 2 + " and  |<>"
    assert shown[2] == "<> and <><> " + "<1 kg> and <1 kg><1 kg> " * 2


@pytest.fixture(scope="module")
def tables(spark):
    pages = spark.createDataFrame(
        [(i, t, b) for i, (t, b) in enumerate(DEFINITIONS)], "page_id long, title string, text string"
    )
    return T.load_templates(pages)


@pytest.fixture(scope="module")
def expanded(spark, tables):
    pages = spark.createDataFrame(
        [(i, "Page", c) for i, (c, _) in enumerate(CASES)], "page_id long, title string, text string"
    )
    as_of = F.lit("2020-03-04 05:06:07").cast("timestamp")
    return {r["page_id"]: r["text"] for r in expand_templates(pages, *tables, as_of).collect()}


@pytest.mark.parametrize("number", range(len(CASES)))
def test_expansion(expanded, number):
    assert expanded[number] == CASES[number][1]


def test_depth_limit_and_shuffled_lookup(spark, tables):
    pages = spark.createDataFrame([(1, "P", "{{rec}} {{t|a}}"), (2, "Q", "{{t|b}}")], "page_id long, title string, text string")
    as_of = F.lit("2020-03-04 05:06:07").cast("timestamp")
    got = expand_templates(pages, *tables, as_of, max_depth=3, broadcast_chars=0)
    assert {r["page_id"]: r["text"] for r in got.collect()} == {1: "rrr 1=a 2=d2 n=", 2: "1=b 2=d2 n="}


def test_later_definition_wins(spark):
    pages = spark.createDataFrame(
        [(1, "Template:X", "old"), (2, "Template:X", "new"), (3, "Template:R", "#REDIRECT [[Template:X]]")],
        "page_id long, title string, text string",
    )
    templates, redirects = T.load_templates(pages)
    assert [tuple(r) for r in templates.collect()] == [("Template:X", "new")]
    assert [tuple(r) for r in redirects.collect()] == [("Template:R", "Template:X")]


def test_repeated_ids_and_further_columns(spark, tables):
    rows = [(1, "A", "{{inner}} {{t|{{inner}}}}", "x"), (1, "B", "{{inner}}", "y"), (None, "C", None, "z"), (None, "D", "", "w")]
    pages = spark.createDataFrame(rows, "page_id long, title string, text string, row string")
    got = expand_templates(pages, *tables, F.lit("2020-03-04 05:06:07").cast("timestamp"))
    assert got.columns == pages.columns
    shown = {r["title"]: (r["page_id"], r["text"], r["row"]) for r in got.collect()}
    assert shown == {"A": (1, "<A> 1=<A> 2=d2 n=", "x"), "B": (1, "<B>", "y"), "C": (None, None, "z"), "D": (None, "", "w")}
    assert expand_templates(pages.limit(0), *tables, F.lit("2020-03-04").cast("timestamp")).collect() == []


def test_rounds_leave_only_what_pages_are_made_of(spark):
    wrap = spark.createDataFrame([(1, "Template:Wrap", "<{{{1}}}>")], "page_id long, title string, text string")
    pages = [(i, f"t{i}", "a " + "{{wrap|" * 8 + f"x{i}" + "}}" * 8 + " b") for i in range(20)]
    pages = spark.createDataFrame(pages, "page_id long, title string, text string")
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(checkpoint_dir(spark))
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    before = len(files.listStatus(root))
    got = expand_templates(pages, *T.load_templates(wrap), F.lit("2020-03-04").cast("timestamp"))
    assert len(files.listStatus(root)) - before <= 10  # the templates, the pages, and what each of eight rounds gives
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    assert {r["page_id"]: r["text"] for r in got.collect()} == {i: "a " + "<" * 8 + f"x{i}" + ">" * 8 + " b" for i in range(20)}


def test_invocations(spark):
    pages = spark.createDataFrame([(1, "P", "x {{t|a|b|c|2=B}} {{outer|{{in ner|k=v}}}}")], "page_id long, title string, text string")
    got = [(r["pos"], r["name"], r["params"]) for r in T.invocations(pages).orderBy("pos").collect()]
    assert got == [(0, "t", {"1": "a", "2": "B", "3": "c"}), (1, "in ner", {"k": "v"})]


def test_a_saved_store_is_joined_where_it_lies(spark, tables, tmp_path):
    save_templates(template_lookup(*tables), "saved_templates", str(tmp_path / "store"), 8)
    spark.sql("DROP TABLE saved_templates")  # as in a later session: the files stay
    store = read_templates(spark, "saved_templates", str(tmp_path / "store"), 8)
    assert {r["name"] for r in store.collect()} >= {"Template:T", "Template:Al"}
    pages = spark.createDataFrame([(1, "P", "{{t|a}} {{al|z}} {{nope}}")], "page_id long, title string, text string")
    got = expand_calls(pages, store, F.lit("2020-03-04").cast("timestamp"), broadcast_chars=0)
    assert [r["text"] for r in got.collect()] == ["1=a 2=d2 n= 1=z 2=d2 n= "]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        calls = spark.createDataFrame([("Template:T", 1)], "name string, n long")
        plan = calls.join(store, "name", "left")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE saved_templates")
    assert plan.count("Exchange hashpartitioning") == 1  # of the calls alone

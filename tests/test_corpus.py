import bz2
import gzip
import math

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrameReader, DataFrameWriter
from pyspark.sql import functions as F

from catalog.common import spread_table, table
from corpusloom.operators import abbreviations as A
from corpusloom.operators import lemmas as L
from corpusloom.operators import links as K
from corpusloom.operators import key_filter as B
from corpusloom.operators.pages import article_filter
from corpusloom.operators.templates import load_templates
from corpusloom.plans.extract import extract_corpus
from corpusloom.plans.index import rank_and_search
from corpusloom.sinks import tables as W
from corpusloom.sources import tables as R
from corpusloom.sources import wiki_xml as X

DUMP = """<mediawiki xml:lang="en">
  <siteinfo>
    <base>http://en.example.org/wiki/Main_Page</base>
    <namespaces><namespace key="0" /><namespace key="10" case="x">Vorlage</namespace></namespaces>
  </siteinfo>
%s</mediawiki>
"""
PAGE = """  <page>
    <title>%s</title>
    <ns>%d</ns>
    <id>%d</id>%s
    <revision>
      <id>99</id>
      <text xml:space="preserve" bytes="5">%s</text>
    </revision>
  </page>
"""


def _dump(pages):
    return DUMP % "".join(PAGE % p for p in pages)


@pytest.mark.parametrize("compressed", [False, True])
def test_dump(spark, tmp_path, compressed):
    pages = [(f"T{i} &amp; x", 0, i, '\n    <redirect title="Q" />' if i == 3 else "", f" line {i}\n&lt;ref&gt; ") for i in range(50)]
    path = tmp_path / ("d.xml.bz2" if compressed else "d.xml")
    data = _dump(pages + [("Empty", 1, 77, "", "")]).encode()
    path.write_bytes(bz2.compress(data) if compressed else data)
    rows = {r["page_id"]: r for r in X.read_wiki_dump(spark, str(path)).collect()}
    assert len(rows) == 51
    assert tuple(rows[5]) == (5, "T5 & x", 0, None, " line 5\n<ref> ")
    assert rows[3]["redirect"] == "Q" and rows[77]["text"] == "" and rows[77]["ns"] == 1
    info = X.read_siteinfo(spark, str(path))
    assert tuple(info.drop("file").first()) == ("http://en.example.org/wiki", [(0, ""), (10, "Vorlage")])
    assert X.template_namespace(info).first()["template_namespace"] == "Vorlage"


def test_files_of_different_siteinfo(spark, tmp_path):
    for name, namespace in (("a", "Vorlage"), ("b", "Modèle")):
        header = f'<siteinfo><base>http://{name}.org/wiki/Main</base><namespaces><namespace key="10">{namespace}</namespace></namespaces></siteinfo>'
        body = PAGE % (f"{namespace}:Sig", 10, 1, "", f"#REDIRECT [[{namespace}:Own {name}]]") + PAGE % (f"{namespace}:Own {name}", 10, 2, "", name)
        (tmp_path / f"{name}.xml").write_text(f"<mediawiki>\n{header}\n{body}</mediawiki>")
    (tmp_path / "c.xml").write_text(PAGE % ("Template:C", 10, 3, "", "c"))
    read = X.read_wiki_dump(spark, str(tmp_path / "*.xml"), with_file=True)
    pages = X.with_siteinfo(read, X.read_siteinfo(spark, str(tmp_path / "*.xml")))
    found = {r["title"]: (r["url_base"], r["template_namespace"]) for r in pages.collect()}
    assert found["Vorlage:Sig"] == ("http://a.org/wiki", "Vorlage") and found["Modèle:Sig"] == ("http://b.org/wiki", "Modèle")
    assert found["Template:C"] == (None, "Template")
    templates, redirects = load_templates(pages, F.col("template_namespace"))
    assert sorted(map(tuple, templates.collect())) == [("Template:C", "c"), ("Template:Own a", "a"), ("Template:Own b", "b")]
    assert {r["target"] for r in redirects.collect()} <= {"Template:Own a", "Template:Own b"}
    with pytest.raises(ValueError):
        X.with_siteinfo(read.drop("file"), X.read_siteinfo(spark, str(tmp_path / "*.xml")))


def test_page_files(spark, tmp_path):
    for name, title, text in (("a", "Zoo", "z"), ("b", "Ant &amp; bee", "&lt;b&gt;")):
        (tmp_path / f"{name}.xml").write_text(PAGE % (title, 0, 4, "", text))
    (tmp_path / "c.xml").write_text("<page><id>3</id><text>no title</text></page>")
    got = sorted(map(tuple, X.read_page_files(spark, str(tmp_path / "*.xml")).collect()))
    assert got == [(0, "Ant & bee", "<b>"), (1, "Zoo", "z")]


def test_page_files_are_written_in_folders_of_bounded_size(spark, tmp_path):
    pages = [(PAGE % (f"T{i:04d}", 0, i, "", f"text {i}"),) for i in range(1100)]
    W.write_page_files(spark.createDataFrame(pages, "value string").coalesce(1), str(tmp_path / "files"))
    folders = [[f.name for f in d.iterdir()] for d in (tmp_path / "files").glob("folder=*")]
    assert sorted(map(len, folders)) == [76, 1024] and all(name.endswith(".txt") for names in folders for name in names)
    got = X.read_page_files(spark, str(tmp_path / "files")).orderBy("page_id").collect()
    assert [tuple(r) for r in got] == [(i, f"T{i:04d}", f"text {i}") for i in range(1100)]


def test_local_page_files_are_opened_by_the_tasks(spark, tmp_path, monkeypatch):
    """Hadoop starts a process for each file it writes, and Spark's reader copies its settings for each it reads."""

    def refused(*args, **options):
        raise AssertionError("one call of Hadoop for each file")

    pages = [(PAGE % (f"Tä{i:04d}", 0, i, "", f"text {i}"),) for i in range(300)] + [(None,)]
    monkeypatch.setattr(DataFrameWriter, "text", refused)
    monkeypatch.setattr(DataFrameReader, "text", refused)
    path = str(tmp_path / "a b" / "files")
    W.write_page_files(spark.createDataFrame(pages, "value string").repartition(3), path)
    files = [f for f in (tmp_path / "a b" / "files").rglob("*") if f.is_file() and f.name != "_SUCCESS"]
    assert sorted(f.read_bytes() for f in files) == sorted(((v or "") + "\n").encode() for (v,) in pages)
    with pytest.raises(AnalysisException):
        W.write_page_files(spark.createDataFrame(pages, "value string"), path)
    got = X.read_page_files(spark, path).orderBy("page_id").collect()
    assert [tuple(r) for r in got] == [(i, f"Tä{i:04d}", f"text {i}") for i in range(300)]


def test_folders_with_other_files_are_read_by_spark(spark, tmp_path):
    W.write_page_files(spark.createDataFrame([(PAGE % ("Zoo", 0, 4, "", "z"),)], "value string"), str(tmp_path / "files"))
    (folder,) = (tmp_path / "files").glob("folder=*")
    with gzip.open(folder / "more.xml.gz", "wt") as file:
        file.write(PAGE % ("Ant", 0, 5, "", "a"))
    got = sorted(map(tuple, X.read_page_files(spark, str(tmp_path / "files")).collect()))
    assert got == [(0, "Ant", "a"), (1, "Zoo", "z")]


def test_spread_table_follows_rows_not_files(spark, tmp_path):
    """One row group in a file of many partitions leaves all rows in one of them."""
    rows = spark.range(20_000).select(F.col("id").alias("doc_id"), F.sha2(F.col("id").cast("string"), 256).alias("text"))
    rows.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        assert table(spark, str(tmp_path), "documents").rdd.getNumPartitions() >= 8
        spread = spread_table(spark, str(tmp_path), "documents")
        sizes = spread.groupBy(F.spark_partition_id()).count().collect()
        assert len(sizes) == 8 and max(r["count"] for r in sizes) < 4_000
        assert spread.distinct().count() == 20_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_table_readers(spark, tmp_path):
    def file(name, text):
        (tmp_path / name).write_bytes(text.replace("\n", "\r\n").encode())
        return str(tmp_path / name)

    ids = R.read_page_ids(spark, file("ids", '0 "Two Words"\n1 One\n2 "a ""q"" b"\n'))
    assert [tuple(r) for r in ids.collect()] == [(0, "Two Words"), (1, "One"), (2, 'a "q" b')]
    links = R.read_page_links(spark, file("links", "0\n1 5 6\n"))
    assert [tuple(r) for r in links.collect()] == [(0, []), (1, [5, 6])]
    contents = R.read_contents(spark, file("contents", "0\ta b\tc\n1\n2\t\n"))
    assert [tuple(r) for r in contents.collect()] == [(0, "a b\tc"), (1, ""), (2, "")]
    assert tuple(R.read_transitions(spark, file("m", "4 3 0.25\n")).first()) == (4, 3, 0.25)
    assert tuple(R.read_vector(spark, file("v", "4 1.5e-05\n")).first()) == (4, 1.5e-05)
    assert tuple(R.read_page_rank(spark, file("r", "0 9 0.5\n")).first()) == (0, 9, 0.5)


def _files(folder):
    return {str(f.parent.relative_to(folder)): f.stat().st_size for f in sorted(folder.glob("folder=*/file=*/*.txt"))}


def test_document_files(spark, tmp_path):
    docs = spark.range(100).select("id", F.concat(F.lpad(F.col("id").cast("string"), 9999, "0"), F.lit("\n")).alias("value"))
    W.write_documents(docs.repartition(7), str(tmp_path / "out"), "200K", order=["id"])
    files = _files(tmp_path / "out")
    assert list(files) == [f"folder=AA/file=wiki_{n:02d}" for n in range(5)]
    assert list(files.values()) == [20 * 10001] * 5  # twenty of 10,001 bytes fit into 204,800
    first = spark.read.text(str(tmp_path / "out/folder=AA/file=wiki_00")).filter("value <> ''")
    assert sorted(int(r["value"][-4:]) for r in first.collect()) == list(range(20))
    W.write_documents(docs.limit(0), str(tmp_path / "none"))
    assert _files(tmp_path / "none") == {}
    with pytest.raises(ValueError):
        W.file_bytes("10K")
    assert W.file_bytes("1M") == 1024**2 and W.file_bytes("300000") == 300000


def test_a_large_document_has_its_own_file(spark, tmp_path):
    large = [(n, "x" * (900_000 if n == 150 else 400)) for n in range(301)]
    docs = spark.createDataFrame([*large, (None, None)], "n long, value string")
    W.write_documents(docs, str(tmp_path / "out"), "500K", order=["n"])
    assert list(_files(tmp_path / "out").values()) == [150 * 401, 900_001, 150 * 401]
    W.write_documents(docs, str(tmp_path / "packed"), "1M", order=["n"])
    assert list(_files(tmp_path / "packed").values()) == [300 * 401 + 900_001]


def test_folders_hold_a_hundred_files(spark):
    docs = spark.range(730).select("id", F.repeat(F.lit("y"), 99).alias("value"))
    packed = W.pack_documents(docs, 300, ["id"]).groupBy("folder").agg(F.countDistinct("file").alias("n"), F.min("place").alias("first"))
    assert sorted(map(tuple, packed.select("folder", "n").collect())) == [("AA", 100), ("AB", 100), ("AC", 44)]
    assert [W.folder_name(n) for n in (0, 25, 26, 675, 676, 701, 702)] == ["AA", "AZ", "BA", "ZZ", "AAA", "AAZ", "ABA"]


def test_links(spark):
    pages = spark.createDataFrame(
        [(0, '<a href="B">b</a> <A class=x href=\'C%20d\'>c</A><a href="B">again</a> <a name="x">no</a>'), (1, "<a href=A#top>x</a>")],
        "page_id long, text string",
    )
    links = K.extract_links(pages)
    assert sorted(map(tuple, links.collect())) == [(0, "B"), (0, "C d"), (1, "A#top")]
    ids = spark.createDataFrame([(0, "A"), (1, "B"), (2, "c d")], "page_id long, title string")
    assert sorted(map(tuple, K.resolve_links(links, ids).collect())) == [(0, 1)]
    normal = K.resolve_links(links, ids, normalize=True)
    assert sorted(map(tuple, normal.collect())) == [(0, 1), (0, 2), (1, 0)]
    redirects = spark.createDataFrame([("B", "a")], "title string, target string")
    hopped = K.resolve_links(links, ids, normalize=True, redirects=redirects, min_hot_rows=1)
    assert sorted(map(tuple, hopped.collect())) == [(0, 0), (0, 2), (1, 0)]
    assert sorted(map(tuple, K.unresolved_links(links, ids).collect())) == [(0, "C d"), (1, "A#top")]


def test_filter_misses_no_known_title(spark):
    known = spark.range(3000).select(F.concat(F.lit("page "), F.col("id")).alias("title"))
    links = spark.range(60_000).select("id", F.concat(F.lit("page "), F.col("id")).alias("title"))
    links = links.unionByName(spark.createDataFrame([(-1, None), (-2, "page 7"), (-3, "")], "id long, title string"))
    kept = [r["id"] for r in B.keep_known(links, known.unionByName(known.limit(50)), "title").collect()]
    assert set(range(3000)) <= set(kept) and -2 in kept and -1 not in kept
    assert len(kept) == len(set(kept)) < 2 * 3001


def test_filter_of_no_titles_and_of_too_many(spark):
    links = spark.createDataFrame([(0, "a"), (1, None)], "src long, title string")
    assert B.keep_known(links, links.select("title").limit(0), "title").count() == 0
    known = spark.range(B.BLOCK_WORDS * B.FULL_WORD + 1).select(F.col("id").cast("string").alias("title"))
    assert B.keep_known(links, known, "title", max_bytes=8 * B.BLOCK_WORDS).count() == 2  # no filter, nothing lost
    assert B.filter_words(10**9) is None and B.filter_words(10**8) == 1 << 23
    assert B.filter_words(0) == B.filter_words(2048) == B.BLOCK_WORDS and B.filter_words(2049) == 2 * B.BLOCK_WORDS


def test_article_filter(spark):
    pages = spark.createDataFrame(
        [("A", None), ("Talk:A", None), ("w:A", None), ("Templates", None), ("R", "A")], "title string, redirect string"
    )
    assert {r["title"] for r in article_filter(pages).collect()} == {"A", "w:A"}


def test_tokens_and_lemmas(spark):
    text = 'He said, "The systems of 3,000 women don\'t fail." Cities (two) boxes; glass\'s leaves... system'
    tokens = spark.createDataFrame([(text,)], "t string").select(L.tokenize(F.col("t"))).first()[0]
    assert tokens[:6] == ["He", "said", ",", "``", "The", "systems"]
    assert "3,000" in tokens and tokens[-2:] == ["...", "system"]
    lexicon = spark.createDataFrame([(w,) for w in "system woman city box glass leaf goose mouse".split()], "lemma string")
    exceptions = spark.createDataFrame([("geese", "goose"), ("leaves", "leaf")], "form string, lemma string")
    docs = spark.createDataFrame(
        [(1, "Systems women cities boxes glass leaves geese cities the unknowns"), (2, "nothing here"), (3, "")],
        "doc_id long, content string",
    )
    got = {r["doc_id"]: r["content"] for r in L.lemmatize(docs, lexicon, ["the"], exceptions).collect()}
    assert got == {1: "system woman city box glass leaf goose city unknowns", 2: "nothing here", 3: ""}


ABBREVIATED = (
    ["He met Dr. Smith at e.g. a fair. Mr. J. Jones said no... Then (vs. nine) left the fair."] * 8
    + ["The fair was there. A fair it was, said the doctor. It was no dr at all, e.g."]
    + ["", None, "...", "."]
)


def _abbreviation_tokens(spark):
    docs = spark.createDataFrame(list(enumerate(ABBREVIATED)), "doc_id long, content string")
    own = A.attach_abbreviations(docs, A.learn_abbreviations(docs))
    return own.select("doc_id", "abbreviations", L.tokenize(F.col("content"), F.col("abbreviations")).alias("t")).orderBy("doc_id").collect()


def test_abbreviations_keep_their_stop(spark, monkeypatch):
    rows = _abbreviation_tokens(spark)
    assert rows[0]["t"] == (
        "He met Dr. Smith at e.g. a fair . Mr. J. Jones said no ... Then ( vs. nine ) left the fair .".split()
    )
    assert rows[8]["t"][-7:] == ["no", "dr", "at", "all", ",", "e.g", "."]  # at the end of a text the stop is the sentence's
    assert rows[8]["abbreviations"] == ["e.g"] and "fair" not in rows[0]["abbreviations"]
    assert [r["t"] for r in rows[9:]] == [[], None, ["..."], ["."]]
    monkeypatch.setattr(A, "LISTED", 0)  # joined instead of listed
    joined = _abbreviation_tokens(spark)
    assert [(r["t"], sorted(r["abbreviations"])) for r in joined] == [(r["t"], sorted(r["abbreviations"])) for r in rows]


@pytest.mark.parametrize("bound", [1_000_000, 0])
def test_lemmas_of_texts_with_abbreviations(spark, monkeypatch, bound):
    monkeypatch.setattr(L, "BROADCAST_ROWS", bound)
    docs = spark.createDataFrame([(1, "Dr. Cats sat. Cats"), (1, "Dr. Cats sat."), (2, None), (3, "")], "doc_id long, content string")
    lexicon = spark.createDataFrame([("cat",)], "lemma string")
    known = spark.createDataFrame([("dr",)], "form string")
    got = L.lemmatize(docs, lexicon, [], abbreviations=known)
    assert got.columns == docs.columns
    rows = sorted((r["doc_id"], r["content"] or "") for r in got.collect())
    assert rows == [(1, "dr. cat sat ."), (1, "dr. cat sat . cat"), (2, ""), (3, "")]


def test_extracted_contents_keep_abbreviations(spark):
    pages = [(i, f"Page {i}", None, "The fair of Dr. Smith was large. It had a fair. The smith left.") for i in range(8)]
    raw = spark.createDataFrame(pages, "page_id long, title string, redirect string, text string")
    lexicon = spark.createDataFrame([("fair",)], "lemma string")
    for learn, token in ((True, "dr."), (False, "dr")):
        contents = extract_corpus(raw, lexicon, stopwords=[], abbreviations=learn)["contents"].collect()
        assert len(contents) == 8 and all(token in r["content"].split(" ") for r in contents)


def test_abbreviations_score_by_counts(spark):
    docs = spark.createDataFrame([(0, "Dr. " * 6 + "no. " * 6 + "no " * 6 + "word " * 60)], "doc_id long, content string")
    got = {r["form"]: (r["with_stop"], r["without"], r["score"]) for r in A.learn_abbreviations(docs).collect()}
    p = 12 / 78
    assert set(got) == {"dr"} and got["dr"][:2] == (6, 0)
    assert got["dr"][2] == pytest.approx(2 * 6 * (math.log(0.99) - math.log(p)) * math.exp(-2))
    assert A.learn_abbreviations(docs.limit(0)).count() == 0


def test_whole_way(spark, tmp_path):
    words = {"Sun": "sun sun sun star star star", "Star": "star star star star", "Moon": "moon moon moon sun", "Earth": "rock", "Mars": "rust"}
    pages = spark.createDataFrame(
        [(i, t, None, f"'''{t}''' {w} [[Sun]] {{{{note|x}}}}") for i, (t, w) in enumerate(words.items())]
        + [(9, "Template:Note", None, "noted {{{1}}} [[Star]]"), (10, "Talk:Sun", None, "chat")],
        "page_id long, title string, redirect string, text string",
    )
    lexicon = spark.createDataFrame([("sun",), ("star",)], "lemma string")
    corpus = extract_corpus(pages, lexicon, as_of=F.lit("2020-01-01").cast("timestamp"))
    assert [tuple(r) for r in corpus["page_ids"].orderBy("page_id").collect()] == list(
        enumerate(["Earth", "Mars", "Moon", "Star", "Sun"])
    )
    assert sorted(map(tuple, corpus["edges"].collect())) == [(src, dst) for src in range(5) for dst in (3, 4)]
    found = rank_and_search(spark, str(tmp_path / "index"), "star", corpus, count=2)
    assert {r["title"] for r in found.collect()} == {"Star", "Sun"}


def test_lemmas_of_repeated_ids_beyond_the_broadcast(spark, monkeypatch):
    rows = [(1, "cats run"), (1, "dogs run"), (None, "cats"), (None, "boxes"), (2, "")]
    docs = spark.createDataFrame(rows, "doc_id long, content string")
    lexicon = spark.createDataFrame([("cat",), ("dog",), ("box",)], "lemma string")
    near = sorted(map(tuple, L.lemmatize(docs, lexicon).collect()), key=str)
    monkeypatch.setattr(L, "BROADCAST_ROWS", 0)
    far = L.lemmatize(docs, lexicon)
    assert far.columns == docs.columns
    assert sorted(map(tuple, far.collect()), key=str) == near == sorted([(1, "cat run"), (1, "dog run"), (None, "cat"), (None, "box"), (2, "")], key=str)


def test_lemmatize_shuffles_only_words_that_may_change(spark, monkeypatch):
    monkeypatch.setattr(L, "BROADCAST_ROWS", 0)
    shuffled = []
    monkeypatch.setattr(L, "keep_known", lambda rows, known, key: shuffled.append(B.keep_known(rows, known, key)) or shuffled[-1])
    contents = spark.createDataFrame([(1, "cats sleep"), (1, "cats sleep"), (2, ""), (3, None)], "doc_id long, content string")
    got = L.lemmatize(contents, spark.createDataFrame([("cat",)], "lemma string"), stopwords=()).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, [(1, "cat sleep"), (1, "cat sleep"), (2, ""), (3, None)]))
    assert "cats" in {r["form"] for r in shuffled[0].collect()} and shuffled[0].count() < 4

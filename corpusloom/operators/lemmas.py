"""Content words: tokens, stop words, noun lemmas."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.fixed_values import CONTENT_STOPWORDS, NOUN_ENDINGS
from corpusloom.operators.abbreviations import abbreviation_form, attach_abbreviations
from corpusloom.operators.key_filter import keep_known
from corpusloom.runtime import BROADCAST_BYTES, BROADCAST_ROWS, checkpoint, scratch_path

# Spacing rules of the Penn Treebank convention, in their order. A full stop before
# white space ends a sentence, unless the word before it is a given abbreviation.
_FINAL_STOP = (r"([^.\s])\.([\])}>\"']*)(\s|$)", r"$1 . $2$3")
_TREEBANK = (
    (r'(^|[ (\[{<\s])"', r"$1 `` "),
    (r"\.\.\.", r" ... "),
    (r"([,:])([^0-9])", r" $1 $2"),
    (r"([,:])$", r" $1 "),
    (r"[;@#$%&]", r" $0 "),
    _FINAL_STOP,
    (r"[?!]", r" $0 "),
    (r"[\]\[(){}<>]", r" $0 "),
    (r"--", r" -- "),
    (r'"', r" '' "),
    (r"([^'])' ", r"$1 ' "),
    (r"'([sSmMdD]) ", r" '$1 "),
    (r"'(ll|LL|re|RE|ve|VE) ", r" '$1 "),
    (r"n't ", r" n't "),
    (r"N'T ", r" N'T "),
)


def _split_stops(spaced: Column, abbreviations: Column) -> Column:
    """Final stops cut off, but for those of abbreviations in front of another word."""
    def cut(row, word, i):
        kept = F.coalesce(F.array_contains(row["known"], abbreviation_form(word)), F.lit(False))
        return F.when(kept & (i < F.size(row["words"]) - 1), word).otherwise(F.regexp_replace(word, *_FINAL_STOP))

    # one struct, so that the words and the list are made once a text and not once a word
    once = F.array(F.struct(F.split(F.rtrim(spaced), " ").alias("words"), abbreviations.alias("known")))
    joined = F.transform(once, lambda row: F.array_join(F.transform(row["words"], lambda w, i: cut(row, w, i)), " "))
    return F.concat(joined[0], F.lit(" "))


def tokenize(text: Column, abbreviations: Column | None = None) -> Column:
    """Word and punctuation tokens of a text.

    The forms of the array ``abbreviations`` (see ``attach_abbreviations``) keep their full stop, except
    at the end of the text.
    """
    spaced = F.concat(F.regexp_replace(text, r"\s+", " "), F.lit(" "))
    for pattern, replacement in _TREEBANK:
        if abbreviations is not None and (pattern, replacement) == _FINAL_STOP:
            spaced = _split_stops(spaced, abbreviations)
        else:
            spaced = F.regexp_replace(spaced, pattern, replacement)
    return F.filter(F.split(spaced, r"\s+"), lambda t: t != "")


def content_tokens(text: Column, stopwords=CONTENT_STOPWORDS, abbreviations: Column | None = None) -> Column:
    """Lower-cased tokens that are no stop words; repeats stay."""
    lowered = F.transform(tokenize(text, abbreviations), F.lower)
    stop = list(stopwords)
    return F.filter(lowered, lambda t: ~t.isin(stop)) if stop else lowered


def noun_forms(lexicon: DataFrame, exceptions: DataFrame | None = None) -> DataFrame:
    """(form, lemma) for every inflected form of ``lexicon(lemma)``, one row per form.

    A word of the lexicon is its own form. The shortest lemma wins, then the earlier
    ending; irregular forms come from ``exceptions(form, lemma)``.
    """
    lemma = F.col("lemma")
    built = [F.struct(F.lit(0).alias("rule"), lemma.alias("form"))]
    for number, (ending, base) in enumerate(NOUN_ENDINGS, start=1):
        stem = F.expr(f"left(lemma, length(lemma) - {len(base)})")
        form = F.when(lemma.endswith(base) if base else F.lit(True), F.concat(stem, F.lit(ending)))
        built.append(F.struct(F.lit(number).alias("rule"), form.alias("form")))
    forms = lexicon.select("lemma", F.explode(F.array(*built)).alias("f")).select("lemma", "f.rule", "f.form")
    if exceptions is not None:
        irregular = exceptions.join(lexicon, "lemma", "left_semi").select("lemma", F.lit(0).alias("rule"), "form")
        regular = forms.join(exceptions.select("form").distinct(), "form", "left_anti")
        forms = regular.unionByName(forms.filter("form = lemma")).unionByName(irregular)
    return (
        forms.filter("form IS NOT NULL AND form != ''")
        .groupBy("form")
        .agg(F.min(F.struct(F.length("lemma").alias("n"), "rule", "lemma"))["lemma"].alias("lemma"))
    )


def lemmatize(
    contents: DataFrame,
    lexicon: DataFrame,
    stopwords=CONTENT_STOPWORDS,
    exceptions: DataFrame | None = None,
    abbreviations: DataFrame | None = None,
) -> DataFrame:
    """Replace ``content`` by its lemmas, separated by single spaces.

    At most BROADCAST_ROWS forms that change are sent to every worker and looked up in
    place, without a shuffle. Beyond that each row collects its own short list of
    them, which is then applied to its tokens. Rows of one id, or without one, stay rows of their own.
    Forms of ``abbreviations(form)`` (see ``learn_abbreviations``) keep their full stop;
    tokens are then stored before they are looked up.
    """
    if abbreviations is not None:
        contents = attach_abbreviations(contents, abbreviations, "content", "_abbreviations")
    own = None if abbreviations is None else F.col("_abbreviations")
    changing = checkpoint(noun_forms(lexicon, exceptions).filter("form != lemma"))
    rows, size = changing.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("form") + F.octet_length("lemma")), F.lit(0))).first()
    if rows <= BROADCAST_ROWS and size <= BROADCAST_BYTES:
        table = changing.toArrow()
        forms = dict(zip(table.column("form").to_pylist(), table.column("lemma").to_pylist()))
        shared = contents.sparkSession.sparkContext.broadcast(forms)

        @F.arrow_udf("string")
        def looked_up(lists: Iterator[pa.Array]) -> Iterator[pa.Array]:
            known = shared.value
            for batch in lists:
                texts = [None if t is None else " ".join([known.get(w, w) for w in t]) for t in batch.to_pylist()]
                yield pa.array(texts, pa.string())

        if own is None:
            return contents.withColumn("content", looked_up(content_tokens(F.col("content"), stopwords)))
        tokens = checkpoint(contents.withColumn("content", content_tokens(F.col("content"), stopwords, own)))
        return tokens.withColumn("content", looked_up(F.col("content"))).drop("_abbreviations")
    # tokens hold no white space and are never empty: as one text, in compressed columns, they are a fraction of the list
    joined = F.array_join(content_tokens(F.col("content"), stopwords, own), " ")
    path = scratch_path(contents.sparkSession, "tokens")
    contents.withColumn("content", joined).withColumn("_row", F.monotonically_increasing_id()).write.parquet(path)
    tokens = contents.sparkSession.read.parquet(path)
    words = F.filter(F.split("content", " "), lambda t: t != "")
    distinct = tokens.select("_row", F.explode(F.array_distinct(words)).alias("form"))
    distinct = keep_known(distinct, changing, "form")  # most words do not change: they are not shuffled
    changed = (
        distinct.join(changing, "form")
        .groupBy("_row")
        .agg(F.map_from_entries(F.collect_list(F.struct("form", "lemma"))).alias("_changed"))
    )
    applied = F.when(
        F.col("_changed").isNotNull(),
        F.array_join(F.transform(words, lambda t: F.coalesce(F.col("_changed")[t], t)), " "),
    ).otherwise(F.col("content"))
    return tokens.join(changed, "_row", "left").withColumn("content", applied).drop("_changed", "_row", "_abbreviations")

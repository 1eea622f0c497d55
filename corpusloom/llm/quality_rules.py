"""Quality rules on documents and on their hosts, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import let
from corpusloom.llm.common import SPACES, join_lookup, whole_text, words_of
from corpusloom.runtime import checkpoint

SYMBOLS = "#*$%&|<>"
WINDOW = 5  # words
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20
MAX_HOST_RATE = 0.5


def _covered(hashes: Column) -> Column:
    """Words inside repeated windows, from the hashes of all windows in order.

    Equal hashes are neighbours once sorted with their positions; the words that the
    found positions cover are counted from the gaps between them.
    """

    def neighbours(pairs):
        repeated = F.filter(
            F.transform(
                pairs,
                lambda p, k: F.when(
                    p["h"].eqNullSafe(F.get(pairs, k - 1)["h"]) | p["h"].eqNullSafe(F.get(pairs, k + 1)["h"]), p["at"]
                ),
            ),
            lambda at: at.isNotNull(),
        )
        return let(
            F.sort_array(repeated),
            lambda ats: F.aggregate(
                F.transform(ats, lambda at, k: F.coalesce(F.least(F.get(ats, k + 1) - at, F.lit(WINDOW)), F.lit(WINDOW))),
                F.lit(0),
                lambda total, n: total + n,
            ),
        )

    return let(F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("at")))), neighbours)


def repeat_words(words: Column) -> Column:
    """How many words lie in a window of five that the text has twice or more."""
    hashed = F.transform(
        F.slice(words, 1, F.greatest(F.size(words) - (WINDOW - 1), F.lit(0))),
        lambda w, i: F.xxhash64(w, *(F.get(words, i + k) for k in range(1, WINDOW))),
    )
    return let(
        hashed,
        lambda hs: F.when(F.size(F.array_distinct(hs)) == F.size(hs), F.lit(0)).otherwise(_covered(hs)),
    )


def duplicate_lines(text: Column) -> Column:
    """How many lines with a word equal an earlier line."""
    return let(
        F.filter(F.split(text, "\n", -1), lambda line: F.translate(line, SPACES, "") != F.lit("")),
        lambda lines: F.size(lines) - F.size(F.array_distinct(lines)),
    )


def with_rule_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the counts of the document rules, and ``base_failed``.

    ``n_words``; ``word_chars``, their code points; ``n_symbols``; ``n_dup_lines``;
    ``n_repeat_words``. A document fails with fewer than 10 words or with more than
    20 percent of its words in repeated windows; a null text has no words, so it fails.
    Windows are compared by 64-bit hashes within one text.
    """
    body = whole_text(text)
    per_words = let(
        words_of(body), lambda ws: F.struct(F.size(ws).alias("n"), repeat_words(ws).alias("repeated"))
    )
    counted = docs.withColumn("n_words", per_words)
    return counted.withColumns(
        {
            "n_words": F.col("n_words.n").cast("long"),
            "word_chars": F.length(F.translate(body, SPACES, "")).cast("long"),
            "n_symbols": (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("long"),
            "n_dup_lines": duplicate_lines(body).cast("long"),
            "n_repeat_words": F.col("n_words.repeated").cast("long"),
        }
    ).withColumn(
        "base_failed",
        (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
    )


def host_verdicts(judged: DataFrame, host: str = "source", max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """One row per host: ``host_documents``, ``host_failures``, ``host_rate``, ``host_kept``.

    The failure rate is shrunk toward all hosts by a beta prior. Its mean m is the share
    of failed documents; its strength comes from the spread of the hosts' rates about m
    beyond what chance explains: with v that variance, strength = m (1 - m) / v - 1, at
    least 1. Where rates spread no more than by chance, the prior alone decides. A
    host is kept unless its shrunk rate is above ``max_rate``.
    """
    hosts = checkpoint(
        judged.groupBy(host).agg(
            F.count("*").alias("host_documents"), F.sum(F.col("base_failed").cast("long")).alias("host_failures")
        )
    )
    n, f = F.col("host_documents"), F.col("host_failures")
    mean = hosts.agg((F.sum(f) / F.sum(n)).alias("m"))
    spread = hosts.crossJoin(F.broadcast(mean)).agg(  # the mean is one row
        F.first("m").alias("m"),
        (F.sum(n * (f / n - F.col("m")) * (f / n - F.col("m"))) / F.sum(n)).alias("seen"),
        (F.count("*") * F.first("m") * (1 - F.first("m")) / F.sum(n)).alias("chance"),
    )
    excess = F.col("seen") - F.col("chance")
    prior = spread.select(
        "m",
        F.when(excess > 0, F.greatest(F.col("m") * (1 - F.col("m")) / excess - 1, F.lit(1.0))).alias("strength"),
    )
    shrunk = F.when(F.col("strength").isNull(), F.col("m")).otherwise(
        (f + F.col("strength") * F.col("m")) / (n + F.col("strength"))
    )
    rated = hosts.crossJoin(F.broadcast(prior)).withColumn("host_rate", shrunk)  # the prior is one row
    return rated.withColumn("host_kept", F.col("host_rate") <= max_rate).drop("m", "strength")


def apply_host_rules(judged: DataFrame, host: str = "source", max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """Join the verdicts on hosts back to documents and add ``kept``.

    A document is kept if it passed its own rules and its host is kept. Documents
    without a host form one host. ``judged`` is read twice: store it first, as the
    counts are costly. Hosts of any share are counted before the shuffle.
    """
    verdicts = checkpoint(host_verdicts(judged, host, max_rate))
    joined = join_lookup(judged.drop(*[c for c in verdicts.columns if c != host]), verdicts, host)
    return joined.withColumn("kept", ~F.col("base_failed") & F.col("host_kept"))


def quality_rules(docs: DataFrame, text: str = "text", host: str = "source", max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """All rules on documents and hosts; the documents with their counts are stored once in the shared folder."""
    return apply_host_rules(checkpoint(with_rule_counts(docs, text)), host, max_rate)

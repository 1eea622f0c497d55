"""SpotSigs fingerprints, in DataFrame functions only.

A spot is a common word, its signature the chain of the content words behind it, other
common words skipped. Two texts are compared by the Jaccard likeness of their signature
sets; the sizes of two sets bound their likeness from above, so sets are partitioned by
size and most pairs are settled before any signature is compared.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.text import let
from corpusloom.llm.common import free_name, whole_text
from corpusloom.runtime import checkpoint

# Common words of English, German, French and Spanish.
ANCHORS = (
    "the of and to in a is that it for on was be with as this by at are an from or not he his her they you we but have had "
    "der die und den von zu das mit sich des auf für ist im dem nicht ein eine als auch es aus er hat dass sie nach wird bei "
    "de la le les et un une du que qui dans en pour par sur au avec ne se ce pas plus est il elle sont "
    "el los las del y una por con no su para al lo como más o pero sus"
).split()

CHAIN = 3  # content words of a signature


def spot_signatures(text: Column, chain: int = CHAIN) -> Column:
    """The sorted distinct 32-bit hashes of a text's signatures.

    Words are runs of letters and digits, lower-cased. Every spot has the chain of the next
    ``chain`` content words, however many common words lie between; at the end of a text it
    is shorter, and without any there is no signature. The start of the text is a spot too,
    so a text with any word but common ones has a signature; a null text, or one without
    such a word, has none.
    """
    plain = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))

    def signatures(words):
        spots = F.filter(F.transform(words, lambda w, i: F.when((i == 0) | w.isin(*ANCHORS), i)), lambda i: i.isNotNull())
        content = F.filter(words, lambda w, i: (i > 0) & (w != F.lit("")) & ~w.isin(*ANCHORS))
        # in front of the k-th spot, at word i, are i - k content words
        return let(
            content,
            lambda c: F.transform(
                F.filter(spots, lambda i, k: i - k < F.size(c)),
                lambda i, k: F.hash(F.concat_ws(" ", F.get(words, i), F.slice(c, i - k + 1, chain))),
            ),
        )

    # The first word is a stand-in for the start of the text.
    return F.sort_array(F.array_distinct(let(F.split(F.concat(F.lit("^ "), plain), " +", -1), signatures)))


def fingerprint(signatures: Column) -> Column:
    """The signature set as text: eight hex digits each."""
    code = lambda h: F.lpad(F.hex(h.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0")
    return F.array_join(F.transform(signatures, code), "")


def likeness(left: Column, right: Column, at_least: float = 0.0) -> Column:
    """Jaccard likeness of two signature sets, 0 to 1; equal sets, empty ones too, have 1.

    Pairs whose sizes alone keep them below ``at_least`` give 0 without a comparison.
    """
    small, large = F.least(F.size(left), F.size(right)), F.greatest(F.size(left), F.size(right))
    shared = F.size(F.array_intersect(left, right))
    exact = shared / (F.size(left) + F.size(right) - shared)
    return F.when(left == right, F.lit(1.0)).when((small == 0) | (small < at_least * large), F.lit(0.0)).otherwise(exact)


def similar_pairs(signed: DataFrame, doc_id: str = "doc_id", signatures: str = "signatures", at_least: float = 0.8) -> DataFrame:
    """All pairs of different signature sets with a likeness of ``at_least`` or more.

    Returns ``left_id, right_id, likeness``; of documents with equal sets the smallest id
    stands for all, rows without id or signatures are in no pair. Sets are partitioned by
    size so that a pair's partitions are equal or next to each other. Within them sets
    meet by the rarest of their signatures: as many as a set cannot miss and still reach
    ``at_least``. Candidates are pruned by size before they are compared in full.
    """
    sets = signed.filter(F.col(doc_id).isNotNull() & (F.size(signatures) > 0))
    sets = checkpoint(sets.groupBy(F.col(signatures).alias("sigs")).agg(F.min(doc_id).alias("id")))
    sig = sets.select("id", F.size("sigs").alias("n"), F.explode("sigs").alias("sig"))
    rarity = sig.groupBy("sig").agg(F.count("*").alias("df"))
    # A signature of one set joins nothing, but it counts among that set's rarest.
    ranked = sig.join(rarity, "sig").withColumn(
        "nth", F.row_number().over(Window.partitionBy("id").orderBy("df", "sig"))
    )
    kept = ranked.filter((F.col("nth") <= F.col("n") - F.ceil(F.col("n") * at_least) + 1) & (F.col("df") > 1))
    kept = kept.withColumn("part", F.floor(F.log(F.col("n").cast("double")) / math.log(1 / at_least)))
    other = kept.select(
        F.col("id").alias("other"), F.col("n").alias("m"), "sig", F.explode(F.array(F.col("part"), F.col("part") - 1, F.col("part") + 1)).alias("part")
    )
    close = (F.col("id") < F.col("other")) & (F.least("n", "m") >= at_least * F.greatest("n", "m"))
    pairs = kept.join(other, ["part", "sig"]).filter(close).select("id", "other").distinct()
    left = sets.select(F.col("id"), F.col("sigs").alias("left_sigs"))
    right = sets.select(F.col("id").alias("other"), F.col("sigs").alias("right_sigs"))
    scored = pairs.join(left, "id").join(right, "other").withColumn("likeness", likeness(F.col("left_sigs"), F.col("right_sigs"), at_least))
    return scored.filter(F.col("likeness") >= at_least).select(F.col("id").alias("left_id"), F.col("other").alias("right_id"), "likeness")


def with_next_text(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", buckets: int = 0) -> tuple[DataFrame, Window, str, str]:
    """Rows in buckets of neighbouring ids, their window in descending id, and the names of two helper columns.

    Ids are cut at their quantiles, so that each bucket is one window of bounded size.
    The first document of the next bucket is repeated as a guest behind the last of a
    bucket; behind the last document of all comes the first. Ids may have any type that
    casts to double in order; null ids come last, equal ids are ordered by text.
    """
    spark = docs.sparkSession
    number, bucket, guest = (free_name(docs, n) for n in ("id_number", "id_bucket", "is_guest"))
    rows = docs.withColumn(number, F.col(doc_id).cast("double"))
    wanted = buckets or 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = sorted(set(rows.approxQuantile(number, [i / wanted for i in range(1, wanted)], 1 / (4 * wanted)) or []))
    splits = [-float("inf"), *(cuts or [0.0]), float("inf")]
    rows = Bucketizer(splits=splits, inputCol=number, outputCol=bucket, handleInvalid="keep").transform(rows)
    # Null ids have the bucket behind the last; descending order makes theirs the lowest.
    rows = rows.withColumn(bucket, F.when(F.col(number).isNull(), F.lit(-1)).otherwise(F.col(bucket)).cast("int"))
    tops = rows.groupBy(bucket).agg(F.max(doc_id).alias("top")).orderBy(F.col(bucket).desc()).collect()  # one row a bucket
    hosts = {tops[i][bucket]: tops[i - 1][bucket] for i in range(len(tops))}  # the bucket before; the last before the first
    table = [(t["top"], t[bucket], hosts[t[bucket]]) for t in tops]
    at, of, to = (free_name(rows, n) for n in ("top_id", "top_bucket", "top_host"))
    kind = dict(docs.dtypes)[doc_id]
    lookup = spark.createDataFrame(table, f"{at} {kind}, {of} int, {to} int")
    met = rows[doc_id].eqNullSafe(lookup[at]) & (rows[bucket] == lookup[of])
    marked = rows.join(F.broadcast(lookup), met, "left")  # one row a bucket
    own = F.struct(F.col(bucket).alias("b"), F.lit(False).alias("g"))
    also = F.struct(F.col(to).alias("b"), F.lit(True).alias("g"))
    spot = free_name(marked, "spot")
    spread = marked.withColumn(spot, F.explode(F.when(F.col(to).isNull(), F.array(own)).otherwise(F.array(own, also))))
    spread = spread.withColumn(bucket, F.col(f"{spot}.b")).withColumn(guest, F.col(f"{spot}.g"))
    order = Window.partitionBy(bucket).orderBy(guest, F.col(doc_id).desc_nulls_last(), text)
    return spread.drop(spot, at, of, to, number), order, guest, bucket


def with_edited_text(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Add fingerprints of every text and of its edited text, and two likenesses.

    The edited text has the last half of the code points replaced by as many first ones,
    or all, of the next document in descending id order (the first after the last).
    Adds ``n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next``. A single document is its own next. Null texts are empty; equal texts have
    equal fingerprints; rows that repeat are neighbours of each other.
    """
    body, following, own, edited, next_own = (free_name(docs, n) for n in ("body", "next_body", "sigs", "edited_sigs", "next_sigs"))
    rows, order, guest, bucket = with_next_text(docs.withColumn(body, whole_text(text)), doc_id, body)
    rows = rows.withColumn(following, F.coalesce(F.lead(body).over(order), F.lit("")))
    length = F.length(body)
    half = F.floor(length / 2).cast("int")
    rows = rows.withColumn(
        following, F.concat(F.substring(F.col(body), F.lit(1), length - half), F.substring(F.col(following), F.lit(1), half))
    )
    rows = rows.withColumn(own, spot_signatures(F.col(body))).withColumn(edited, spot_signatures(F.col(following)))
    rows = rows.withColumn("n_chars", F.length(body).cast("long")).withColumn("edited_sha256", F.sha2(F.col(following), 256))
    rows = rows.withColumn(next_own, F.lead(own).over(order)).filter(~F.col(guest))
    return rows.withColumns(
        {
            "fingerprint": fingerprint(F.col(own)),
            "edited_fingerprint": fingerprint(F.col(edited)),
            "near_edited": likeness(F.col(own), F.col(edited)),
            "near_next": likeness(F.col(own), F.col(next_own)),
        }
    ).drop(body, following, own, edited, next_own, guest, bucket)

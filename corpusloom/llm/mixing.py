"""Mix sources to target weights by a low-discrepancy schedule, in DataFrame functions only.

Every source is one stream of words: its documents in the order of a seeded hash,
cut into blocks of equally many words. Slot n of the mix belongs to the source in
whose share of the target the n-th van der Corput point falls; the r-th slot of a
source takes the r-th block of its stream, which starts anew when it is used up.
The slots of a document's first words are the places of its copies in the mix.

Only numbers of a document, never its text, go through the windows and joins of the
schedule; the stored rows meet the result once, by a number of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import count_words, join_lookup, stored, whole_text
from corpusloom.runtime import checkpoint, shuffle_partitions

WEIGHTS = (3, 1, 2)
SHARE, MOST_REPEATS = 1.5, 2.0
BLOCK_WORDS = 128
SEED = "mix"
_BITS = 40  # of a van der Corput point
_CELLS = 4096  # cells in which the shares of sources are looked up
_RUN = 1 << 16  # slots ranked together


def source_targets(
    sized: DataFrame, source: str = "source", weights=WEIGHTS, share: float = SHARE, most: float = MOST_REPEATS
) -> DataFrame:
    """One row per source: ``source_size``, ``weight``, ``target`` and the slots it needs.

    Sources in code point order, null last, take the weights in turn. Together they get
    ``share`` times all words, but none more than ``most`` times its own; the excess goes
    to the others by weight. Ordered by words per weight, the sources that reach their
    bound come first, so one pass over running sums finds the level of the others.
    """
    total = Window.partitionBy()
    by_name = Window.orderBy(F.col(source).asc_nulls_last())  # one row per source
    by_room = Window.orderBy(F.col("bound") / F.col("weight"), "place")
    rows = sized.groupBy(source).agg(F.sum("size").alias("source_size"))
    rows = rows.withColumn("place", F.row_number().over(by_name) - 1)
    picked = F.element_at(F.array(*map(F.lit, weights)), (F.pmod("place", F.lit(len(weights))) + 1).cast("int"))
    rows = rows.withColumn("weight", picked).withColumn("bound", most * F.col("source_size"))
    before = F.coalesce(F.sum("bound").over(by_room.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    left = share * F.sum("source_size").over(total) - before
    level = left / F.sum("weight").over(by_room.rowsBetween(0, Window.unboundedFollowing))
    rows = rows.withColumn("level", level)
    free = F.max(F.when(F.col("level") * F.col("weight") <= F.col("bound"), F.col("level"))).over(total)
    rows = rows.withColumn("target", F.least(F.col("bound"), F.coalesce(F.col("weight") * free, F.col("bound"))))
    return rows.drop("level")


def with_stream_position(sized: DataFrame) -> DataFrame:
    """Add ``offset``: the words of the source in front of the document in its shuffled stream.

    Running sums are taken within slices of the hash first and over the slices' sums
    then, so that no source is summed in one task. Equal hashes (repeated ids) are
    ordered by size and text hash.
    """
    cut = sized.withColumn("slice", F.substring("order", 1, 3))
    within = Window.partitionBy("place", "slice").orderBy("order", "size", "text_hash", "key")
    slices = cut.groupBy("place", "slice").agg(F.sum("size").alias("slice_size"))
    over = Window.partitionBy("place").orderBy("slice")
    slices = slices.select("place", "slice", (F.sum("slice_size").over(over) - F.col("slice_size")).alias("start"))
    placed = cut.withColumn("inside", F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    placed = placed.join(slices, ["place", "slice"])
    return placed.withColumn("offset", F.col("start") + F.col("inside")).drop("slice", "start", "inside", "order", "text_hash")


def _point(n: Column) -> Column:
    """The n-th van der Corput point in base 2: the bits of n behind the point, reversed."""
    return F.conv(F.reverse(F.lpad(F.bin(n), _BITS, "0")), 2, 10).cast("double") / float(1 << _BITS)


def slot_counts(targets: DataFrame, block: int = BLOCK_WORDS) -> tuple[int, int]:
    """The number of slots that the points fill, and of sources."""
    words, places = targets.agg(F.coalesce(F.sum("words"), F.lit(0)), F.count("*")).first()
    return -(-int(words) // block), int(places)


def schedule(targets: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """The slots of the mix in order of ``id``: ``place`` of the source, ``rank`` of the slot in it.

    Slots beyond what a source still needs stay empty; the few that a source
    lacks when the points end, at most the discrepancy of the sequence, close the mix.
    """
    spark = targets.sparkSession
    slots, places = slot_counts(targets, block)
    shares = targets.withColumn("high", F.sum("words").over(Window.orderBy("place")) / F.sum("words").over(Window.partitionBy()))
    shares = shares.withColumn("low", F.lag("high", 1, 0.0).over(Window.orderBy("place"))).filter(F.col("high") > F.col("low"))
    last = F.lit(_CELLS - 1)
    cells = shares.select(
        "place",
        "low",
        "high",
        F.explode(
            F.sequence(F.least(F.floor(F.col("low") * _CELLS), last), F.least(F.floor(F.col("high") * _CELLS), last))
        ).alias("cell"),
    )
    points = spark.range(slots).withColumn("point", _point(F.col("id")))
    points = points.withColumn("cell", F.floor(F.col("point") * _CELLS))
    owned = points.join(cells, "cell").filter((F.col("point") >= F.col("low")) & (F.col("point") < F.col("high")))
    owned = owned.select("place", "id", F.floor(F.col("id") / _RUN).alias("run"))
    runs = owned.groupBy("place", "run").agg(F.count("*").alias("run_slots"))
    over = Window.partitionBy("place").orderBy("run")
    runs = runs.withColumn("run_start", F.sum("run_slots").over(over) - F.col("run_slots"))
    ranked = owned.withColumn("in_run", F.row_number().over(Window.partitionBy("place", "run").orderBy("id")) - 1)
    ranked = ranked.join(runs, ["place", "run"]).select("place", (F.col("run_start") + F.col("in_run")).alias("rank"), "id")
    made = runs.groupBy("place").agg(F.sum("run_slots").alias("made"))
    short = (
        targets.join(made, "place", "left")
        .withColumn("made", F.coalesce("made", F.lit(0)))
        .filter(F.col("made") < F.col("slots"))
        .select("place", F.explode(F.sequence(F.col("made"), F.col("slots") - 1)).alias("rank"))
    )
    return ranked.unionByName(short.withColumn("id", slots + F.col("rank") * places + F.col("place")))


def _stored(docs: DataFrame, text: str, source: str, doc_id: str, seed: str) -> DataFrame:
    """The rows as structs, so that no name of the caller's meets one of these, with what the mix needs of them."""
    body = whole_text(text)
    id_text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    numbers = {
        "source": F.col(source),
        "size": count_words(body),
        "order": F.md5(F.concat(F.lit(seed + ":"), id_text)),
        "text_hash": F.xxhash64(body),
        "key": F.monotonically_increasing_id(),
    }
    return stored(docs.select(F.struct("*").alias("row"), *[c.alias(name) for name, c in numbers.items()]), "mix")


def plan_targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST_REPEATS, block: int = BLOCK_WORDS) -> DataFrame:
    """``source_targets`` with the words to take, the blocks of the stream, and the slots they need; stored."""
    targets = source_targets(sized, "source", weights, share, most)
    words = F.floor("target")
    loops = F.when(F.col("source_size") > 0, F.floor(words / F.col("source_size"))).otherwise(F.lit(0))
    blocks = F.ceil(F.col("source_size") / block)
    rest = words - loops * F.col("source_size")
    slots = loops * blocks + F.ceil(rest / block)
    return checkpoint(targets.withColumns({"words": words, "blocks": blocks, "rest": rest, "slots": slots}))


def take_slots(sized: DataFrame, targets: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """Rows ``key, size, source_size, target, offset, taken, slots`` of the rows ``key, source, size, order, text_hash``.

    ``slots`` are those that take the document's first words, in order: one for each copy in the mix.
    """
    plan = targets.select("place", "blocks", "rest", F.col("slots").alias("needed"))
    used = join_lookup(schedule(targets, block), checkpoint(plan), "place", "inner").filter(F.col("rank") < F.col("needed"))
    part = F.pmod(F.col("rest"), F.lit(block))  # words of the last slot, unless it is a whole block
    cut = F.when((F.col("rank") == F.col("needed") - 1) & (part > 0), part).otherwise(F.lit(block))
    used = used.select("place", F.pmod("rank", "blocks").alias("block"), cut.alias("cut"), F.col("id").alias("slot"))

    lookup = targets.select("source", "place", "source_size", "target")
    placed = checkpoint(with_stream_position(join_lookup(sized, checkpoint(lookup), "source", "inner")))
    first, last = F.floor(F.col("offset") / block), F.floor((F.col("offset") + F.col("size") - 1) / block)
    pieces = placed.filter(F.col("size") > 0).select(
        "key", "place", "offset", "size", first.alias("first"), F.explode(F.sequence(first, last)).alias("block")
    )
    begin = F.greatest(F.col("offset") - F.col("block") * block, F.lit(0))
    end = F.least(F.col("offset") + F.col("size") - F.col("block") * block, F.lit(block))
    pieces = pieces.select("key", "place", "block", (F.col("block") == F.col("first")).alias("opens"), begin.alias("begin"), end.alias("end"))
    n = F.greatest(F.least(F.col("end"), F.col("cut")) - F.col("begin"), F.lit(0))
    filled = pieces.join(used, ["place", "block"]).withColumn("n", n).filter("n > 0")
    taken = filled.groupBy("key").agg(
        F.sum("n").alias("taken"), F.array_sort(F.collect_list(F.when(F.col("opens"), F.col("slot")))).alias("slots")
    )
    placed = placed.select("key", "size", "source_size", "target", "offset").join(taken, "key", "left")
    return placed.withColumn("taken", F.coalesce(F.col("taken"), F.lit(0)).cast("long"))


def _columns(docs: DataFrame, *without: str) -> list[Column]:
    """The caller's columns, out of the stored rows."""
    return [F.col(f"row.`{c}`").alias(c) for c in docs.columns if c not in without]


def mix_sources(
    docs: DataFrame,
    text: str = "text",
    source: str = "source",
    doc_id: str = "doc_id",
    weights=WEIGHTS,
    share: float = SHARE,
    most: float = MOST_REPEATS,
    block: int = BLOCK_WORDS,
    seed: str = SEED,
) -> DataFrame:
    """Add ``size, source_size, target``, ``taken`` (words the mix takes, repeats counted) and ``first_slot`` (null if none).

    A document without words is never taken. A null source is a source. Rows that
    repeat an id are documents of their own. Columns of these five names are replaced, all
    others stay. The same rows give the same mix; an empty table gives no rows.
    """
    rows = _stored(docs, text, source, doc_id, seed)
    sized = rows.drop("row")
    taken = take_slots(sized, plan_targets(sized, weights, share, most, block), block)
    added = ("size", "source_size", "target", "taken", "first_slot")
    taken = taken.select("key", *added[:-1], F.get("slots", F.lit(0)).alias("first_slot"))
    return rows.select("key", "row").join(taken, "key").select(*_columns(docs, *added), *added)


def mixed_documents(
    docs: DataFrame,
    text: str = "text",
    source: str = "source",
    doc_id: str = "doc_id",
    weights=WEIGHTS,
    share: float = SHARE,
    most: float = MOST_REPEATS,
    block: int = BLOCK_WORDS,
    seed: str = SEED,
) -> DataFrame:
    """The mix itself, in the order of its slots: each document as often as taken, with the columns of ``docs``.

    The one document of a source at which its target ends is cut behind its last taken
    word; documents that the mix does not take are absent. Partitions follow each other
    in the order of the schedule, and so do the files of a table that they are written to.
    """
    rows = _stored(docs, text, source, doc_id, seed)
    sized = rows.drop("row")
    targets = plan_targets(sized, weights, share, most, block)
    copies = take_slots(sized, targets, block).filter(F.col("taken") > 0)
    copies = copies.select("key", "size", "taken", "offset", F.posexplode("slots").alias("copy", "slot"))
    parts, slots = shuffle_partitions(docs.sparkSession), max(slot_counts(targets, block)[0], 1)
    part = F.least(F.floor(F.col("slot") * parts / slots), F.lit(parts - 1)).cast("int")
    mixed = rows.select("key", "row").join(copies, "key").repartitionById(parts, part).sortWithinPartitions("slot", "offset", "key")
    rest = F.least(F.col("taken") - F.col("copy") * F.col("size"), F.col("size"))
    body = F.col(f"row.`{text}`")
    words = F.filter(F.split(body, r"[\x20\x09-\x0D]+", -1), lambda w: w != F.lit(""))
    cut = F.array_join(F.slice(words, F.lit(1), rest.cast("int")), " ")
    whole = F.when(rest < F.col("size"), cut).otherwise(body).alias(text)
    return mixed.select(*[whole if c == text else F.col(f"row.`{c}`").alias(c) for c in docs.columns])

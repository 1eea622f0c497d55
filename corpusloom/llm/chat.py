"""Chat formatting into budgeted windows, in DataFrame functions only.

A template marks every turn; what could look like its marks inside texts is escaped
reversibly. Running sums of turn tokens cut each conversation at turn boundaries into
windows: every window repeats the system turn and a limited tail of the turns before
it, and only turns it shows for the first time bear loss.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The marks of the template, and the escapes inside texts.
TURN_OPEN, ROLE_CLOSE, TURN_CLOSE = '<turn role="', '">\n', "</turn>\n"
ESCAPES = (("\\", "\\b"), ("<", "\\l"), ('"', "\\q"))

BUDGET, HISTORY = 1024, 256
LOSS_ROLES = ("assistant",)
_CHUNK = 64  # turn numbers summed together before conversations are


def escape(text: Column) -> Column:
    """Every backslash of the result begins an escape, so no mark can appear in it."""
    for plain, code in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    """The text that was escaped; the backslash itself comes last."""
    for plain, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def turn_tokens(segment: Column) -> Column:
    """Tokens of a formatted turn: words, single digits and single signs."""
    return F.regexp_count(segment, F.lit(r"\p{L}+|[^\p{L}\s]")).cast("long")


def _numbered(turns: DataFrame, tokens) -> DataFrame:
    """Turns with their position and the tokens before them, chunk by chunk so that one conversation can be large."""
    marked = turns.select(
        F.struct("conv_id").alias("conv"),
        "turn",
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("plain"),
    )
    head = F.concat(F.lit(TURN_OPEN), escape(F.col("role")), F.lit(ROLE_CLOSE))
    marked = marked.withColumn("head", head).withColumn("segment", F.concat("head", escape(F.col("plain")), F.lit(TURN_CLOSE)))
    marked = marked.withColumn("tokens", tokens(F.col("segment"))).withColumn("chunk", F.floor(F.col("turn") / _CHUNK))
    order = [F.col("turn").asc_nulls_last(), "role", "plain"]
    inside = Window.partitionBy("conv", "chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    chunks = marked.groupBy("conv", "chunk").agg(F.count("*").alias("rows"), F.sum("tokens").alias("sum"))
    over = Window.partitionBy("conv").orderBy(F.col("chunk").asc_nulls_last())
    chunks = chunks.select(
        F.col("conv").alias("c_conv"),
        F.col("chunk").alias("c_chunk"),
        (F.sum("rows").over(over) - F.col("rows")).alias("rows_before"),
        (F.sum("sum").over(over) - F.col("sum")).alias("tokens_before"),
    )
    placed = marked.withColumns(
        {"nth": F.count("*").over(inside) - 1, "upto": F.sum("tokens").over(inside) - F.col("tokens")}
    )
    met = (F.col("conv") == F.col("c_conv")) & F.col("chunk").eqNullSafe(F.col("c_chunk"))
    return placed.join(chunks, met).select(
        "conv",
        "role",
        "head",
        "segment",
        "tokens",
        (F.col("rows_before") + F.col("nth")).alias("position"),
        (F.col("tokens_before") + F.col("upto")).alias("start"),
    )


def format_conversations(
    turns: DataFrame, budget: int = BUDGET, history: int = HISTORY, loss_roles=LOSS_ROLES, tokens=turn_tokens
) -> DataFrame:
    """Format the turns (conv_id, turn, role, text) as windows of at most ``budget`` tokens.

    Returns ``conv_id, window_no, text, loss_spans`` (array of start and length in code
    points: the escaped texts of loss turns new in this window), ``n_repeated`` (leading
    turns shown before), ``n_new, n_tokens, over_budget``.

    A first turn of role system opens every window. Room is what budget, system turn and
    ``history`` leave. Turns of at most half the room share a window while their running
    sum stays in one half-room interval, so a window never outgrows the room; a larger
    turn has its own, without history and flagged ``over_budget`` if it alone exceeds it.

    Turns are ordered by turn (null last), role and text; rows that repeat are turns of
    their own. Null texts and roles are empty. Rows without conv_id are one conversation.
    """
    rows = _numbered(turns, tokens)
    is_system = (F.col("position") == 0) & (F.col("role") == "system")
    system = rows.filter(is_system).select(
        F.col("conv").alias("s_conv"), F.col("segment").alias("s_segment"), F.col("tokens").alias("s_tokens")
    )
    rest = rows.filter(~is_system).join(system.select("s_conv", "s_tokens"), F.col("conv") == F.col("s_conv"), "left")
    half = F.greatest(F.floor((budget - history - F.coalesce("s_tokens", F.lit(0))) / 2), F.lit(1))
    rest = rest.withColumn("half", half).withColumn("large", F.col("tokens") > F.col("half"))
    rest = rest.withColumn("chunk", F.floor(F.col("position") / _CHUNK))
    inside = Window.partitionBy("conv", "chunk").orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    counts = rest.groupBy("conv", "chunk").agg(F.sum(F.col("large").cast("long")).alias("n"))
    over = Window.partitionBy("conv").orderBy("chunk")
    counts = counts.withColumn("larges_before", F.sum("n").over(over) - F.col("n")).drop("n")
    rest = rest.withColumn("larges", F.sum(F.col("large").cast("long")).over(inside)).join(counts, ["conv", "chunk"])
    interval = F.floor((F.col("start") + F.col("tokens") - 1) / F.col("half"))
    rest = rest.withColumn("key", F.struct(F.col("larges_before") + F.col("larges"), "large", F.when(~F.col("large"), interval)))

    spans = rest.groupBy("conv", "key").agg(
        F.min("position").alias("first"), F.min("start").alias("from"), F.sum("tokens").alias("new_tokens"), F.max("half").alias("half")
    )
    spans = spans.withColumn("window_no", F.row_number().over(Window.partitionBy("conv").orderBy("first")) - 1)
    shown = rest.join(spans.select("conv", "key", "window_no"), ["conv", "key"]).select(
        "conv", "window_no", "position", "role", "head", "segment", "tokens", F.lit(True).alias("new")
    )
    if history > 0:
        # Turns and windows meet by intervals of the running sum: at most ``history`` tokens of turns in each.
        asking = spans.filter((F.col("first") > 0) & (F.col("new_tokens") <= 2 * F.col("half"))).select(
            F.col("conv").alias("w_conv"),
            "window_no",
            "from",
            F.explode(
                F.array_distinct(F.array(F.floor((F.col("from") - history) / history), F.floor((F.col("from") - 1) / history)))
            ).alias("w_part"),
        )
        tail = rest.withColumn("part", F.floor(F.col("start") / history)).join(
            asking,
            (F.col("conv") == F.col("w_conv"))
            & (F.col("part") == F.col("w_part"))
            & (F.col("start") < F.col("from"))
            & (F.col("start") >= F.col("from") - history),
        )
        shown = shown.unionByName(
            tail.select("conv", "window_no", "position", "role", "head", "segment", "tokens", F.lit(False).alias("new"))
        )

    turn = F.struct("position", "role", "head", "segment", "new")
    windows = shown.groupBy("conv", "window_no").agg(
        F.array_sort(F.collect_list(turn)).alias("shown"), F.sum("tokens").alias("n_tokens")
    )
    windows = windows.join(system, F.col("conv") == F.col("s_conv"), "full")
    lead = F.coalesce(F.length("s_segment"), F.lit(0))
    start = F.struct(lead.alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def add(state, t):
        bears = t["new"] & t["role"].isin(*loss_roles)
        length = F.length(t["segment"]) - F.length(t["head"]) - len(TURN_CLOSE)
        span = F.struct((state["at"] + F.length(t["head"])).alias("start"), length.alias("length"))
        spans = F.when(bears, F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct((state["at"] + F.length(t["segment"])).alias("at"), spans.alias("spans"))

    shown_turns = F.coalesce(F.col("shown"), F.array().cast(windows.schema["shown"].dataType))
    n_old = F.size(F.filter(shown_turns, lambda t: ~t["new"]))
    has_system, number = F.col("s_segment").isNotNull(), F.coalesce(F.col("window_no"), F.lit(0))
    total = F.coalesce("n_tokens", F.lit(0)) + F.coalesce("s_tokens", F.lit(0))
    return windows.select(
        F.coalesce("conv", "s_conv")["conv_id"].alias("conv_id"),
        number.cast("long").alias("window_no"),
        F.concat(F.coalesce("s_segment", F.lit("")), F.array_join(F.transform(shown_turns, lambda t: t["segment"]), "")).alias("text"),
        F.aggregate(shown_turns, start, add)["spans"].alias("loss_spans"),
        (n_old + (has_system & (number > 0)).cast("int")).cast("long").alias("n_repeated"),
        (F.size(shown_turns) - n_old + (has_system & (number == 0)).cast("int")).cast("long").alias("n_new"),
        total.alias("n_tokens"),
        (total > budget).alias("over_budget"),
    )


def read_turns(text: Column) -> Column:
    """The turns of a formatted text as structs of role and text, unescaped."""
    segments = F.filter(F.split(text, TURN_CLOSE, -1), lambda s: s != F.lit(""))
    body = F.transform(segments, lambda s: F.substring(s, len(TURN_OPEN) + 1, F.length(s)))
    return F.transform(
        body,
        lambda b: F.struct(
            unescape(F.substring_index(b, ROLE_CLOSE, 1)).alias("role"),
            unescape(F.substring(b, F.locate(ROLE_CLOSE, b) + len(ROLE_CLOSE), F.length(b))).alias("text"),
        ),
    )


def read_back(windows: DataFrame) -> DataFrame:
    """Digests per conversation of what its windows hold, read from the formatted texts.

    Repeated turns are left out; loss text is what the spans cut from the texts. A
    conversation's digests need its whole text as one value.
    """
    new = F.slice(read_turns(F.col("text")), (F.col("n_repeated") + 1).cast("int"), F.col("n_new").cast("int"))
    lines = F.array_join(F.transform(new, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(
        F.transform("loss_spans", lambda s: unescape(F.substring(F.col("text"), s["start"] + 1, s["length"]))), ""
    )
    read = windows.select(
        "conv_id", "window_no", "n_new", lines.alias("lines"), loss.alias("loss"), F.length("text").cast("long").alias("chars")
    )
    whole = read.groupBy("conv_id").agg(
        F.sum("n_new").alias("n_turns"),
        F.array_sort(F.collect_list(F.struct("window_no", "lines", "loss"))).alias("parts"),
        F.sum("chars").alias("formatted_chars"),
        F.count("*").alias("n_windows"),
    )
    joined = {f: F.array_join(F.transform("parts", lambda p: p[f]), "") for f in ("lines", "loss")}
    return whole.select(
        "conv_id",
        "n_turns",
        F.sha2(joined["lines"], 256).alias("turns_sha256"),
        F.length(joined["loss"]).cast("long").alias("loss_chars"),
        F.sha2(joined["loss"], 256).alias("loss_sha256"),
        "formatted_chars",
        "n_windows",
    )

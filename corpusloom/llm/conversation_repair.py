"""Damage, check and repair conversations: faults counted, role order restored at least cost.

Rows meet by conversation and block of turns, so a very long conversation is dealt over many
tasks. Each chunk of at most CHUNK_ROWS rows becomes one stored row with its symbols.
Conversations of one chunk are repaired where they are. For the others, chunks know from four
lookups (one for each state a chunk may end in) what they cost between any two states; a
backward pass over these small rows gives the costs behind each chunk, a forward pass the
state in front of it, and then all chunks are repaired side by side.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm import block_tables as bt
from corpusloom.llm.common import SPACES
from corpusloom.runtime import checkpoint, scratch_path, sized_broadcast

BLOCK_TURNS = 4096
CHUNK_ROWS = 4096
CHUNK_BYTES = 8 << 20  # of texts; a chunk ends behind the row that reaches it
ENDINGS = ".!?"
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}

_COUNTS = ("blank", "duplicate", "truncated", "illegal")
_ROW = "struct<role: string, text: string>"


def damage(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copy, gone): rows damaged by crc32 of ``conv_id:turn``; null values are one space.

    Of 20 classes, 0 drops the row (it stays as a mark with ``gone`` set), 1 empties its text, 2 removes its
    ``.!?``, 3 repeats it and 4 makes its role user.
    """
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.pmod(F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn"))), F.lit(20))
    text = F.when(fate == 1, "").when(fate == 2, F.translate(said("text"), ENDINGS, "")).otherwise(said("text"))
    rows = turns.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.when(fate == 4, "user").otherwise(said("role")).alias("role"),
        F.when(fate != 0, text).alias("text"),
        F.explode(F.when(fate == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
        (fate == 0).alias("gone"),
    )
    return rows


def _code(role: str, text: str, repeated: bool) -> tuple[int, str | None]:
    """Symbol and fault of a row."""
    bare = text.rstrip(SPACES)
    if not bare:
        return bt.MUST_DELETE, "blank"
    if repeated:
        return bt.MUST_DELETE, "duplicate"
    cut = bare[-1] not in ENDINGS
    return bt.symbol(role[:1], cut), "truncated" if cut else None


class _Chunk:
    """Rows of one conversation, in order, as they are met."""

    def __init__(self, conv, block, sub: int, turn):
        self.key, self.roles, self.texts, self.codes, self.seen, self.bytes = (conv, block, sub), [], [], bytearray(), set(), 0
        self.counts = dict.fromkeys(_COUNTS[:3], 0)
        self.turn, self.low, self.high, self.turns = turn, None, None, 0  # the turn met last; range and number of turns

    def add(self, turn, role: str, text: str) -> None:
        again = (role, text) in self.seen
        self.seen.add((role, text))
        code, fault = _code(role, text, again)
        if fault:
            self.counts[fault] += 1
        self.roles.append(role)
        self.texts.append(text)
        self.codes.append(code)
        self.bytes += len(text)
        if turn is not None:
            self.turns += turn != self.turn
            self.low, self.high, self.turn = turn if self.low is None else self.low, turn, turn

    def row(self) -> dict:
        names = dict(zip(("conv_id", "block", "sub"), self.key))
        return names | self.counts | {
            "codes": bytes(self.codes), "roles": self.roles, "texts": self.texts, "low": self.low, "high": self.high, "turns": self.turns
        }


def _batches(rows: Iterator[dict], kind: pa.Schema, most: int = 1024, most_bytes: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Rows as record batches, bounded by number and by bytes of texts."""
    some, size = [], 0
    for row in rows:
        some.append(row)
        size += row.pop("_bytes", 0)
        if len(some) >= most or size >= most_bytes:
            yield pa.RecordBatch.from_pylist(some, kind)
            some, size = [], 0
    if some:
        yield pa.RecordBatch.from_pylist(some, kind)


def _mapped(df: DataFrame, work: Callable[[Iterator[dict]], Iterator[dict]], schema: str) -> DataFrame:
    """Rows through a generator of plain rows, in the order they lie in their partition."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    kind = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(work(row for batch in batches for part in range(0, len(batch), 256) for row in batch.slice(part, 256).to_pylist()), kind)

    return df.mapInArrow(run, schema)


def _chunks(rows: DataFrame, block_turns: int, chunk_rows: int) -> DataFrame:
    """One row per chunk of damaged rows, in turn order within (conv_id, block); stored."""
    keyed = rows.withColumn("block", F.floor(F.col("turn") / block_turns).cast("long"))
    order = ["conv_id", "block", "turn", "role", "text", "copy"]  # null turns lie in a block of their own, the first
    met = keyed.repartition("conv_id", "block").sortWithinPartitions(*order)

    def cut(rows: Iterator[dict]) -> Iterator[dict]:
        now = None
        for r in rows:
            same = now is not None and now.key[:2] == (r["conv_id"], r["block"])
            if now is not None and (not same or len(now.codes) >= chunk_rows or now.bytes >= CHUNK_BYTES):
                yield now.row() | {"_bytes": now.bytes}
                now = _Chunk(r["conv_id"], r["block"], now.key[2] + 1, now.turn) if same else None
            if now is None:
                now = _Chunk(r["conv_id"], r["block"], 0, None)
            if not r["gone"]:
                now.add(r["turn"], r["role"], r["text"])
        if now is not None:
            yield now.row() | {"_bytes": now.bytes}

    kind = rows.schema["conv_id"].dataType.simpleString()
    schema = (
        f"conv_id {kind}, block long, sub long, blank long, duplicate long, truncated long, codes binary, "
        "roles array<string>, texts array<string>, low long, high long, turns long"
    )
    path = scratch_path(rows.sparkSession, "turn-chunks")
    _mapped(met, cut, schema).write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def _illegal(initials: list[str]) -> int:
    return sum(pair not in LEGAL for pair in zip(initials, initials[1:]))


def _repaired(r: dict, after: tuple[int, ...], state: int, last: bool) -> dict:
    """A chunk's row with its edits and the rows they leave."""
    edits, _ = bt.trace(r["codes"], after, state, last)
    out, cost = [], 0
    for letter, at, role in edits:
        cost += bt.COST[letter]
        if letter in (bt.KEEP, bt.REROLE):
            cost += (r["codes"][at] - 1) & 1
            out.append({"role": r["roles"][at] if letter == bt.KEEP else bt.ROLE[role], "text": r["texts"][at]})
        elif letter == bt.INSERT:
            out.append({"role": bt.ROLE[role], "text": ""})
    initials = [x[:1] for x in r["roles"]]
    ends = {"head": initials[0] if initials else None, "tail": initials[-1] if initials else None}
    names = ("conv_id", "block", "sub", "blank", "duplicate", "truncated", "low", "high", "turns")
    size = sum(map(len, r["texts"]))
    return {n: r[n] for n in names} | ends | {"illegal": _illegal(initials), "cost": cost, "audit": "".join(e[0] for e in edits), "repaired": out, "_bytes": size}


def _repaired_schema(conv: str) -> str:
    return (
        f"conv_id {conv}, block long, sub long, blank long, duplicate long, truncated long, low long, high long, turns long, "
        f"head string, tail string, illegal long, cost long, audit string, repaired array<{_ROW}>"
    )


def _repair_alone(rows: Iterator[dict]) -> Iterator[dict]:
    for r in rows:
        yield _repaired(r, bt.END, bt.START, True)


def _renamed(df: DataFrame, *names: str) -> DataFrame:
    """The table with ``m_`` in front of the named columns, to join by them null-safely."""
    return df.select(*(F.col(c).alias(f"m_{c}") if c in names else F.col(c) for c in df.columns))


def _met(df: DataFrame, *names: str) -> Column:
    same = F.lit(True)
    for name in names:
        same = same & df[name].eqNullSafe(F.col(f"m_{name}"))
    return same


def _cross_chunk_repeats(chunks: DataFrame, conv: str) -> DataFrame:
    """Chunks with the repeats of rows of earlier chunks marked for deletion.

    Only digests of the chunks' rows meet; a row repeats if its digest has an earlier chunk.
    """

    def digests(rows: Iterator[dict]) -> Iterator[dict]:
        for r in rows:
            for i, (role, text, code) in enumerate(zip(r["roles"], r["texts"], r["codes"])):
                if code != bt.MUST_DELETE:
                    packed = f"{len(role)}:{role}{text}".encode()
                    yield {n: r[n] for n in ("conv_id", "block", "sub")} | {"at": i, "digest": hashlib.blake2b(packed, digest_size=16).digest()}

    rows = checkpoint(_mapped(chunks, digests, f"conv_id {conv}, block long, sub long, at long, digest binary"))
    place = F.struct(F.coalesce("block", F.lit(-(1 << 63))).alias("b"), "sub")
    firsts = rows.groupBy("conv_id", "digest").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    later = rows.join(_renamed(firsts, "conv_id", "digest"), _met(rows, "conv_id", "digest")).filter(place > F.col("first"))
    marks = later.groupBy("conv_id", "block", "sub").agg(F.sort_array(F.collect_list("at")).alias("marks"))
    key = ("conv_id", "block", "sub")
    met = chunks.join(_renamed(marks, *key), _met(chunks, *key), "left").drop(*(f"m_{k}" for k in key))

    def marked(rows: Iterator[dict]) -> Iterator[dict]:
        for r in rows:
            codes = bytearray(r["codes"])
            for at in r.pop("marks") or ():
                r["duplicate"] += 1
                r["truncated"] -= (codes[at] - 1) & 1
                codes[at] = bt.MUST_DELETE
            yield r | {"codes": bytes(codes), "_bytes": sum(map(len, r["texts"]))}

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in chunks.schema)
    path = scratch_path(chunks.sparkSession, "marked-chunks")
    _mapped(met, marked, fields).write.parquet(path)
    return chunks.sparkSession.read.parquet(path)


def _repair_long(chunks: DataFrame, conv: str) -> DataFrame:
    """Repair of conversations of several chunks, in conversation order within each partition."""
    key = f"conv_id {conv}, block long, sub long"
    names = ("conv_id", "block", "sub")

    def spans(rows: Iterator[dict]) -> Iterator[dict]:
        for r in rows:
            yield {n: r[n] for n in names} | {"codes": r["codes"], "spans": [c for end in bt.ENDS_IN for c in bt.costs_before(r["codes"], end)]}

    def behind(rows: Iterator[dict]) -> Iterator[dict]:  # from the last chunk to the first
        conv, costs, first = None, None, True
        for r in rows:
            if first or r["conv_id"] != conv:
                conv, costs, first, last = r["conv_id"], bt.END, False, True
            yield {n: r[n] for n in names} | {"codes": r["codes"], "after": list(costs), "last": last}
            least = [min(r["spans"][4 * end + s] + costs[end] for end in range(4)) for s in range(4)]
            costs, last = bt.with_inserts(least), False

    def moves(rows: Iterator[dict]) -> Iterator[dict]:
        for r in rows:
            after = tuple(r["after"])
            yield {n: r[n] for n in names} | {"after": r["after"], "last": r["last"], "ends": [bt.trace(r["codes"], after, s, False)[1] for s in range(4)]}

    def starts(rows: Iterator[dict]) -> Iterator[dict]:
        conv, state, first = None, bt.START, True
        for r in rows:
            if first or r["conv_id"] != conv:
                conv, state, first = r["conv_id"], bt.START, False
            yield {n: r[n] for n in names} | {"after": r["after"], "last": r["last"], "state": state}
            state = r["ends"][state]

    spanned = _mapped(chunks.select(*names, "codes"), spans, f"{key}, codes binary, spans array<long>")
    backward = spanned.repartition("conv_id").sortWithinPartitions(F.desc("conv_id"), F.desc("block"), F.desc("sub"))
    moved = _mapped(_mapped(backward, behind, f"{key}, codes binary, after array<long>, last boolean"), moves, f"{key}, after array<long>, last boolean, ends array<int>")
    forward = moved.sortWithinPartitions(*names)
    started = _mapped(forward, starts, f"{key}, after array<long>, last boolean, state int")
    plan = checkpoint(_renamed(started, *names))
    met = chunks.join(plan, _met(chunks, *names))

    def repair(rows: Iterator[dict]) -> Iterator[dict]:
        for r in rows:
            yield _repaired(r, tuple(r["after"]), r["state"], r["last"])

    return _mapped(met.drop(*(f"m_{n}" for n in names)), repair, _repaired_schema(conv))


def _repairs(turns: DataFrame, block_turns: int, chunk_rows: int) -> tuple[DataFrame, DataFrame | None]:
    """Repaired chunks of conversations of one chunk, and of all others."""
    conv = turns.schema["conv_id"].dataType.simpleString()
    chunks = _chunks(damage(turns), block_turns, chunk_rows)
    several = checkpoint(chunks.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("conv_id").alias("m_conv_id")))
    if several.isEmpty():
        return _mapped(chunks, _repair_alone, _repaired_schema(conv)), None
    several = sized_broadcast(several)
    alone = chunks.join(several, _met(chunks, "conv_id"), "left_anti")
    longer = _cross_chunk_repeats(chunks.join(several, _met(chunks, "conv_id"), "left_semi"), conv)
    return _mapped(alone, _repair_alone, _repaired_schema(conv)), _repair_long(longer, conv)


def repair_conversations(turns: DataFrame, block_turns: int = BLOCK_TURNS, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Damaged and repaired conversations, one row for each chunk of turns, ordered by (conv_id, block, sub).

    ``repaired`` holds the chunk's rows after repair, ``audit`` its edits (Keep, Rerole, Delete,
    Insert) and ``cost`` what they cost; ``blank``, ``duplicate``, ``truncated`` count first faults.
    Rows of a conversation are taken by turn, nulls first, then by role and text. Null values
    are one space, also in the key of the damage; a null ``conv_id`` is a conversation too.
    Repeated rows are rows that repeat. Other columns are left out; an empty table gives no row.
    """
    alone, longer = _repairs(turns, block_turns, chunk_rows)
    return alone if longer is None else alone.unionByName(longer)


def _summaries(rows: Iterator[dict]) -> Iterator[dict]:
    """One row per conversation from its chunks in order."""
    now, digest, parts = None, None, 0

    def done():
        low, high = now.pop("low"), now.pop("high")
        turns = now.pop("turns")
        now.pop("tail")
        return now | {"gaps": 0 if low is None else high - low + 1 - turns, "audit": "".join(now["audit"]), "repaired_sha256": digest.hexdigest()}

    for r in rows:
        if now is None or now["conv_id"] != r["conv_id"]:
            if now is not None:
                yield done()
            now = {"conv_id": r["conv_id"], "low": None, "high": None, "turns": 0, "tail": None, "cost": 0, "audit": []} | dict.fromkeys(_COUNTS, 0)
            digest, parts = hashlib.sha256(), 0
        for name in (*_COUNTS, "cost", "turns"):
            now[name] += r[name]
        if r["head"] is not None:
            now["illegal"] += now["tail"] is not None and (now["tail"], r["head"]) not in LEGAL
            now["tail"] = r["tail"]
        if r["low"] is not None:
            now["low"] = r["low"] if now["low"] is None else now["low"]
            now["high"] = r["high"]
        now["audit"].append(r["audit"])
        for line in r["repaired"]:
            digest.update(f"{chr(10) if parts else ''}{line['role']}:{line['text']}".encode())
            parts += 1
    if now is not None:
        yield done()


def conversation_reports(turns: DataFrame, block_turns: int = BLOCK_TURNS, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """One row per conversation: gaps, faults, illegal neighbours, cost, edits and a digest of the repaired rows.

    The digest is taken while the repaired chunks stream by in order; no conversation is held whole.
    Rules as in ``repair_conversations``. A conversation of which no row is left has zeros, no edits and
    the digest of the empty string.
    """
    conv = turns.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {conv}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    alone, longer = _repairs(turns, block_turns, chunk_rows)
    out = _mapped(alone, _summaries, schema)
    if longer is not None:
        ordered = longer.repartition("conv_id").sortWithinPartitions("conv_id", "block", "sub")
        out = out.unionByName(_mapped(ordered, _summaries, schema))
    return out

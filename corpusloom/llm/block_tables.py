"""Least-cost repair of a role sequence by Four-Russians block tables.

A row is a symbol; a state says which rows may follow: at the start, behind a system row,
behind a user row, behind an assistant row. What the repair of the rest costs from each of the
states is a vector of four numbers. Less its least finite number it is one of few, so its change by any
block of BLOCK symbols can be computed once: blocks are looked up from the last to the first.
The edits are then read forward; only there the vectors inside a block are needed, and
each block is expanded backward for them when it is reached.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

START, SYSTEM, USER, ASSISTANT = range(4)
DELETE, INSERT, KEEP, REROLE = "DIKR"  # in the order that settles ties
COST = {DELETE: 3, INSERT: 2, KEEP: 0, REROLE: 2}
TURN = (USER, USER, ASSISTANT, USER)  # where an inserted or reroled row leads from each state
ROLE = {USER: "user", ASSISTANT: "assistant"}
MUST_DELETE = 0
INITIALS = "sua"  # then any other one
SYMBOLS = 1 + 2 * (len(INITIALS) + 1)
BLOCK = 4
NEVER = 1 << 40


def symbol(initial: str, truncated: bool) -> int:
    """The symbol of a row that need not be deleted."""
    at = INITIALS.find(initial) if initial else -1
    return 1 + 2 * (at if at >= 0 else len(INITIALS)) + truncated


def kept_state(state: int, code: int) -> int | None:
    """Where a row leads if it keeps its role; None if it may not stand there."""
    initial = (code - 1) >> 1
    if code == MUST_DELETE or initial == len(INITIALS):
        return None
    if INITIALS[initial] == "s":
        return SYSTEM if state == START else None
    target = USER if INITIALS[initial] == "u" else ASSISTANT
    return target if target == TURN[state] else None


def with_inserts(costs: list[int]) -> tuple[int, ...]:
    """Costs where rows may be inserted first."""
    costs = list(costs)
    for state in (USER, ASSISTANT, USER, START, SYSTEM):
        costs[state] = min(costs[state], COST[INSERT] + costs[TURN[state]])
    return tuple(min(c, NEVER) for c in costs)


def before(code: int, after: tuple[int, ...]) -> tuple[int, ...]:
    """Costs in front of a row, from the costs behind it."""
    out = []
    for state in range(4):
        ways = [COST[DELETE] + after[state]]
        if code != MUST_DELETE:
            extra = (code - 1) & 1
            ways.append(COST[REROLE] + extra + after[TURN[state]])
            if (kept := kept_state(state, code)) is not None:
                ways.append(extra + after[kept])
        out.append(min(ways))
    return with_inserts(out)


def _normal(costs: tuple[int, ...]) -> tuple[tuple[int, ...], int]:
    least = min(costs)
    return tuple(c - least if c < NEVER // 2 else NEVER for c in costs), least


END = with_inserts([0, NEVER, NEVER, 0])
#: One start for each state in which a piece of a conversation may end.
ENDS_IN = [tuple(0 if s == end else NEVER for s in range(4)) for end in range(4)]


class BlockTables:
    """All normalised vectors, what each symbol and each block of symbols turns them into, and at what cost."""

    def __init__(self):
        self.vectors: list[tuple[int, ...]] = []
        self.number: dict[tuple[int, ...], int] = {}
        steps, adds = [], []
        for costs in (END, *ENDS_IN):
            self._add(_normal(costs)[0])
        for vector in self.vectors:  # grows
            found = [_normal(before(code, vector)) for code in range(SYMBOLS)]
            steps.append([self._add(v) for v, _ in found])
            adds.append([add for _, add in found])
        self.step, self.add = steps, adds
        step, add = np.array(steps), np.array(adds)
        to, cost = np.arange(len(steps))[:, None], np.zeros((len(steps), 1), np.int64)
        for _ in range(BLOCK):  # the last symbol of a block first
            cost = (cost[:, None, :] + add[to].transpose(0, 2, 1)).reshape(len(steps), -1)
            to = step[to].transpose(0, 2, 1).reshape(len(steps), -1)
        self.block_to, self.block_add = to.tolist(), cost.tolist()

    def _add(self, vector: tuple[int, ...]) -> int:
        if vector not in self.number:
            self.number[vector] = len(self.vectors)
            self.vectors.append(vector)
        return self.number[vector]

    def enter(self, costs: tuple[int, ...]) -> tuple[int, int]:
        """Number of a vector of costs, and what was taken off it."""
        vector, least = _normal(costs)
        return self.number[vector], least


@lru_cache(1)
def tables() -> BlockTables:
    return BlockTables()


def _borders(codes: bytes, number: int) -> tuple[list[int], int]:
    """Vector numbers in front of every block (the first may be shorter) and behind the last, and the cost added in all."""
    t, total, out = tables(), 0, [number]
    head = len(codes) % BLOCK
    for at in range(len(codes) - BLOCK, head - 1, -BLOCK):
        block = 0
        for code in codes[at : at + BLOCK]:
            block = block * SYMBOLS + code
        total += t.block_add[number][block]
        number = t.block_to[number][block]
        out.append(number)
    for code in reversed(codes[:head]):
        total += t.add[number][code]
        number = t.step[number][code]
    if head:
        out.append(number)
    return out[::-1], total


def costs_before(codes: bytes, after: tuple[int, ...]) -> tuple[int, ...]:
    """Costs in front of rows, from the costs behind them, by lookups alone."""
    number, least = tables().enter(after)
    borders, total = _borders(codes, number)
    return tuple(c if c >= NEVER else c + least + total for c in tables().vectors[borders[0]])


def trace(codes: bytes, after: tuple[int, ...], state: int, last: bool) -> tuple[list[tuple[str, int, int]], int]:
    """The cheapest edits of these rows, ASCII-least among equals, and the state behind them.

    ``after`` has the costs behind the rows. Edits are (letter, row or -1, role's state).
    Where these are the last rows, inserts behind them are made too.
    """
    t = tables()
    borders, _ = _borders(codes, t.enter(after)[0])
    edits: list[tuple[str, int, int]] = []
    head = len(codes) % BLOCK
    at = 0
    for border in borders[1:]:
        size = head if at == 0 and head else BLOCK
        block = codes[at : at + size]
        inside = [border]
        for code in reversed(block):
            inside.append(t.step[inside[-1]][code])
        inside.reverse()
        for i, code in enumerate(block):
            here, there, add = t.vectors[inside[i]], t.vectors[inside[i + 1]], t.add[inside[i + 1]][code]
            while True:
                if COST[DELETE] + there[state] == add + here[state]:
                    edits.append((DELETE, at + i, state))
                    break
                if COST[INSERT] + here[TURN[state]] == here[state]:
                    state = TURN[state]
                    edits.append((INSERT, -1, state))
                    continue
                kept, extra = kept_state(state, code), (code - 1) & 1
                if kept is not None and extra + there[kept] == add + here[state]:
                    state = kept
                    edits.append((KEEP, at + i, state))
                else:
                    state = TURN[state]
                    edits.append((REROLE, at + i, state))
                break
        at += size
    while last and state not in (START, ASSISTANT):
        state = TURN[state]
        edits.append((INSERT, -1, state))
    return edits, state

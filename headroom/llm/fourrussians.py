"""Cheapest repair of a turn sequence by block tables (the method of the Four Russians).

A row is one of nine symbols: its role's initial (s, u, a or another) with or
without a cut-off end, or a row that has to go.  What the rest of a sequence
costs is a vector over four states: nothing written yet, after a system turn,
after a user turn, after an assistant turn.  Less its least entry such a vector
takes a few dozen values, so the step over every block of `BLOCK` symbols is
precomputed for each of them: the vector in front of the block, what it adds, and
the state in which each state leaves the block.  Sequences are processed from
their end by look-ups; a block is expanded backward, symbol by symbol, only to
read off its edits, where of edits that cost the same the least letter is taken.

Both directions are functions of a small finite set, so segments of one sequence
can be summarised apart and put together afterwards.
"""

from __future__ import annotations

import functools
import itertools

import numpy as np

BLOCK = 4
INITIALS = "sua"
GONE = 8  # symbol of a row that has to be deleted
SYMBOLS = 9
START, SYSTEM, USER, ASSISTANT = range(4)
KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 1, 2, 5, 5
_FOLLOWS = (USER, USER, ASSISTANT, USER)  # state after an inserted or renamed turn
_END = (0, 2 * INSERT, INSERT, 0)


def symbol(initial: str, cut_off: bool) -> int:
    """Symbol of a row that may stay."""
    at = INITIALS.find(initial) if initial else -1
    return 2 * (at if at >= 0 else 3) + cut_off


def _keeps(state: int, sign: int) -> int | None:
    """State after keeping a row, None where its role can't stand."""
    kind = sign // 2
    if kind == 0:
        return SYSTEM if state == START else None
    if kind in (1, 2) and _FOLLOWS[state] == (USER, ASSISTANT)[kind - 1]:
        return _FOLLOWS[state]
    return None


def _before(after: tuple, sign: int) -> tuple:
    """Costs in front of a row from the costs behind it."""
    costs = []
    for state in range(4):
        best = DELETE + after[state]
        if sign != GONE:
            extra, kept = CUT_OFF * (sign % 2), _keeps(state, sign)
            best = min(best, REROLE + extra + after[_FOLLOWS[state]])
            if kept is not None:
                best = min(best, KEEP + extra + after[kept])
        costs.append(best)
    for _ in range(3):  # inserted turns in front of the row
        costs = [min(costs[q], INSERT + costs[_FOLLOWS[q]]) for q in range(4)]
    return tuple(costs)


def _edits(after: tuple, sign: int, state: int) -> tuple[str, int]:
    """Least letters among the cheapest edits up to and with this row, and the state behind it."""
    here, letters = _before(after, sign), ""
    while True:
        extra, follows = CUT_OFF * (sign % 2), _FOLLOWS[state]
        if here[state] == DELETE + after[state]:
            return letters + "D", state
        if here[state] == INSERT + here[follows]:
            letters, state = letters + "I", follows
            continue
        kept = _keeps(state, sign)
        if kept is not None and here[state] == KEEP + extra + after[kept]:
            return letters + "K", kept
        return letters + "R", follows


class Tables:
    """All vectors, single steps and block steps."""

    def __init__(self):
        found, queue, steps = {_END: 0}, [_END], {}
        for vector in queue:
            for sign in range(SYMBOLS):
                costs = _before(vector, sign)
                low = min(costs)
                shape = tuple(c - low for c in costs)
                if shape not in found:
                    found[shape] = len(found)
                    queue.append(shape)
                steps[found[vector], sign] = found[shape], low
        self.vectors, n = queue, len(queue)
        self.step = np.array([[steps[v, x][0] for x in range(SYMBOLS)] for v in range(n)])
        self.add = np.array([[steps[v, x][1] for x in range(SYMBOLS)] for v in range(n)])
        self.letters = [[[_edits(queue[v], x, q) for q in range(4)] for x in range(SYMBOLS)] for v in range(n)]
        self.leaves = np.array([[[self.letters[v][x][q][1] for q in range(4)] for x in range(SYMBOLS)] for v in range(n)], np.uint8)
        digits = np.array(list(itertools.product(range(SYMBOLS), repeat=BLOCK)))
        ids = np.repeat(np.arange(n)[:, None], len(digits), axis=1)
        total, behind = np.zeros_like(ids), []
        for k in reversed(range(BLOCK)):
            behind.insert(0, ids)
            total = total + self.add[ids, digits[:, k]]
            ids = self.step[ids, digits[:, k]]
        self.block_step, self.block_add = ids, total
        state = np.tile(np.arange(4, dtype=np.uint8), (n, len(digits), 1))
        for k in range(BLOCK):
            state = self.leaves[behind[k][:, :, None], digits[None, :, k, None], state]
        self.block_leaves = state
        self.expand = functools.lru_cache(200_000)(self._expand)

    def _expand(self, vector: int, code: int, state: int) -> tuple[tuple[str, ...], int]:
        """Edits of every row of a block, found backward from the vector behind it, and the state behind it."""
        rows = [code // SYMBOLS**k % SYMBOLS for k in reversed(range(BLOCK))]
        behind = [vector]
        for sign in reversed(rows[1:]):
            behind.append(int(self.step[behind[-1], sign]))
        out = []
        for sign, after in zip(rows, reversed(behind)):
            letters, state = self.letters[after][sign][state]
            out.append(letters)
        return tuple(out), state


@functools.lru_cache(1)
def tables() -> Tables:
    return Tables()


def _coded(signs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The symbols in front of the first whole block, and the codes of the blocks."""
    head = len(signs) % BLOCK
    return signs[:head], signs[head:].reshape(-1, BLOCK) @ (SYMBOLS ** np.arange(BLOCK - 1, -1, -1))


def summary(signs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A segment as functions of the vector behind it: vector in front, cost added, state behind for each state in front."""
    t = tables()
    head, codes = _coded(signs)
    ids = np.arange(len(t.vectors))
    total, behind = np.zeros_like(ids), []
    for code in codes[::-1]:
        behind.append(ids)
        total, ids = total + t.block_add[ids, code], t.block_step[ids, code]
    for sign in head[::-1]:
        behind.append(ids)
        total, ids = total + t.add[ids, sign], t.step[ids, sign]
    state = np.tile(np.arange(4, dtype=np.uint8), (len(t.vectors), 1))
    for sign in head:
        state = t.leaves[behind.pop()[:, None], sign, state]
    for code in codes:
        state = t.block_leaves[behind.pop()[:, None], code, state]
    return ids, total, state


def cost_of(signs: np.ndarray, vector: int = 0) -> tuple[int, list[int], int]:
    """(vector in front, vectors behind every head symbol and block from first to last, cost added)."""
    t = tables()
    head, codes = _coded(signs)
    behind, total = [], 0
    for code in codes[::-1].tolist():
        behind.append(vector)
        total, vector = total + int(t.block_add[vector, code]), int(t.block_step[vector, code])
    for sign in head[::-1].tolist():
        behind.append(vector)
        total, vector = total + int(t.add[vector, sign]), int(t.step[vector, sign])
    return vector, behind[::-1], total


def traced(signs: np.ndarray, behind: list[int], state: int = START) -> tuple[list[str], int]:
    """Letters of every row and the state behind the last, from the vectors that `cost_of` gives."""
    t = tables()
    head, codes = _coded(signs)
    out = []
    for sign, after in zip(head.tolist(), behind):
        letters, state = t.letters[after][sign][state]
        out.append(letters)
    for code, after in zip(codes.tolist(), behind[len(head) :]):
        letters, state = t.expand(after, code, state)
        out.extend(letters)
    return out, state


def ending(state: int) -> str:
    """Turns to insert behind the last row."""
    return "I" * (_END[state] // INSERT)


def written(letters: str, role: str, text: str, state: int) -> tuple[list[tuple[str, str]], int]:
    """Turns that a row's letters write, and the state behind them."""
    out = []
    for letter in letters:
        if letter == "D":
            continue
        name = "user" if _FOLLOWS[state] == USER else "assistant"
        if letter == "K":
            out.append((role, text))
            state = SYSTEM if role[:1] == "s" else _FOLLOWS[state]
            continue
        out.append((name, "" if letter == "I" else text))
        state = _FOLLOWS[state]
    return out, state

"""Block tables of a cheapest-edit automaton over turn sequences (the Four-Russians way).

Role initials must end up as ``(s?(ua)+)?``.  The states are the last initial kept: none, s, u, a.  For each place between rows
there is a vector of four costs-to-go, one per state.  Since any state reaches any other by few edits, the
differences within a vector are bounded, so there are few vectors up to a constant.  The tables hold, for every such
normalised vector behind a block of ``BLOCK`` symbols, the vector before it and the constant added; a
sequence is costed by one lookup per block, from its end.

Tracing goes forward with the vectors of the block borders.  Each block is expanded backward into the vectors
between its rows, so that of all cheapest edits the ASCII-least initial can be told at every step; the result of an
expansion is kept by (block, vector behind it, state before it).
"""

from __future__ import annotations

from functools import cached_property, lru_cache

import numpy as np

# Fixed by the task: costs of edits, and what an undeleted truncated row adds.
INSERT, REROLE, DELETE, CUT = 3, 3, 4, 3
START, SYSTEM, USER, ASSISTANT = range(4)
INITIALS = "sua"  # other initials fit nowhere
EXPECTED = (USER, USER, ASSISTANT, USER)  # the one role that may be put in after each state
KEPT = {(START, 0): SYSTEM, (START, 1): USER, (SYSTEM, 1): USER, (USER, 2): ASSISTANT, (ASSISTANT, 1): USER}
FINAL = (0, None, None, 0)
# Symbols: a row that must go; clean rows by initial (s, u, a, other); truncated ones likewise; no row.
GONE, CLEAN, TRUNCATED, PAD, SYMBOLS = 0, 1, 5, 9, 10
BLOCK = 3
_FAR = 1 << 20


def _with_inserts(costs: list[int]) -> tuple[int, ...]:
    for _ in range(3):
        costs = [min(c, INSERT + costs[EXPECTED[s]]) for s, c in enumerate(costs)]
    return tuple(costs)


def _moves(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """``(edit, cost, state after)`` of a row's symbol, in ASCII order; inserts are apart."""
    out = [("D", DELETE, state)]
    if symbol != GONE:
        cut = CUT if symbol >= TRUNCATED else 0
        to = KEPT.get((state, symbol - (TRUNCATED if symbol >= TRUNCATED else CLEAN)))
        if to is not None:
            out.append(("K", cut, to))
        out.append(("R", REROLE + cut, EXPECTED[state]))
    return out


def before(behind: tuple[int, ...], symbol: int) -> tuple[int, ...]:
    """Costs-to-go in front of a symbol from those behind it."""
    if symbol == PAD:
        return behind
    return _with_inserts([min(c + behind[to] for _, c, to in _moves(symbol, s)) for s in range(4)])


def walk(behind: tuple[int, ...], symbol: int, state: int) -> tuple[str, int]:
    """The ASCII-least of the cheapest edits up to and including a symbol's row, and the state after it."""
    if symbol == PAD:
        return "", state
    here, done = before(behind, symbol), ""
    while True:
        fits = {e: to for e, c, to in _moves(symbol, state) if c + behind[to] == here[state]}
        if "D" in fits:
            return done + "D", fits["D"]
        if INSERT + here[EXPECTED[state]] == here[state]:
            done, state = done + "I", EXPECTED[state]
            continue
        edit = min(fits)
        return done + edit, fits[edit]


class Tables:
    """Transitions of normalised vectors: by symbol (``*_of_symbol``) and by block."""

    def __init__(self) -> None:
        end = _with_inserts([_FAR if c is None else c for c in FINAL])
        self.vectors, known, nxt, add = [end], {end: 0}, [], []
        for vector in self.vectors:  # grows while new vectors appear
            reached = [before(vector, symbol) for symbol in range(SYMBOLS)]
            least = [min(r) for r in reached]
            for r, low in zip(reached, least):
                normal = tuple(c - low for c in r)
                if normal not in known:
                    known[normal] = len(self.vectors)
                    self.vectors.append(normal)
            nxt.append([known[tuple(c - low for c in r)] for r, low in zip(reached, least)])
            add.append(least)
        self.end = 0  # the vector behind the last row
        self.next_of_symbol, self.add_of_symbol = np.array(nxt, np.uint8), np.array(add, np.int64)
        self.walks = [[[walk(v, symbol, s) for s in range(4)] for symbol in range(SYMBOLS)] for v in self.vectors]
        self._expanded: dict = {}

    @cached_property
    def _digits(self) -> list[np.ndarray]:
        codes = np.arange(SYMBOLS ** BLOCK)
        return [codes // SYMBOLS ** (BLOCK - 1 - i) % SYMBOLS for i in range(BLOCK)]

    @cached_property
    def between(self) -> list[np.ndarray]:
        """For each row of a block, the vector behind it: arrays (vector behind the block, block)."""
        behind = [np.repeat(np.arange(len(self.vectors))[:, None], SYMBOLS ** BLOCK, 1)]
        for digit in reversed(self._digits[1:]):
            behind.append(self.next_of_symbol[behind[-1], digit[None, :]].astype(np.int64))
        return behind[::-1]

    @cached_property
    def next(self) -> np.ndarray:
        return self.next_of_symbol[self.between[0], self._digits[0][None, :]]

    @cached_property
    def add(self) -> np.ndarray:
        return sum(self.add_of_symbol[b, d[None, :]] for b, d in zip(self.between, self._digits))

    @cached_property
    def ends(self) -> np.ndarray:
        """State after a block: array (vector behind, block, state before)."""
        after = np.array([[[end for _, end in by_state] for by_state in by_symbol] for by_symbol in self.walks], np.uint8)
        state = np.broadcast_to(np.arange(4), (*self.between[0].shape, 4))
        for b, d in zip(self.between, self._digits):
            state = after[b[:, :, None], d[None, :, None], state]
        return state

    @cached_property
    def lists(self) -> tuple[list, list, list]:
        """The block tables as lists, quicker to look single entries up in."""
        return self.next.tolist(), self.add.tolist(), self.ends.tolist()

    def expand(self, code: int, behind: int, state: int) -> str:
        """Edits of a block, from the vectors between its rows."""
        key = (code, behind, state)
        if key not in self._expanded:
            edits = []
            for b, d in zip(self.between, self._digits):
                text, state = self.walks[b[behind, code]][d[code]][state]
                edits.append(text)
            self._expanded[key] = "".join(edits)
        return self._expanded[key]

    # sequences ---------------------------------------------------------------------------------------------

    @staticmethod
    def blocks(symbols: np.ndarray) -> np.ndarray:
        padded = np.full(-(-len(symbols) // BLOCK) * BLOCK, PAD, np.int64)
        padded[: len(symbols)] = symbols
        return padded.reshape(-1, BLOCK) @ (SYMBOLS ** np.arange(BLOCK - 1, -1, -1))

    def summarize(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A whole sequence as a function of the vector behind it: vector before, cost added, states after (by state before)."""
        codes = self.blocks(symbols)
        vector, total, behind = np.arange(len(self.vectors)), np.zeros(len(self.vectors), np.int64), []
        for code in codes[::-1]:
            behind.append(vector)
            total = total + self.add[vector, code]
            vector = self.next[vector, code]
        state = np.tile(np.arange(4, dtype=np.uint8), (len(self.vectors), 1))
        for code, b in zip(codes, reversed(behind)):
            state = np.take_along_axis(self.ends[b, code], state.astype(np.int64), 1)
        return vector.astype(np.uint8), total, state.astype(np.uint8)

    def trace(self, symbols: np.ndarray, behind: int, state: int) -> str:
        """Edits of a sequence with the vector behind it and the state before it."""
        nxt, _, ends = self.lists
        codes, vectors = self.blocks(symbols).tolist(), []
        for code in reversed(codes):
            vectors.append(behind)
            behind = nxt[behind][code]
        edits = []
        for code, vector in zip(codes, reversed(vectors)):
            edits.append(self.expand(code, vector, state))
            state = ends[vector][code][state]
        return "".join(edits)

    def closing(self, state: int) -> str:
        """Inserts behind the last row."""
        return "I" * (self.vectors[self.end][state] // INSERT)


@lru_cache(maxsize=1)
def tables() -> Tables:
    return Tables()

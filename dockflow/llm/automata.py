"""Deterministic automata as transition arrays, run over many strings at once with numpy."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from re import _constants as op
from re import _parser

import numpy as np


@dataclass
class Nfa:
    """States with moves on symbol sets (bit masks), free moves, and accept tags."""

    moves: list[list[tuple[int, int]]] = field(default_factory=list)
    free: list[list[int]] = field(default_factory=list)
    accepts: dict[int, int] = field(default_factory=dict)

    def state(self) -> int:
        self.moves.append([])
        self.free.append([])
        return len(self.moves) - 1

    def closure(self, states: Iterable[int]) -> frozenset[int]:
        seen = set(states)
        todo = list(seen)
        while todo:
            for t in self.free[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(seen)


@dataclass
class Dfa:
    """``table[state * n_classes + classes[symbol]]`` is the next state; state 0 starts. ``tags`` are accept bit masks."""

    table: np.ndarray
    classes: np.ndarray
    n_classes: int
    tags: np.ndarray
    _plain: tuple | None = field(default=None, repr=False, compare=False)

    def run(self, symbols: np.ndarray, starts: np.ndarray, lengths: np.ndarray, sticky: bool) -> np.ndarray:
        """Accept masks of many strings in one pass over their symbols: of the last state, or if sticky of all states.

        Strings advance together, one symbol a step, longest first, so the arrays shrink as strings end. The last few,
        which are much longer than the others, go on one at a time.
        """
        order = np.argsort(-lengths, kind="stable")
        at, long = starts[order], lengths[order]
        state = np.zeros(len(order), np.int32)
        hits = np.zeros(len(order), self.tags.dtype)
        counts = np.searchsorted(-long, -np.arange(1, int(long[0]) + 1 if len(long) else 1), "right")
        mapped = self.classes[symbols]
        for p, n in enumerate(counts):
            if n <= 16:
                for k in range(n):
                    body = mapped[at[k] + p : at[k] + long[k]].tolist()
                    state[k], seen = self._alone(int(state[k]), body, sticky)
                    hits[k] |= seen
                break
            state[:n] = self.table[state[:n] * self.n_classes + mapped[at[:n] + p]]
            if sticky:
                hits[:n] |= self.tags[state[:n]]
        out = np.empty_like(hits)
        out[order] = hits if sticky else self.tags[state]
        return out

    def _alone(self, state: int, classes: list[int], sticky: bool) -> tuple[int, int]:
        """The state after one string, and what was accepted on the way."""
        table, tags, width, seen = self._lists()
        hits = 0
        for c in classes:
            state = table[state * width + c]
            if sticky and seen[state]:
                hits |= tags[state]
        return state, hits

    def _lists(self) -> tuple[list[int], list[int], int, list[bool]]:
        if self._plain is None:
            tags = self.tags.tolist()
            self._plain = self.table.tolist(), tags, self.n_classes, [bool(t) for t in tags]
        return self._plain

    def resets(self) -> np.ndarray:
        """For each symbol, whether every state returns to the start on it, so that no match contains it."""
        return (self.table.reshape(-1, self.n_classes) == 0).all(axis=0)[self.classes]


def symbol_classes(masks: Iterable[int], n_symbols: int) -> tuple[np.ndarray, list[int]]:
    """Symbols that no mask tells apart share a class; the class of each symbol and one symbol of each class."""
    groups = [(1 << n_symbols) - 1]
    for mask in set(masks):
        groups = [part for g in groups for part in (g & mask, g & ~mask) if part]
    classes = np.zeros(n_symbols, np.int32)
    firsts = []
    for k, g in enumerate(groups):
        firsts.append((g & -g).bit_length() - 1)
        for s in range(n_symbols):
            if g >> s & 1:
                classes[s] = k
    return classes, firsts


def determinise(nfa: Nfa, start: int, n_symbols: int, search: bool, tag: Callable[[frozenset[int]], int] | None = None) -> Dfa:
    """Subset construction, then minimisation. With ``search`` a match may begin anywhere."""
    classes, firsts = symbol_classes((m for moves in nfa.moves for m, _ in moves), n_symbols)
    by_class = [[[t for m, t in moves if m >> s & 1] for s in firsts] for moves in nfa.moves]
    begin = nfa.closure([start])
    closed = [nfa.closure([s]) for s in range(len(nfa.moves))]
    names = {begin: 0}
    sets = [begin]
    rows: list[list[int]] = []
    while len(rows) < len(sets):
        here = sets[len(rows)]
        row = []
        for k in range(len(firsts)):
            to: set[int] = set(begin) if search else set()
            for s in here:
                for t in by_class[s][k]:
                    to |= closed[t]
            name = frozenset(to)
            if name not in names:
                names[name] = len(sets)
                sets.append(name)
            row.append(names[name])
        rows.append(row)
    read = tag or (lambda states: sum({nfa.accepts[s] for s in states if s in nfa.accepts}))
    return minimise(np.array(rows, np.int32), np.array([read(s) for s in sets], np.int64), classes)


def minimise(rows: np.ndarray, tags: np.ndarray, classes: np.ndarray) -> Dfa:
    """Merge states that no input tells apart: refine by tag, then by the parts that moves lead to, until stable."""
    part = np.unique(tags, return_inverse=True)[1]
    count = part.max() + 1
    while True:
        part = np.unique(np.column_stack([part, part[rows]]), axis=0, return_inverse=True)[1].reshape(-1)
        if part.max() + 1 == count:
            break
        count = part.max() + 1
    first = np.full(count, -1)
    first[part[::-1]] = np.arange(len(part))[::-1]
    order = np.argsort(first, kind="stable")
    rank = np.empty(count, np.int32)
    rank[order] = np.arange(count)
    keep = first[order]
    return Dfa(rank[part[rows[keep]]].astype(np.int32).reshape(-1), classes, rows.shape[1], tags[keep])


def add_regex(nfa: Nfa, start: int, pattern: str, tag: int) -> None:
    """Add the byte language of a regular expression (ASCII; no groups by number, no look-around) from a start state."""

    def mask_of(items, fold: bool) -> int:
        mask, negate = 0, False
        for kind, value in items:
            if kind is op.NEGATE:
                negate = True
            elif kind is op.LITERAL:
                mask |= 1 << value
            elif kind is op.RANGE:
                for c in range(value[0], value[1] + 1):
                    mask |= 1 << c
            else:
                raise ValueError(f"not supported: {kind}")
        if fold:
            for c in range(65, 91):
                if mask >> c & 1 or mask >> (c + 32) & 1:
                    mask |= 1 << c | 1 << (c + 32)
        return ((1 << 256) - 1) ^ mask if negate else mask

    def build(seq, at: int, fold: bool) -> int:
        for kind, value in seq:
            if kind in (op.LITERAL, op.IN):
                to = nfa.state()
                nfa.moves[at].append((mask_of([(kind, value)] if kind is op.LITERAL else value, fold), to))
                at = to
            elif kind is op.SUBPATTERN:
                at = build(value[3], at, (fold or bool(value[1] & 2)) and not value[2] & 2)
            elif kind is op.BRANCH:
                end = nfa.state()
                for branch in value[1]:
                    nfa.free[build(branch, at, fold)].append(end)
                at = end
            elif kind is op.MAX_REPEAT:
                least, most, body = value
                for _ in range(least):
                    at = build(body, at, fold)
                if most is op.MAXREPEAT:
                    loop = nfa.state()
                    nfa.free[at].append(loop)
                    nfa.free[build(body, loop, fold)].append(loop)
                    at = loop
                else:
                    end = nfa.state()
                    nfa.free[at].append(end)
                    for _ in range(most - least):
                        at = build(body, at, fold)
                        nfa.free[at].append(end)
                    at = end
            else:
                raise ValueError(f"not supported: {kind}")
        return at

    entry = nfa.state()
    nfa.free[start].append(entry)
    nfa.accepts[build(_parser.parse(pattern), entry, False)] = tag

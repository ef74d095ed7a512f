"""Deterministic automata: rule regexes by subset construction and minimisation into one table.

``compile_rules`` reads byte regexes (literals, classes, groups, alternatives, repeats, ``(?i:...)``)
into a nondeterministic automaton, makes it deterministic over classes of bytes that no rule tells
apart, and merges equal states. ``Table.scan`` drives many stretches of a buffer at once and then
mends each stretch from the state in which the one before it ended. ``Table.longest`` follows many
matches at once from their first bytes.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np

RESET = 0xFF  # never part of UTF-8; leads back to the start
LANES = 2048


class _Nfa:
    def __init__(self):
        self.free: list[list[int]] = []  # moves without a byte
        self.moves: list[list[tuple[frozenset[int], int]]] = []

    def state(self) -> int:
        self.free.append([])
        self.moves.append([])
        return len(self.free) - 1

    def add(self, parsed, at: int, fold: bool) -> int:
        """Appends a parsed regex from state ``at``; returns the state behind it."""
        for kind, value in parsed:
            at = self._one(str(kind), value, at, fold)
        return at

    def _one(self, kind: str, value, at: int, fold: bool) -> int:
        if kind in ("LITERAL", "IN"):
            allowed = {value} if kind == "LITERAL" else set()
            for part, x in value if kind == "IN" else ():
                allowed |= {x} if str(part) == "LITERAL" else set(range(x[0], x[1] + 1))
            if fold:
                allowed |= {ord(c) for b in allowed for c in (chr(b).lower(), chr(b).upper())}
            end = self.state()
            self.moves[at].append((frozenset(allowed), end))
            return end
        if kind == "SUBPATTERN":
            return self.add(value[3], at, fold or bool(value[1] & re.IGNORECASE))
        if kind == "BRANCH":
            end = self.state()
            for way in value[1]:
                self.free[self.add(way, self._after(at), fold)].append(end)
            return end
        if kind == "MAX_REPEAT":
            least, most, body = value
            for _ in range(least):
                at = self.add(body, at, fold)
            if most == re._constants.MAXREPEAT:
                loop = self._after(at)
                self.free[self.add(body, loop, fold)].append(loop)
                return self._after(loop)
            for _ in range(most - least):
                end = self.add(body, self._after(at), fold)
                self.free[at].append(end)
                at = end
            return at
        raise ValueError(f"{kind} is not part of a rule")

    def _after(self, at: int) -> int:
        new = self.state()
        self.free[at].append(new)
        return new

    def closure(self, states) -> frozenset[int]:
        found, left = set(states), list(states)
        while left:
            for x in self.free[left.pop()]:
                if x not in found:
                    found.add(x)
                    left.append(x)
        return frozenset(found)

    def reversed(self) -> _Nfa:
        other = _Nfa()
        for _ in self.free:
            other.state()
        for at, (free, moves) in enumerate(zip(self.free, self.moves)):
            for to in free:
                other.free[to].append(at)
            for allowed, to in moves:
                other.moves[to].append((allowed, at))
        return other


@dataclass
class Table:
    """State 0 is the start. ``next[state * classes + class_of[byte]]`` is the next state;
    ``accepts[state]`` has a bit per rule; ``dead`` is the state without a way on, or -1."""

    next: np.ndarray
    class_of: np.ndarray
    classes: int
    accepts: np.ndarray
    dead: int

    def _step(self, state: np.ndarray, classes: np.ndarray) -> np.ndarray:
        return self.next[state.astype(np.int32) * self.classes + classes]

    def scan(self, data: np.ndarray) -> np.ndarray:
        """Rules that end at each byte, as bits; one pass over all bytes for all rules."""
        size = len(data)
        steps = max(1, -(-size // LANES))
        padded = np.full(steps * LANES, RESET, np.uint8)
        padded[:size] = data
        columns = np.ascontiguousarray(self.class_of[padded].reshape(LANES, steps).T)
        trace = np.empty((steps, LANES), self.next.dtype)
        state = np.zeros(LANES, self.next.dtype)
        for t in range(steps):
            state = trace[t] = self._step(state, columns[t])
        begun = np.zeros_like(state)
        while True:  # stretches that began in another state, until they go on as before
            ends = np.append(np.zeros(1, trace.dtype), trace[-1, :-1])
            active = np.flatnonzero(ends != begun)
            if not len(active):
                break
            begun, state = ends, ends[active]
            for t in range(steps):
                state = self._step(state, columns[t, active])
                other = state != trace[t, active]
                active, state = active[other], state[other]
                if not len(active):
                    break
                trace[t, active] = state
        return self.accepts[trace].T.reshape(-1)[:size]

    def longest(
        self, data: np.ndarray, starts: np.ndarray, rules: int
    ) -> tuple[np.ndarray, np.ndarray]:
        """First and last end, by rule, of the matches that begin at each start; -1 if none does.
        ``data`` ends with RESET. All starts take a step at once, and a state that leads to itself is
        left in one jump, so the steps do not grow with the length of runs."""
        classes = self.class_of[data]
        table = self.next.reshape(-1, self.classes)
        loops = table == np.arange(len(table))[:, None]
        leaves: dict[int, np.ndarray] = {}
        first = np.full((rules, len(starts)), -1, np.int64)
        last = first.copy()
        lane, at, state = np.arange(len(starts)), starts.copy(), np.zeros(len(starts), np.int64)
        while len(lane):
            state = table[state, classes[at]]
            live = state != self.dead
            lane, at, state = lane[live], at[live] + 1, state[live]
            bits = self.accepts[state]
            for rule in range(rules):
                new = (bits >> rule & 1 == 1) & (first[rule, lane] < 0)
                first[rule, lane[new]] = at[new]
            for q in np.flatnonzero(np.bincount(state, minlength=len(table))).tolist():
                if loops[q].any():
                    if q not in leaves:
                        leaves[q] = np.flatnonzero(~loops[q][classes])
                    own = state == q
                    at[own] = leaves[q][np.searchsorted(leaves[q], at[own])]
            for rule in range(rules):
                own = bits >> rule & 1 == 1
                last[rule, lane[own]] = at[own]
        return first, last


def compile_rules(patterns: list[str], anywhere: bool, backwards: bool = False) -> Table:
    """One automaton for all patterns; with ``anywhere`` a match may begin at every byte, without it
    only at the first. ``backwards`` reads from the last byte to the first and tells where matches
    begin."""
    nfa = _Nfa()
    begins, ends = [], []
    for pattern in patterns:
        begins.append(nfa.state())
        ends.append(nfa.add(re._parser.parse(pattern.encode()), begins[-1], False))
    if backwards:
        nfa, begins, ends = nfa.reversed(), ends, begins
    final = {end: 1 << rule for rule, end in enumerate(ends)}
    sets = {x for moves in nfa.moves for x, _ in moves}
    signature: dict[tuple, int] = {}
    class_of = np.zeros(256, np.uint8)
    members = []
    for byte in range(256):
        key = ("reset",) if byte == RESET else tuple(byte in x for x in sets)
        if key not in signature:
            signature[key] = len(signature)
            members.append(byte)
        class_of[byte] = signature[key]
    origin = nfa.closure(begins)
    known, todo, rows = {origin: 0}, [origin], []
    while todo:
        own, row = todo.pop(0), []
        for byte in members:
            to = {end for x in own for allowed, end in nfa.moves[x] if byte in allowed}
            to = nfa.closure(to | origin if anywhere else to)
            if byte == RESET:
                to = origin if anywhere else frozenset()
            if to not in known:
                known[to] = len(known)
                todo.append(to)
            row.append(known[to])
        rows.append(row)
    accepts = np.array([sum(final.get(x, 0) for x in own) for own in known], np.int64)
    return _merged(np.array(rows), accepts, class_of)


def _merged(rows: np.ndarray, accepts: np.ndarray, class_of: np.ndarray) -> Table:
    """Equal states merged: blocks are split until all states of a block go on alike."""
    _, block = np.unique(accepts, return_inverse=True)
    while True:
        _, finer = np.unique(np.column_stack([block, block[rows]]), axis=0, return_inverse=True)
        if finer.max() == block.max():
            break
        block = finer
    order = np.full(block.max() + 1, -1)
    order[block[0]] = 0
    for b in block:
        if order[b] < 0:
            order[b] = order.max() + 1
    block = order[block]
    first = np.array([np.flatnonzero(block == b)[0] for b in range(block.max() + 1)])
    table = block[rows[first]].astype(np.uint16)
    masks = accepts[first]
    plain = [c for c in range(table.shape[1]) if c != class_of[RESET]]
    stuck = [s for s in range(len(table)) if not masks[s] and (table[s, plain] == s).all()]
    return Table(
        table.reshape(-1), class_of, table.shape[1], masks.astype(np.uint8), stuck[0] if stuck else -1
    )

"""Regular expressions over bytes as deterministic automata: subset construction and minimisation.

The dialect has literals, ``.`` for any byte, classes, groups, ``|``, ``?``, ``*``, ``+``, ``{n}``, ``{n,}``, ``{n,m}`` and ``\\xHH``.
Automata are a byte class per byte, a transition array and a bit set of rules per state; state 0 starts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

ALL = (1 << 256) - 1


class _Nfa:
    """Thompson's construction: states with byte edges and empty edges."""

    def __init__(self):
        self.edges: list[list[tuple[int, int]]] = []
        self.empty: list[list[int]] = []

    def state(self) -> int:
        self.edges.append([])
        self.empty.append([])
        return len(self.edges) - 1

    def build(self, node: tuple, start: int) -> int:
        """Add a syntax tree after ``start``; gives its last state."""
        kind, *args = node
        if kind == "set":
            end = self.state()
            self.edges[start].append((args[0], end))
            return end
        if kind == "seq":
            for part in args[0]:
                start = self.build(part, start)
            return start
        if kind == "or":
            end = self.state()
            for part in args[0]:
                first = self.state()
                self.empty[start].append(first)
                self.empty[self.build(part, first)].append(end)
            return end
        part, least, most = args
        for _ in range(least):
            start = self.build(part, start)
        if most is None:
            loop = self.state()
            self.empty[start].append(loop)
            self.empty[self.build(part, loop)].append(loop)
            return loop
        ends = [start]
        for _ in range(most - least):
            start = self.build(part, start)
            ends.append(start)
        end = self.state()
        for e in ends:
            self.empty[e].append(end)
        return end


class _Parser:
    def __init__(self, pattern: str, ignore_case: bool):
        self.text, self.at, self.fold = pattern, 0, ignore_case

    def peek(self) -> str:
        return self.text[self.at:self.at + 1]

    def take(self) -> str:
        self.at += 1
        return self.text[self.at - 1]

    def symbol(self) -> int:
        c = self.take()
        if c != "\\":
            return ord(c)
        c = self.take()
        if c != "x":
            return ord(c)
        self.at += 2
        return int(self.text[self.at - 2:self.at], 16)

    def folded(self, bits: int) -> int:
        if self.fold:
            for low in range(97, 123):
                pair = (1 << low) | (1 << (low - 32))
                if bits & pair:
                    bits |= pair
        return bits

    def alternatives(self) -> tuple:
        parts = [self.sequence()]
        while self.peek() == "|":
            self.take()
            parts.append(self.sequence())
        return parts[0] if len(parts) == 1 else ("or", parts)

    def sequence(self) -> tuple:
        parts = []
        while self.peek() and self.peek() not in "|)":
            parts.append(self.repeated(self.single()))
        return ("seq", parts)

    def single(self) -> tuple:
        c = self.peek()
        if c == "(":
            self.take()
            inner = self.alternatives()
            self.take()
            return inner
        if c == ".":
            self.take()
            return ("set", ALL)
        if c != "[":
            return ("set", self.folded(1 << self.symbol()))
        self.take()
        negated = self.peek() == "^"
        self.at += negated
        bits = 0
        while self.peek() != "]":
            first = last = self.symbol()
            if self.peek() == "-" and self.text[self.at + 1] != "]":
                self.take()
                last = self.symbol()
            bits |= sum(1 << b for b in range(first, last + 1))
        self.take()
        bits = self.folded(bits)
        return ("set", ALL & ~bits if negated else bits)

    def repeated(self, node: tuple) -> tuple:
        while self.peek() and self.peek() in "?*+{":
            c = self.take()
            if c == "{":
                end = self.text.index("}", self.at)
                low, comma, high = self.text[self.at:end].partition(",")
                self.at = end + 1
                node = ("rep", node, int(low), int(high) if high else None if comma else int(low))
            else:
                node = ("rep", node, int(c == "+"), 1 if c == "?" else None)
        return node


@dataclass(frozen=True)
class Automaton:
    byte_class: np.ndarray  # of each byte
    step: np.ndarray  # states x classes
    accept: np.ndarray  # bit set of the rules that end in a state
    dead: int  # the state that no text leads out of to a match, or -1

    def rows(self) -> list[list]:
        """Each state as a list: the list of the next state for each byte, then the accepted rules and the state's number."""
        rows: list[list] = [[] for _ in range(len(self.step))]
        for number, row in enumerate(rows):
            row.extend(rows[t] for t in self.step[number][self.byte_class].tolist())
            row.append(int(self.accept[number]))
            row.append(number == self.dead)
        return rows


def compile_rules(patterns: list[tuple[str, bool]], anywhere: bool) -> Automaton:
    """One minimal automaton for (pattern, ignore case) rules; ``anywhere`` lets a match start at any byte."""
    nfa = _Nfa()
    start = nfa.state()
    finals: dict[int, int] = {}
    if anywhere:
        nfa.edges[start].append((ALL, start))
    for rule, (pattern, fold) in enumerate(patterns):
        first = nfa.state()
        nfa.empty[start].append(first)
        finals[nfa.build(_Parser(pattern, fold).alternatives(), first)] = 1 << rule
    sets = {bits for out in nfa.edges for bits, _ in out}
    signs: dict[tuple, int] = {}
    byte_class = np.array([signs.setdefault(tuple(s >> b & 1 for s in sets), len(signs)) for b in range(256)], np.int64)
    sample = [int(np.argmax(byte_class == c)) for c in range(len(signs))]
    moves = [[frozenset(t for bits, t in out if bits >> b & 1) for b in sample] for out in nfa.edges]

    closed: dict[int, frozenset] = {}
    for s in range(len(nfa.edges)):
        seen, todo = {s}, [s]
        while todo:
            for t in nfa.empty[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        closed[s] = frozenset(seen)

    # Subset construction: a state is the set of places that rules can be at.
    number, order, step = {closed[start]: 0}, [closed[start]], []
    for state in order:
        row = []
        for c in range(len(sample)):
            reached = frozenset().union(*[closed[t] for s in state for t in moves[s][c]])
            if reached not in number:
                number[reached] = len(order)
                order.append(reached)
            row.append(number[reached])
        step.append(row)
    table = np.array(step, np.int64)
    accept = np.array([sum({finals[s] for s in state if s in finals}) for state in order], np.int64)

    # Minimisation: split classes of states by where they lead until nothing changes.
    block = np.unique(accept, return_inverse=True)[1].reshape(-1)
    while True:
        new = np.unique(np.column_stack([block, block[table]]), axis=0, return_inverse=True)[1].reshape(-1)
        if new.max() == block.max():
            break
        block = new
    first = np.array([int(np.argmax(block == k)) for k in range(block.max() + 1)])
    ranks = np.argsort(np.argsort(first))  # state 0 stays the start
    keep = np.sort(first)
    small, ends = ranks[block[table[keep]]], accept[keep]
    stuck = [s for s in range(len(keep)) if not ends[s] and (small[s] == s).all()]
    return Automaton(byte_class, small, ends, stuck[0] if stuck else -1)

"""Regular expressions compiled into one deterministic automaton over bytes.

A small syntax, enough for token rules: literals, ``.``, classes, escapes ``\\d \\w
\\s \\xHH``, groups, ``|`` and the quantifiers ``? * + {m} {m,} {m,n}``. Rules become
nondeterministic automata, subset construction joins all of them into one
deterministic automaton, and partition refinement minimises it. The result is a
transition array ``state * 256 + byte`` and, per state, a bit for each rule that
accepts there.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

ALL = frozenset(range(256))
CLASSES = {
    "d": frozenset(b"0123456789"),
    "w": frozenset(b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ_"),
    "s": frozenset(b" \t\n\r\f\v"),
}
MAX_STATES = 20_000


@dataclass(frozen=True)
class Node:
    """A syntax tree: kind is ``set``, ``cat``, ``alt`` or ``rep``."""

    kind: str
    parts: tuple = ()
    symbols: frozenset = frozenset()
    low: int = 0
    high: int | None = None

    def relaxed(self, most: int) -> Node:
        """Accepts a beginning of whatever this accepts: fewer repetitions are asked for."""
        low, high = self.low, self.high
        if self.kind == "rep" and low > most:
            low, high = most, None
        return Node(self.kind, tuple(p.relaxed(most) for p in self.parts), self.symbols, low, high)

    def reversed(self) -> Node:
        parts = tuple(p.reversed() for p in self.parts)
        return Node(self.kind, parts[::-1] if self.kind == "cat" else parts,
                    self.symbols, self.low, self.high)


class Parser:
    """Recursive descent over a pattern."""

    def __init__(self, pattern: str):
        self.text, self.at, self.fold = pattern, 0, False

    def peek(self) -> str:
        return self.text[self.at:self.at + 1]

    def take(self) -> str:
        if self.at >= len(self.text):
            raise ValueError(f"pattern ends early: {self.text}")
        self.at += 1
        return self.text[self.at - 1]

    def parse(self) -> Node:
        node = self.alternatives()
        if self.at != len(self.text):
            raise ValueError(f"unmatched ) in {self.text}")
        return node

    def alternatives(self) -> Node:
        options = [self.sequence()]
        while self.peek() == "|":
            self.take()
            options.append(self.sequence())
        return options[0] if len(options) == 1 else Node("alt", tuple(options))

    def sequence(self) -> Node:
        parts = []
        while self.peek() not in ("", "|", ")"):
            parts.append(self.repeated())
        return Node("cat", tuple(parts))

    def repeated(self) -> Node:
        node = self.single()
        while (mark := self.peek()) and mark in "?*+{":
            self.take()
            if mark == "{":
                end = self.text.index("}", self.at)
                low, comma, high = self.text[self.at:end].partition(",")
                self.at = end + 1
                bounds = (int(low), (int(high) if high else None) if comma else int(low))
            else:
                bounds = {"?": (0, 1), "*": (0, None), "+": (1, None)}[mark]
            node = Node("rep", (node,), low=bounds[0], high=bounds[1])
        return node

    def single(self) -> Node:
        char = self.take()
        if char == "(":
            fold = self.fold
            if self.text.startswith("?i:", self.at):  # letters in either case
                self.at += 3
                self.fold = True
            elif self.text.startswith("?:", self.at):
                self.at += 2
            node = self.alternatives()
            if self.take() != ")":
                raise ValueError(f"unclosed ( in {self.text}")
            self.fold = fold
            return node
        if char == "[":
            return Node("set", symbols=self.char_class())
        if char == ".":
            return Node("set", symbols=ALL - {10})
        if char == "\\":
            return Node("set", symbols=self.cased(self.escape()))
        codes = char.encode()
        if len(codes) == 1:
            return Node("set", symbols=self.cased(frozenset(codes)))
        return Node("cat", tuple(Node("set", symbols=frozenset((c,))) for c in codes))

    def cased(self, symbols: frozenset) -> frozenset:
        if not self.fold:
            return symbols
        text = bytes(symbols)
        return frozenset(text.lower() + text.upper())

    def escape(self) -> frozenset:
        char = self.take()
        if char in CLASSES:
            return CLASSES[char]
        if char == "x":
            self.at += 2
            return frozenset((int(self.text[self.at - 2:self.at], 16),))
        return frozenset({"n": b"\n", "t": b"\t", "r": b"\r"}.get(char, char.encode()))

    def char_class(self) -> frozenset:
        negated = self.peek() == "^"
        if negated:
            self.take()
        found: set[int] = set()
        first = True
        while self.peek() != "]" or first:
            first = False
            char = self.take()
            low = self.escape() if char == "\\" else frozenset(char.encode())
            if self.peek() == "-" and self.text[self.at + 1:self.at + 2] not in ("]", "") \
                    and len(low) == 1:
                self.take()
                char = self.take()
                high = self.escape() if char == "\\" else frozenset(char.encode())
                found.update(range(min(low), max(high) + 1))
            else:
                found |= low
        self.take()
        symbols = self.cased(frozenset(found))
        return ALL - symbols if negated else symbols


class Nfa:
    """States with empty moves and moves on sets of bytes."""

    def __init__(self):
        self.empty: list[list[int]] = []
        self.moves: list[list[tuple[frozenset, int]]] = []

    def state(self) -> int:
        self.empty.append([])
        self.moves.append([])
        return len(self.empty) - 1

    def add(self, node: Node, start: int) -> int:
        """Attach ``node`` behind ``start`` and return its end state."""
        if node.kind == "set":
            end = self.state()
            self.moves[start].append((node.symbols, end))
            return end
        if node.kind == "cat":
            for part in node.parts:
                start = self.add(part, start)
            return start
        if node.kind == "alt":
            end = self.state()
            for part in node.parts:
                begin = self.state()
                self.empty[start].append(begin)
                self.empty[self.add(part, begin)].append(end)
            return end
        body = node.parts[0]
        for _ in range(node.low):
            start = self.add(body, start)
        if node.high is None:
            loop = self.state()
            self.empty[start].append(loop)
            self.empty[self.add(body, loop)].append(loop)
            return loop
        end = self.state()
        for _ in range(node.high - node.low):
            self.empty[start].append(end)
            start = self.add(body, start)
        self.empty[start].append(end)
        return end

    def closure(self, states) -> frozenset:
        found, waiting = set(states), list(states)
        while waiting:
            for s in self.empty[waiting.pop()]:
                if s not in found:
                    found.add(s)
                    waiting.append(s)
        return frozenset(found)


@dataclass(frozen=True)
class Dfa:
    """Transitions as one array of state * 256 + byte; start is state 0."""

    table: np.ndarray
    accepts: np.ndarray

    @property
    def states(self) -> int:
        return len(self.accepts)

    def longest(self, data: bytes, at: int) -> int:
        """End of the longest match that starts at ``at``, or -1.

        State ``dead`` (no way to accept) ends the search.
        """
        table, accepts, dead = self._lists()
        state = 0
        best = at if accepts[0] else -1
        for i in range(at, len(data)):
            state = table[state * 256 + data[i]]
            if state == dead:
                break
            if accepts[state]:
                best = i + 1
        return best

    def _lists(self):
        cached = self.__dict__.get("_cache")
        if cached is None:
            moves = self.table.reshape(-1, 256)
            dead = [s for s in range(self.states)
                    if not self.accepts[s] and (moves[s] == s).all()]
            cached = (self.table.tolist(), self.accepts.tolist(), dead[0] if dead else -1)
            self.__dict__["_cache"] = cached
        return cached


def symbol_groups(sets: list[frozenset]) -> tuple[np.ndarray, list[int]]:
    """Bytes that no set tells apart: group of each byte, one byte of each group."""
    signature: dict[tuple, int] = {}
    group = np.zeros(256, np.int64)
    samples = []
    for byte in range(256):
        key = tuple(byte in s for s in sets)
        if key not in signature:
            signature[key] = len(signature)
            samples.append(byte)
        group[byte] = signature[key]
    return group, samples


def determinise(nodes: list[Node], anywhere: bool) -> Dfa:
    """Subset construction over all rules; ``anywhere`` lets a match start at any byte."""
    nfa = Nfa()
    start = nfa.state()
    ends = {}
    for rule, node in enumerate(nodes):
        begin = nfa.state()
        nfa.empty[start].append(begin)
        ends[nfa.add(node, begin)] = 1 << rule
    if anywhere:
        nfa.moves[start].append((ALL, start))
    group, samples = symbol_groups(list({s for m in nfa.moves for s, _ in m}))
    first = nfa.closure([start])
    number, order, rows = {first: 0}, [first], []
    while len(rows) < len(order):
        states = order[len(rows)]
        row = []
        for byte in samples:
            reached = nfa.closure({t for s in states for m, t in nfa.moves[s] if byte in m})
            if reached not in number:
                if len(order) >= MAX_STATES:
                    raise ValueError(f"the rules need over {MAX_STATES} states")
                number[reached] = len(order)
                order.append(reached)
            row.append(number[reached])
        rows.append(row)
    accepts = np.array([sum({ends[s] for s in states if s in ends}) for states in order], np.int64)
    return minimise(np.array(rows, np.int64), accepts, group)


def minimise(rows: np.ndarray, accepts: np.ndarray, group: np.ndarray) -> Dfa:
    """Refine the partition by accepted rules until no move tells states apart."""
    block = np.unique(accepts, return_inverse=True)[1]
    while True:
        keys = np.concatenate((block[:, None], block[rows]), axis=1)
        refined = np.unique(keys, axis=0, return_inverse=True)[1].reshape(-1)
        if refined.max() == block.max():
            break
        block = refined
    # Number blocks by their first state, so that the start is 0.
    _, first = np.unique(block, return_index=True)
    rank = np.empty(len(first), np.int64)
    rank[np.argsort(first)] = np.arange(len(first))
    chosen = np.sort(first)
    moves = rank[block[rows[chosen]]][:, group]
    return Dfa(moves.astype(np.int32).reshape(-1), accepts[chosen])


# Repetitions kept when looking for starts: in a rule that is one run, and in others.
RUN_LEAD, LEAD = 8, 1


def start_pattern(node: Node) -> Node:
    """What a match must begin with, reversed.

    Counting long runs backwards for several rules at once would multiply their
    states, so runs are counted to a few here; a start found this way is a candidate
    that the rule's own automaton confirms. An end that may be missing is left out: a match
    with it starts where one without it does.
    """
    parts = node.parts
    while node.kind == "cat" and parts and parts[-1].kind == "rep" and not parts[-1].low:
        parts = parts[:-1]
    node = Node(node.kind, parts, node.symbols, node.low, node.high)
    alone = node.kind == "cat" and len(node.parts) == 1
    return node.relaxed(RUN_LEAD if alone else LEAD).reversed()


def compile_rules(patterns: list[str]) -> tuple[Dfa, list[Dfa]]:
    """Automaton of where matches may start, read backwards, and one per rule forwards."""
    nodes = [Parser(p).parse() for p in patterns]
    starts = determinise([start_pattern(n) for n in nodes], anywhere=True)
    return starts, [determinise([n], anywhere=False) for n in nodes]


LANES = 1024


def run(dfa: Dfa, data: np.ndarray, lanes: int = LANES) -> np.ndarray:
    """State behind each byte of ``data``, all lanes of the buffer in step.

    Each lane begins in the start state; a lane whose predecessor ends in another
    state is read again until its states agree, so the result is exact.
    """
    size = -(-len(data) // lanes) if len(data) else 0
    if size < 32:
        lanes, size = 1, len(data)
    padded = np.zeros(lanes * size, np.uint8)
    padded[:len(data)] = data
    columns = np.ascontiguousarray(padded.reshape(lanes, size).T)
    states = np.empty((size, lanes), np.int32)
    now = np.zeros(lanes, np.int32)
    for i in range(size):
        now = dfa.table[now * 256 + columns[i]]
        states[i] = now
    out = np.ascontiguousarray(states.T)
    table = dfa.table
    for lane in range(1, lanes):
        state, i = out[lane - 1, -1], 0
        if state:
            while i < size:
                state = table[state * 256 + padded[lane * size + i]]
                if state == out[lane, i]:
                    break
                out[lane, i] = state
                i += 1
    return out.reshape(-1)[:len(data)]

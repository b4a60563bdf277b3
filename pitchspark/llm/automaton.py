"""Byte regexes compiled to minimal deterministic automata in transition arrays.

The syntax: literals, escapes (``\\x20``, ``\\.``), classes, groups ``( )`` and
``(?: )``, alternation, ``* + ? {m} {m,} {m,n}``; ``(?i: )`` takes ASCII letters
in either case. Matching is on bytes, so ASCII patterns hold for UTF-8 text.
"""

from __future__ import annotations

import numpy as np

LETTERS = frozenset(range(65, 91)) | frozenset(range(97, 123))


# A pattern is a tree: ("set", bytes), ("cat", [..]), ("or", [..]), ("rep", node, low, high or None).
class _Parser:
    def __init__(self, text: str):
        self.text, self.i, self.fold = text, 0, False

    def take(self) -> str:
        self.i += 1
        return self.text[self.i - 1]

    def peek(self, s: str) -> bool:
        return self.text.startswith(s, self.i)

    def either(self):
        branches = [self.sequence()]
        while self.peek("|"):
            self.take()
            branches.append(self.sequence())
        return ("or", branches) if len(branches) > 1 else branches[0]

    def sequence(self):
        parts = []
        while self.i < len(self.text) and self.text[self.i] not in "|)":
            parts.append(self.counted(self.atom()))
        return ("cat", parts)

    def counted(self, node):
        while self.i < len(self.text) and self.text[self.i] in "*+?{":
            c = self.take()
            if c == "{":
                body = ""
                while not self.peek("}"):
                    body += self.take()
                self.take()
                low, _, high = body.partition(",")
                node = ("rep", node, int(low), int(low) if "," not in body else int(high) if high else None)
            else:
                node = ("rep", node, int(c == "+"), 1 if c == "?" else None)
        return node

    def byte(self) -> int:
        c = self.take()
        if c != "\\":
            return ord(c)
        c = self.take()
        if c == "x":
            return int(self.take() + self.take(), 16)
        return {"n": 10, "r": 13, "t": 9}.get(c, ord(c))

    def folded(self, values: set[int]) -> frozenset[int]:
        return frozenset(values | {v ^ 32 for v in values if v in LETTERS} if self.fold else values)

    def atom(self):
        if self.peek("("):
            before = self.fold
            self.take()
            if self.peek("?i:"):
                self.i += 3
                self.fold = True
            elif self.peek("?:"):
                self.i += 2
            node = self.either()
            self.take()
            self.fold = before
            return node
        if self.peek("["):
            self.take()
            negated = self.peek("^") and bool(self.take())
            values: set[int] = set()
            while not self.peek("]"):
                low = self.byte()
                if self.peek("-") and not self.text.startswith("-]", self.i):
                    self.take()
                    values |= set(range(low, self.byte() + 1))
                else:
                    values.add(low)
            self.take()
            found = self.folded(values)
            return ("set", frozenset(range(256)) - found if negated else found)
        if self.peek("."):
            self.take()
            return ("set", frozenset(range(256)) - {10})
        return ("set", self.folded({self.byte()}))


def parse(pattern: str):
    return _Parser(pattern).either()


def reverse(node):
    if node[0] == "cat":
        return ("cat", [reverse(x) for x in node[1][::-1]])
    if node[0] == "or":
        return ("or", [reverse(x) for x in node[1]])
    return ("rep", reverse(node[1]), *node[2:]) if node[0] == "rep" else node


def shortest(node):
    """The same pattern without its trailing repetition: it ends where a match can first end."""
    if node[0] == "cat" and node[1]:
        return ("cat", [*node[1][:-1], shortest(node[1][-1])])
    if node[0] == "or":
        return ("or", [shortest(x) for x in node[1]])
    return ("rep", node[1], node[2], node[2]) if node[0] == "rep" and node[2] else node


class _Nfa:
    def __init__(self):
        self.free: list[list[int]] = []  # moves without a byte
        self.on: list[tuple[frozenset[int], int] | None] = []

    def state(self) -> int:
        self.free.append([])
        self.on.append(None)
        return len(self.free) - 1

    def add(self, node, begin: int) -> int:
        """Build ``node`` from state ``begin`` on; returns its end state."""
        kind = node[0]
        if kind == "set":
            end = self.state()
            source = self.state()
            self.free[begin].append(source)
            self.on[source] = (node[1], end)
            return end
        if kind == "cat":
            for x in node[1]:
                begin = self.add(x, begin)
            return begin
        if kind == "or":
            end = self.state()
            for x in node[1]:
                self.free[self.add(x, begin)].append(end)
            return end
        _, inner, low, high = node
        for _ in range(low):
            begin = self.add(inner, begin)
        if high is None:
            loop, end = self.state(), self.state()
            self.free[begin].append(loop)
            self.free[loop].append(end)
            self.free[self.add(inner, loop)].append(loop)
            return end
        end = self.state()
        for _ in range(high - low):
            self.free[begin].append(end)
            begin = self.add(inner, begin)
        self.free[begin].append(end)
        return end

    def closure(self, states) -> frozenset[int]:
        seen = set(states)
        todo = list(seen)
        while todo:
            for t in self.free[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(seen)


class Automaton:
    """A minimal DFA over byte classes.

    ``step[state * width + byte_class]`` is the next state (already times
    ``width``), ``label[state]`` the bit set of the patterns that end there.
    Class ``reset`` leads to the start from everywhere. State 0 is the start.
    ``anywhere``: a pattern may begin at each byte (a search).
    """

    def __init__(self, patterns: list, anywhere: bool):
        nfa = _Nfa()
        starts, ends = [], {}
        for bit, node in enumerate(patterns):
            starts.append(nfa.state())
            ends.setdefault(nfa.add(node, starts[-1]), 1 << bit)
        sets = {x[0] for x in nfa.on if x}
        signature = [tuple(b in s for s in sorted(sets, key=sorted)) for b in range(256)]
        kinds = {s: i for i, s in enumerate(dict.fromkeys(signature))}
        self.byte_class = np.array([kinds[s] for s in signature], dtype=np.uint8)
        example = {k: signature.index(s) for s, k in kinds.items()}
        begin = nfa.closure(starts)
        number, rows, todo = {begin: 0}, [], [begin]
        while todo:  # subset construction
            now = todo.pop(0)
            row = []
            for k in range(len(kinds)):
                to = nfa.closure(t for s in now if nfa.on[s] and example[k] in nfa.on[s][0] for t in [nfa.on[s][1]])
                to = to | begin if anywhere else to
                if to not in number:
                    number[to] = len(number)
                    todo.append(to)
                row.append(number[to])
            rows.append(row)
        moves = np.array(rows, dtype=np.int64)
        label = np.array([sum({ends[s] for s in subset if s in ends}) for subset in number], dtype=np.int64)
        block = np.unique(label, return_inverse=True)[1]
        while True:  # minimisation: split blocks until all members of one move alike
            finer = np.unique(np.column_stack((block, block[moves])), axis=0, return_inverse=True)[1].ravel()
            if finer.max() == block.max():
                break
            block = finer
        order = np.full(block.max() + 1, -1)
        order[block[0]] = 0
        order[np.flatnonzero(order < 0)] = np.arange(1, len(order))
        block = order[block]
        _, member = np.unique(block, return_index=True)
        self.width = len(kinds) + 1
        self.reset = len(kinds)
        step = np.zeros((len(member), self.width), dtype=np.int64)
        step[:, :-1] = block[moves[member]]
        self.label = label[member]
        self.dead = int(next((s for s in range(len(member)) if s and not self.label[s] and (step[s, :-1] == s).all()), -1))
        self.step = (step * self.width).ravel()
        self.step = self.step.astype(np.uint16 if self.step.max() < 1 << 15 else np.int32)
        self._ends_at = np.repeat(self.label != 0, self.width)
        self._moves, self._labels, self._classes = self.step.tolist(), self.label.tolist(), self.byte_class.tolist()

    @property
    def states(self) -> int:
        return len(self.label)

    def run(self, data: bytes, positions: range, stop_at_first: bool = False) -> tuple[int, int]:
        """Walk the bytes at ``positions``; the last (or first) step that ends a pattern, and its label. (-1, 0): none."""
        state, found, label = 0, -1, 0
        moves, labels, classes, width, dead = self._moves, self._labels, self._classes, self.width, self.dead * self.width
        for p in positions:
            state = moves[state + classes[data[p]]]
            if state == dead:
                break
            if labels[state // width]:
                found, label = p, labels[state // width]
                if stop_at_first:
                    break
        return found, label

    def hits(self, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The places where a pattern ends, ascending, and the labels there: one pass over all bytes.

        The bytes are dealt to lanes that advance together, each from the start
        state; then every lane's head is walked again from the true state of the
        lane before, until both agree (a search forgets its past in a few bytes).
        """
        n = len(classes)
        lanes = max(1, min(2039, n // 256))  # not a power of two: columns then fall on different cache lines
        length = -(-n // lanes)
        padded = np.full(lanes * length, self.reset, dtype=np.uint8)
        padded[:n] = classes
        columns = np.ascontiguousarray(padded.reshape(lanes, length).T)
        trace = np.empty((length, lanes), dtype=self.step.dtype)
        state = np.zeros(lanes, dtype=self.step.dtype)
        for j in range(length):
            state = self.step[state + columns[j]]
            trace[j] = state
        heads, moves = trace[-1].tolist(), self._moves
        for lane in range(1, lanes):
            state, j = heads[lane - 1], 0
            while state and j < length:
                state = moves[state + int(columns[j, lane])]
                if state == trace[j, lane]:
                    break
                trace[j, lane] = state
                j += 1
            if j == length:
                heads[lane] = state
        found = np.flatnonzero(self._ends_at[trace].ravel())
        at = (found % lanes) * length + found // lanes
        order = np.argsort(at)
        return at[order], self.label[trace.ravel()[found[order]] // self.width]

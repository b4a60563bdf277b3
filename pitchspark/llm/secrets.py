"""Secret scans: all rules in one pass over the bytes by a combined minimal automaton.

The rules' regexes are joined, determinised by subset construction and
minimised into transition arrays (``automaton.py``). One pass over a chunk of
texts gives the places where some rule can first match; only there the rule's
reversed automaton finds the match's start and its anchored one the end. A
match of a rule is leftmost and as long as can be, and the next one of that
rule begins after its end; a match too short for the rule (``keep``) is dropped
after it has been consumed.

Nulls and empty texts have no spans. Texts are scanned whole. Rows are neither
merged nor dropped; other columns pass through, a column named like the result
is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .automaton import Automaton, parse, reverse, shortest
from .common import chunks, texts_of


@dataclass(frozen=True)
class Rule:
    """``pattern`` consumes text; a match counts if ``keep`` (by default the pattern) ends there too.

    Condition on a pattern: before the first byte at which a match can end, no
    other match of the rule begins (true of a fixed head and a repeated tail).
    """

    kind: str
    pattern: str
    keep: str = ""


_KEY = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
#: In the order in which spans that start together are listed. A run of hex digits is
#: consumed whole, so asking for 16 in the pattern equals dropping shorter runs.
BASE = [
    Rule("assign", _KEY + r"[A-Za-z0-9+/_.=-]+", _KEY + r"[A-Za-z0-9+/_.=-]{12,}"),
    Rule("access", r"AKIA[A-Z0-9]+", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
]
RULES = [
    *BASE,
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]+", r"AIza[A-Za-z0-9_-]{35,}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]+", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
]

SPANS = "array<struct<kind:string,start:int,end:int>>"


class Scanner:
    """The compiled rules; made once on the driver and sent to the tasks."""

    def __init__(self, rules: list[Rule] | None = None):
        self.rules = RULES if rules is None else rules
        trees = [parse(r.pattern) for r in self.rules]
        firsts = [shortest(t) for t in trees]
        self.combined = Automaton(firsts, anywhere=True)
        self.search = [Automaton([t], anywhere=True) for t in firsts]
        self.back = [Automaton([reverse(t)], anywhere=False) for t in firsts]
        self.whole = [Automaton([t, parse(r.keep or r.pattern)], anywhere=False) for t, r in zip(trees, self.rules, strict=True)]

    def matches(self, text: bytes, rule: int, first: int, last: int) -> list[tuple[int, int]]:
        """Kept matches of one rule, given the first and the last place where one can end first."""
        found, begin, at = [], 0, first
        while at >= 0:
            start, _ = self.back[rule].run(text, range(at, begin - 1, -1))
            end, label = self.whole[rule].run(text, range(start, len(text)))
            if label & 2:
                found.append((start, end + 1))
            begin = end + 1
            at, _ = self.search[rule].run(text, range(begin, last + 1), stop_at_first=True)
        return found

    def scan(self, texts: list[bytes]) -> list[list[tuple[str, int, int]]]:
        """Spans (kind, start, end) of each text in code points, by start, then in the order of the rules."""
        out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
        for a, b in chunks(texts):
            part = texts[a:b]
            data = np.frombuffer(b"\0".join(part) + b"\0", dtype=np.uint8)
            ends = np.cumsum(np.fromiter(map(len, part), dtype=np.int64, count=len(part)) + 1)
            classes = self.combined.byte_class[data]
            classes[ends - 1] = self.combined.reset
            hits, labels = self.combined.hits(classes)
            text_of_hit = np.searchsorted(ends, hits, side="right")
            for i in np.unique(text_of_hit).tolist():
                begin = int(ends[i] - 1 - len(part[i]))
                at, label = hits[text_of_hit == i], labels[text_of_hit == i]
                spans = []
                for rule in range(len(self.rules)):
                    mine = at[label & (1 << rule) != 0] - begin
                    if len(mine):
                        spans += [(s, rule, e) for s, e in self.matches(part[i], rule, int(mine[0]), int(mine[-1]))]
                inside = np.concatenate(([0], np.cumsum((data[begin : ends[i]] & 0xC0) == 0x80)))
                out[a + i] = [(self.rules[r].kind, int(s - inside[s]), int(e - inside[e])) for s, r, e in sorted(spans)]
        return out


def find_secrets(df: DataFrame, text: str = "text", out: str = "secrets", rules: list[Rule] | None = None) -> DataFrame:
    """Add ``out``: the spans of all rules, in code points, end exclusive. No shuffle."""
    scanner = Scanner(rules)

    @F.arrow_udf(SPANS)
    def spans(column):
        import pyarrow as pa

        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        found = scanner.scan(texts_of(column))
        return pa.array([[{"kind": k, "start": s, "end": e} for k, s, e in x] for x in found], kind)

    return df.withColumn(out, spans(F.col(text)))


def redact(df: DataFrame, text: str = "text", spans: str = "secrets", mark: str = "[secret]") -> DataFrame:
    """Replace the spans of ``find_secrets`` in ``text`` by ``mark`` (overlapping spans become one)."""

    @F.arrow_udf("string")
    def cut(texts, found):
        import pyarrow as pa

        out = []
        for t, x in zip(texts.to_pylist(), found.to_pylist(), strict=True):
            if t and x:
                parts, at = [], 0
                for s in x:
                    if s["start"] >= at:
                        parts += [t[at : s["start"]], mark]
                    at = max(at, s["end"])
                t = "".join([*parts, t[at:]])
            out.append(t)
        return pa.array(out, pa.string())

    return df.withColumn(text, cut(F.col(text), F.col(spans)))

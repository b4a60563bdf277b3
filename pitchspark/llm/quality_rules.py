"""Quality rules as a short-circuit cascade ordered by rejection per cost.

Each rule looks at one document and says whether to reject it. On a sample the
share that a rule rejects and the seconds it takes are measured; the cascade
then picks, again and again, the rule with the most rejections per second among
the sample's documents that the rules before it left. A document stops at its
first rejection, so the order changes the time, never the verdict.

Null and empty texts have no words (all counts 0) and fail the first base rule.
Texts are taken whole; rows are neither merged nor dropped; other columns pass.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import texts_of

SYMBOLS = b"#*$%&|<>"
_NOT_SYMBOLS = bytes(b for b in range(256) if b not in SYMBOLS)
_CONTINUATION = bytes(range(0x80, 0xC0))
_WHITE = bytes([0x20, *range(0x09, 0x0E)])
_NOT_UPPER = bytes(b for b in range(256) if not 65 <= b <= 90)
_NOT_LETTER = bytes(b for b in range(256) if not (65 <= b <= 90 or 97 <= b <= 122))
_STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


class Document:
    """A text whose statistics are worked out when a rule first asks for them."""

    __slots__ = ("_dup", "_repeat", "text", "words")

    def __init__(self, text: bytes):
        self.text, self.words = text, text.split()
        self._dup = self._repeat = None

    @property
    def word_chars(self) -> int:
        return len(self.text.translate(None, _CONTINUATION + _WHITE))

    @property
    def symbols(self) -> int:
        return len(self.text.translate(None, _NOT_SYMBOLS))

    @property
    def dup_lines(self) -> int:
        """Lines with a word that equal an earlier line."""
        if self._dup is None:
            lines = [x for x in self.text.split(b"\n") if x.strip()]
            self._dup = len(lines) - len(set(lines))
        return self._dup

    @property
    def repeat_words(self) -> int:
        """Words that lie in a 3-word window found twice or more."""
        if self._repeat is None:
            self._repeat = 0
            windows = list(zip(self.words, self.words[1:], self.words[2:]))  # noqa: B905
            if len(first := set(windows)) < len(windows):
                seen, twice = set(), set()
                for w in windows:
                    (twice if w in seen else seen).add(w)
                covered = 0  # words up to here are counted
                for i, w in enumerate(windows):
                    if w in twice:
                        self._repeat += i + 3 - max(i, covered)
                        covered = i + 3
                del first
        return self._repeat


@dataclass(frozen=True)
class QualityRule:
    name: str
    rejects: Callable[[Document], bool]


#: The rules of the contract; then the method's own. Each is a plain count against a count.
BASE_RULES = [
    QualityRule("few_words", lambda d: len(d.words) < 50),
    QualityRule("repeated_words", lambda d: 100 * d.repeat_words > 50 * len(d.words)),
]
RULES = [
    *BASE_RULES,
    QualityRule("symbols", lambda d: 100 * d.symbols > 40 * len(d.words)),
    QualityRule("capitals", lambda d: 100 * len(d.text.translate(None, _NOT_UPPER)) > 60 * len(d.text.translate(None, _NOT_LETTER))),
    QualityRule("word_length", lambda d: not 2 * len(d.words) <= d.word_chars <= 15 * len(d.words)),
    QualityRule("duplicate_lines", lambda d: 100 * d.dup_lines > 50 * max(1, d.text.count(b"\n") + 1)),
]


@dataclass(frozen=True)
class Measured:
    """What the sample said of a rule when it was placed: share rejected of what was left, and seconds a document."""

    rule: QualityRule
    rejected: float
    cost: float


def order_rules(texts: list[bytes], rules: list[QualityRule], repeats: int = 3) -> list[Measured]:
    """Greedy order by rejection per cost; on an empty sample the order given.

    A rule's cost is measured on fresh documents (splitting into words, which
    every document needs once, is not part of it), the best of ``repeats`` runs.
    """
    verdicts, cost = {}, {}
    for rule in rules:
        best = float("inf")
        for _ in range(repeats):
            documents = [Document(t) for t in texts]
            began = time.perf_counter()
            verdicts[rule.name] = [rule.rejects(d) for d in documents]
            best = min(best, time.perf_counter() - began)
        cost[rule.name] = max(best / max(1, len(texts)), 1e-9)
    left, todo, out = list(range(len(texts))), list(rules), []
    while todo:
        share = {r.name: sum(verdicts[r.name][i] for i in left) / max(1, len(left)) for r in todo}
        best_rule = max(todo, key=lambda r: share[r.name] / cost[r.name])
        todo.remove(best_rule)
        out.append(Measured(best_rule, share[best_rule.name], cost[best_rule.name]))
        left = [i for i in left if not verdicts[best_rule.name][i]]
    return out


def fit_cascade(df: DataFrame, text: str = "text", rules: list[QualityRule] | None = None, sample: int = 1000) -> list[Measured]:
    """Measure the rules on up to ``sample`` texts (chosen by a hash of the text) and order them."""
    rows = df.select(F.col(text).cast("string").alias("t")).where(F.pmod(F.xxhash64("t"), F.lit(16)) == 0).limit(sample).toLocalIterator()
    return order_rules([(r.t or "").encode() for r in rows], RULES if rules is None else rules)


def base_statistics(df: DataFrame, text: str = "text", out: str = "stats") -> DataFrame:
    """Add a struct of the base counts of each whole text. No shuffle."""
    return df.withColumn(out, _assess([], False)(F.col(text)))


def apply_cascade(df: DataFrame, cascade: list[Measured], text: str = "text", out: str = "stats") -> DataFrame:
    """Add the base counts and ``rejected_by``, the first rule in the cascade's order that rejects (null: kept)."""
    return df.withColumn(out, _assess([m.rule for m in cascade], True)(F.col(text)))


def _assess(rules: list[QualityRule], verdict: bool):
    @F.arrow_udf(f"struct<{_STATS.replace(' long', ':bigint')}{',rejected_by:string' if verdict else ''}>")
    def assess(column):
        import pyarrow as pa

        rows = []
        for t in texts_of(column):
            d = Document(t)
            by = next((r.name for r in rules if r.rejects(d)), None)
            rows.append((len(d.words), d.word_chars, d.symbols, d.dup_lines, d.repeat_words, by))
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
        names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
        arrays = [pa.array(c, pa.int64()) for c in columns[:5]]
        if verdict:
            names, arrays = [*names, "rejected_by"], [*arrays, pa.array(columns[5], pa.string())]
        return pa.StructArray.from_arrays(arrays, names)

    return assess


def base_failed(stats: Column) -> Column:
    """The base verdict from the counts of ``base_statistics``."""
    return (stats["n_words"] < 50) | (100 * stats["n_repeat_words"] > 50 * stats["n_words"])

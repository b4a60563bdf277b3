"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of the whole text (shares of character kinds, word and line shapes,
repetition) are binned at quantiles of the fit rows; each tree is grown by
gradient and hessian histograms over the bins (logistic loss). Trees of one
depth are flattened into arrays - feature, cut and leaf value - and all
documents of a batch step down together: node = 2 * node + 1 + (value > cut).

The fit uses at most ``max_rows`` labelled rows (a bound that does not grow
with the data), chosen by a hash of the id among those not held out. Scoring is
a map over all documents without a shuffle. Null texts count as empty; a text
without words has zeros and gets a score like any other; with no labelled row
or one class only the score is that class's share (0.5 without rows). Repeated
labels of an id count as the larger.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE, WORDS_BYTES, Words, chunks, held_out, texts_of

MAX_FIT_ROWS = 20_000

_KINDS = ("upper", "lower", "digit", "space", "newline", "stop", "symbol", "bracket", "other")
_KIND_OF = np.full(256, 8, dtype=np.uint8)
_KIND_OF[65:91], _KIND_OF[97:123], _KIND_OF[48:58] = 0, 1, 2
_KIND_OF[[0x20, 0x09, 0x0B, 0x0C, 0x0D]], _KIND_OF[10] = 3, 4
_KIND_OF[list(b".,;:!?")], _KIND_OF[list(b"#*$%&|<>~^_=+@\\/")], _KIND_OF[list(b"()[]{}\"'`-")] = 5, 6, 7
FEATURES = [
    *(f"share_{k}" for k in _KINDS), "log_bytes", "log_words", "mean_word", "std_word", "max_word", "distinct_words",
    "repeated_next", "repeated_third", "distinct_shingles", "words_ending_stop", "words_upper", "words_symbol",
    "log_lines", "words_a_line", "dup_lines", "exclamations",
]


def statistics(texts: list[bytes]) -> np.ndarray:
    """One row of ``FEATURES`` per text."""
    out = np.zeros((len(texts), len(FEATURES)), dtype=np.float32)
    for a, b in chunks(texts, WORDS_BYTES):
        out[a:b] = _statistics(texts[a:b])
    return out


def _by_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of ``values`` over the ranges first[i]:first[i + 1] (empty ranges: 0)."""
    sums = np.concatenate((np.zeros(1), np.cumsum(values, dtype=np.float64)))
    return sums[first[1:]] - sums[first[:-1]]


def _statistics(texts: list[bytes]) -> np.ndarray:
    w = Words(texts)
    bounds = w.text_starts.copy()
    size = np.maximum(np.diff(bounds) - 1, 0)
    safe = np.maximum(size, 1)
    kind = _KIND_OF[w.data]
    spans = list(zip(bounds[:-1].tolist(), (bounds[1:] - 1).tolist(), strict=True))  # without the joining space
    count = np.stack([np.bincount(kind[x:y], minlength=len(_KINDS)) for x, y in spans], axis=1)
    n = w.counts()
    words = np.maximum(n, 1)
    length = w.ends - w.starts
    h = w.hashes()
    text_of = np.repeat(np.arange(len(texts)), n)
    mean = _by_text(length, w.first) / words
    spread = np.sqrt(np.maximum(_by_text(length.astype(np.float64) ** 2, w.first) / words - mean**2, 0))
    longest = np.zeros(len(texts))
    if len(length):
        filled = n > 0
        longest[filled] = np.maximum.reduceat(length, w.first[:-1][filled])
    again = np.zeros(len(h), bool)
    again[1:] = (h[1:] == h[:-1]) & (text_of[1:] == text_of[:-1])
    last = w.data[w.ends - 1] if len(h) else np.zeros(0, np.uint8)
    begins = w.data[w.starts] if len(h) else last
    shingle, whole = w.shingles(3)
    distinct, distinct3, dup, lines = (np.zeros(len(texts)) for _ in range(4))
    for i, (x, y) in enumerate(zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True)):
        distinct[i] = len(np.unique(h[x:y]))
        distinct3[i] = len(np.unique(shingle[x : y - 2])) / (y - x - 2) if y - x > 2 else 1
        rows = [r for r in texts[i].split(b"\n") if r.strip()]
        lines[i], dup[i] = len(rows), (len(rows) - len(set(rows))) / max(1, len(rows))
    bang = np.array([t.count(b"!") for t in texts])
    return np.column_stack([
        *(count / safe), np.log1p(size), np.log1p(n), mean, spread, longest, distinct / words,
        _by_text(again, w.first) / words, 1 - distinct3, distinct3, _by_text(_KIND_OF[last] == 5, w.first) / words,
        _by_text((_KIND_OF[begins] == 0) & (_KIND_OF[last] != 1), w.first) / words,
        _by_text(_KIND_OF[last] == 6, w.first) / words, np.log1p(lines), n / np.maximum(lines, 1), dup, bang / words,
    ]).astype(np.float32)


@dataclass
class BoostedTrees:
    """Complete trees of ``depth``: inner nodes of tree t in ``feature[t]``/``cut[t]``, leaves in ``value[t]``."""

    base: float
    depth: int
    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        margin = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut, value in zip(self.feature, self.cut, self.value, strict=True):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            margin += value[node - (2**self.depth - 1)]
        return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, bins: int = 64, rate: float = 0.15, l2: float = 2.0) -> BoostedTrees:
    """Grow the trees by histograms. Without both classes: no trees, the share as score."""
    share = float(np.clip(y.mean(), 1e-6, 1 - 1e-6)) if len(y) else 0.5
    base = float(np.log(share / (1 - share)))
    inner, leaves = 2**depth - 1, 2**depth
    if not len(y) or y.min() == y.max():
        return BoostedTrees(base, depth, *(np.zeros((0, k), t) for k, t in ((inner, np.int64), (inner, np.float32), (leaves, np.float64))))
    n, m = x.shape
    cuts = np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1], axis=0).astype(np.float32)  # bins - 1 cuts a feature
    binned = np.stack([np.searchsorted(cuts[:, j], x[:, j], side="left") for j in range(m)], axis=1)
    flat = binned + np.arange(m) * bins
    margin = np.full(n, base)
    out = BoostedTrees(base, depth, np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf, np.float32), np.zeros((trees, leaves)))
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, np.maximum(p * (1 - p), 1e-12)
        node = np.zeros(n, dtype=np.int64)
        for level in range(depth):
            width, begin = 2**level, 2**level - 1
            at = ((node - begin) * (m * bins))[:, None] + flat
            hist = [np.bincount(at.ravel(), np.repeat(v, m), width * m * bins).reshape(width, m, bins).cumsum(axis=2) for v in (g, h)]
            gl, hl = (v[:, :, :-1] for v in hist)
            gt, ht = (v[:, :, -1:] for v in hist)
            gain = gl**2 / (hl + l2) + (gt - gl) ** 2 / (ht - hl + l2) - gt**2 / (ht + l2)
            gain[(hl < 1) | (ht - hl < 1)] = -np.inf
            best = gain.reshape(width, -1).argmax(axis=1)
            feature, place = best // (bins - 1), best % (bins - 1)
            good = gain.reshape(width, -1)[np.arange(width), best] > 1e-9
            out.feature[t, begin : begin + width] = feature
            out.cut[t, begin : begin + width] = np.where(good, cuts[place, feature], np.inf)
            mine = node - begin
            node = 2 * node + 1 + (x[np.arange(n), feature[mine]] > out.cut[t, node])
        leaf = node - inner
        out.value[t] = -rate * np.bincount(leaf, g, leaves) / (np.bincount(leaf, h, leaves) + l2)
        margin += out.value[t][leaf]
    return out


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "quality",
                max_rows: int = MAX_FIT_ROWS) -> BoostedTrees:
    """Fit on labelled, not held-out documents; only their statistics (at most ``max_rows``) reach the driver."""
    known = (labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
             .groupBy(F.col(id_col).alias("fit_id")).agg(F.max(label).alias("fit_label"))
             .orderBy(F.xxhash64("fit_id"), "fit_id").limit(max_rows))
    rows = (docs.select(F.col(id_col).alias("fit_id"), F.col(text).alias("t")).join(F.broadcast(known), "fit_id")  # at most max_rows rows
            .select("fit_id", "fit_label", _statistics_udf()(F.col("t")).alias("x")).toPandas().sort_values("fit_id", kind="stable"))
    x = np.array(rows["x"].tolist(), dtype=np.float32).reshape(-1, len(FEATURES))
    return fit_trees(x, rows["fit_label"].to_numpy(dtype=np.float64))


def _statistics_udf():
    @F.arrow_udf("array<float>")
    def numbers(column):
        import pyarrow as pa

        x = statistics(texts_of(column))
        return pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1], pa.array(x.ravel(), pa.float32()))

    return numbers


def score_quality(df: DataFrame, model: BoostedTrees, text: str = "text", out: str = "score") -> DataFrame:
    """Add the score of each whole text, 0 to 1 (higher: better). No shuffle."""

    @F.arrow_udf("double")
    def score(column):
        import pyarrow as pa

        return pa.array(model.score(statistics(texts_of(column))), pa.float64())

    return df.withColumn(out, score(F.col(text)))

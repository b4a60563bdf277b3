"""Token-sort similarity as column expressions (J6 scorer, F8).

Definition adopted by this engine (the scorer library of the reference is
not in its checkout):

* normalise: delete characters U+0080..U+00FF, turn every character that
  is not a letter or digit into a space, lower-case, trim, split on
  whitespace, sort the tokens, join them with one space;
* score = ``2 * LCS(a, b) / (|a| + |b|) * 100`` rounded half to even
  (computed exactly in integers), 0 when either string is empty.

The longest common subsequence uses the bit-parallel recurrence
``V' = (V + (V & M[c])) | (V & ~M[c])`` (Hyyro 2004; Allison and Dix 1986) on
many pairs at once: each pair is a lane of one 64-bit word, or of several where
its shorter string is longer, and a step takes the next character of every
lane's other string. The pairs of an Arrow batch are ordered by length and cut
into slabs, so a lane is hardly wider than its pair needs.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters of patterns compared at once; a single longer pattern is a slab of its own.
SLAB_CHARS = 1 << 18


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def token_sort(col: str | Column) -> Column:
    """Normalised, token-sorted form of a name."""
    s = F.regexp_replace(_col(col), r"[\x{80}-\x{FF}]", "")
    s = F.trim(F.lower(F.regexp_replace(s, r"[^\p{L}\p{N}]", " ")))
    toks = F.filter(F.split(s, r"\s+"), lambda t: t != F.lit(""))
    return F.array_join(F.array_sort(toks), " ")


def _padded(strings: list[str], lengths: np.ndarray, width: int, pad: int) -> np.ndarray:
    """The code points of the strings, one row each, filled up with ``pad``."""
    out = np.full((len(strings), width), pad, np.uint32)
    out[np.arange(width) < lengths[:, None]] = np.frombuffer("".join(strings).encode("utf-32-le"), np.uint32)
    return out


def _lanes(patterns: list[str], texts: list[str], m: np.ndarray, n: np.ndarray) -> np.ndarray:
    words = max(1, -(-int(m.max()) // 64))
    # Neither filler is a code point, so they match nothing; a pattern's filled-up bits stay set.
    pattern = _padded(patterns, m, 64 * words, 0xFFFFFFFE)
    text = np.ascontiguousarray(_padded(texts, n, int(n.max()), 0xFFFFFFFF).T)
    v = np.full((len(m), words), np.uint64(0xFFFFFFFFFFFFFFFF))
    for c in text:
        match = np.packbits(pattern == c[:, None], axis=1, bitorder="little").view("<u8")
        u = v & match
        rest = v & ~match
        carry = np.zeros(len(m), np.uint64)
        for w in range(words):
            total = v[:, w] + u[:, w]
            over = total < u[:, w]
            total += carry
            carry = (over | (total < carry)).astype(np.uint64)
            v[:, w] = total | rest[:, w]
    return 64 * words - np.bitwise_count(v).sum(axis=1, dtype=np.int64)


def lcs_lengths(a: list[str], b: list[str]) -> np.ndarray:
    """LCS lengths of many pairs of strings, any lengths."""
    pairs = [(x, y) if len(x) <= len(y) else (y, x) for x, y in zip(a, b, strict=True)]
    m = np.fromiter((len(x) for x, _ in pairs), np.int64, len(pairs))
    n = np.fromiter((len(y) for _, y in pairs), np.int64, len(pairs))
    out = np.zeros(len(pairs), np.int64)
    order = np.lexsort((n, m))
    order = order[m[order] > 0]
    width = 64 * -(-m[order] // 64)
    begin = 0
    while begin < len(order):
        # Widths rise along the order, so the widest lane of a slab is its last one.
        end = begin + 1
        while end < len(order) and (end - begin + 1) * width[end] <= SLAB_CHARS:
            end += 1
        of = order[begin:end]
        out[of] = _lanes([pairs[i][0] for i in of], [pairs[i][1] for i in of], m[of], n[of])
        begin = end
    return out


def lcs(a: str | Column, b: str | Column) -> Column:
    """LCS length of two string columns, by Arrow batches; 0 where one is null or empty."""

    @F.arrow_udf("int")
    def run(x, y):
        import pyarrow as pa

        return pa.array(lcs_lengths([s or "" for s in x.to_pylist()], [s or "" for s in y.to_pylist()]), pa.int32())

    return run(_col(a), _col(b))


def half_even_score(lcs: Column, total_len: Column) -> Column:
    """``round_half_even(200 * lcs / total_len)`` in exact integer arithmetic."""
    num = F.lit(200) * lcs
    q = F.floor(num / total_len).cast("long")
    r = num - q * total_len
    up = (F.lit(2) * r > total_len) | ((F.lit(2) * r == total_len) & (q % 2 == 1))
    return F.when(total_len <= 0, F.lit(0)).otherwise(q + F.when(up, 1).otherwise(0)).cast("int")


def min_lcs_for(threshold: int, total_len: Column) -> Column:
    """Smallest LCS whose half-even score reaches ``threshold`` for this total length."""
    k = (2 * threshold - 1)
    if threshold % 2 == 1:
        return (F.floor(F.lit(k) * total_len / 400) + 1).cast("long")
    return F.ceil(F.lit(k) * total_len / 400).cast("long")


def min_lcs_py(threshold: int, total_len: int) -> int:
    k = 2 * threshold - 1
    if threshold % 2 == 1:
        return (k * total_len) // 400 + 1
    return -((-k * total_len) // 400)

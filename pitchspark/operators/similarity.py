"""Fuzzy best-match join by token-sort similarity.

For every left name: the right name with the highest score (ties: the
smallest right key), its value if the score reaches the threshold, else 0.

Plan (lossless for the threshold, no cross join):

1. distinct normalised names per side, written once; exact equality is one equi join;
2. a pair reaching the threshold has LCS >= l_min(L), L = |a| + |b|. The lengths that
   occur on each side (a few numbers) say how each pair of lengths meets:
   by deletions (Bocek et al., FastSS, 2007) where both names have at most ``MAX_KEYS``
   subsequences of l_min(L) characters: a pair that matches has one of them in common, a
   pair that does not hardly ever has; else by rare bigrams (steps 3, 4);
3. each name becomes a bag of bigrams tagged with their occurrence number
   (``"ab#2"`` = second ``ab``), so set intersection equals the bag
   intersection; a matching pair shares at least ``tau(L) = 3 * l_min(L) - L - 1`` of them
   (each deletion breaks at most one adjacency of the common
   subsequence in a, each insertion at most one in b);
4. prefix filtering (Chaudhuri et al., ICDE 2006) on sets of k bigrams: order
   the bigrams by global frequency, rarest first; a name keeps its first
   ``n - tau + k`` bigrams. Two names sharing ``tau >= k`` bigrams share k of these, so an
   equi join on all sets of k prefix bigrams yields all candidates. k is as large
   as ``MAX_KEYS`` sets a name allow, so a key is shared by few names however many there are;
5. the side of fewer names writes its keys and makes a map of bits of them, of a fixed size; keys of the
   other side whose bit is not set meet nothing and are never made into rows;
   the length filter and the characters' parities (every deletion changes one) are part of the
   join, before any pair is made; distinct pairs get the exact LCS in lanes (``functions.similarity``);
6. the winner per left name is one minimum by (-score, right key).

Pairs whose total length leaves ``tau <= 0`` and that have too many subsequences are covered by the exact
equality join; the constructor checks that for such lengths only equal
strings can reach the threshold, and refuses thresholds where that fails.
"""

from __future__ import annotations

from collections.abc import Iterable
from itertools import combinations
from math import comb

import numpy as np
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchspark.functions import similarity as S
from pitchspark.session import materialize

DEFAULT_THRESHOLD = 85
MAX_CHECKED_LENGTH = 4096
#: Keys that one way of meeting may give a name.
MAX_KEYS = 600
#: The map of one side's keys has 2 to the power of this many bits (32 MB), whatever the number of keys.
MAP_LOG = 28


def _tau(threshold: int, total: int) -> int:
    return 3 * S.min_lcs_py(threshold, total) - total - 1


def _check_threshold(threshold: int) -> None:
    """Lengths with tau <= 0 must only admit equal strings."""
    for total in range(2, MAX_CHECKED_LENGTH):
        if _tau(threshold, total) > 0:
            continue
        need = S.min_lcs_py(threshold, total)
        for la in range(1, total):
            lb = total - la
            if need <= min(la, lb) and not (la == lb == need):
                raise ValueError(f"threshold {threshold}: unequal names of total length {total} "
                                 "can match without a shared bigram; blocking would lose them")


def _meetings(threshold: int, own: Iterable[int], other: Iterable[int]) -> tuple[dict[int, list[int]], dict[int, dict[int, int]]]:
    """How names of each own length meet the other side's lengths.

    Lengths of common subsequences, and {k: number of rarest bigrams}, by own length.
    """
    deletions: dict[int, set[int]] = {}
    bigrams: dict[int, dict[int, int]] = {}
    partners = sorted(other)
    for a in own:
        for b in partners:
            need, tau = S.min_lcs_py(threshold, a + b), _tau(threshold, a + b)
            if need > min(a, b):
                continue
            if comb(max(a, b), need) <= MAX_KEYS:
                deletions.setdefault(a, set()).add(need)
            elif tau > 0:
                k = min(tau, 2)
                while k < tau and comb(max(a, b) - 1 - tau + k + 1, k + 1) <= MAX_KEYS:
                    k += 1
                sizes = bigrams.setdefault(a, {})
                sizes[k] = max(sizes.get(k, 0), a - 1 - tau + k)
    return {a: sorted(x) for a, x in deletions.items()}, bigrams


def _choices(items: np.ndarray, size: int, seed: int) -> np.ndarray:
    """A key for each choice of ``size`` items of each row, in their order."""
    chosen = np.array(list(combinations(range(items.shape[1]), size)), np.intp).reshape(-1, size)
    key = np.full((len(items), len(chosen)), np.uint64(seed * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
    for j in range(size):
        key = (key ^ items[:, chosen[:, j]]) * np.uint64(0xD6E8FEB86659FD93)
        key ^= key >> np.uint64(32)
    return key


def _keys(names: list[str], grams: list, deletions: dict[int, list[int]], bigrams: dict[int, dict[int, int]]) -> list[np.ndarray]:
    """The keys of each name; ``grams`` has each one's bigrams as hashes, rarest first, or none."""
    lengths = np.fromiter(map(len, names), np.int64, len(names))
    out = [np.empty(0, np.uint64)] * len(names)
    for n in map(int, np.unique(lengths)):
        rows, parts = np.flatnonzero(lengths == n), []
        if n in deletions:
            text = np.frombuffer("".join(names[i] for i in rows).encode("utf-32-le"), np.uint32).reshape(-1, n).astype(np.uint64)
            parts += [_choices(text, size, size) for size in deletions[n]]
        if n in bigrams:
            rare = np.array([grams[i] for i in rows], np.int64).astype(np.uint64)
            parts += [_choices(rare[:, :first], k, -k) for k, first in bigrams[n].items()]
        if parts:
            for i, keys in zip(rows, np.concatenate(parts, axis=1), strict=True):
                out[i] = np.unique(keys)
    return out


def _key_map(keys: DataFrame) -> np.ndarray:
    """A bit for each value of the first ``MAP_LOG`` bits of a key: set where ``keys`` has one."""
    word = F.shiftrightunsigned("key", 64 - MAP_LOG + 6).cast("int")
    bit = F.expr(f"shiftleft(1L, cast(shiftrightunsigned(key, {64 - MAP_LOG}) & 63 as int))")
    found = keys.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    words = np.zeros(1 << (MAP_LOG - 6), np.uint64)
    words[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return words


def _on_map(words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = keys >> np.uint64(64 - MAP_LOG)
    return (words[(at >> np.uint64(6)).astype(np.intp)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


def _key_column(name: str, grams: Column, plan: tuple, known: Broadcast | None) -> Column:
    """The keys of each name; only those on the map ``known``, if there is one."""
    @F.arrow_udf("array<bigint>")
    def run(x, g):
        import pyarrow as pa

        keys = _keys(x.to_pylist(), g.to_pylist(), *plan)
        offsets = np.concatenate([[0], np.cumsum([len(k) for k in keys])]).astype(np.int64)
        values = np.concatenate([*keys, np.empty(0, np.uint64)])
        if known is not None:
            met = _on_map(known.value, values)
            values, offsets = values[met], np.concatenate([[0], np.cumsum(met)])[offsets]
        return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values.astype(np.int64)))

    return run(F.col(name), grams)


def _parities(col: str):
    """64 cells: whether the number of characters that fall into a cell is odd."""
    return F.expr(f"aggregate(split(`{col}`, ''), 0L, (s, x) -> s ^ shiftleft(1L, cast(xxhash64(x) & 63 as int)))")


def _tagged_bigrams(col: str):
    """Array of the bigrams of ``col``, each tagged with its occurrence number."""
    grams = f"transform(sequence(1, length(`{col}`) - 1), k -> substr(`{col}`, k, 2))"
    return F.expr(f"""if(length(`{col}`) < 2, array(),
        transform({grams}, (g, i) -> concat(g, '#', cast(size(filter(slice({grams}, 1, i + 1), x -> x = g)) as string))))""")


def fuzzy_best_match(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                     right_value: str, threshold: int = DEFAULT_THRESHOLD) -> DataFrame:
    """Best right match per distinct left key.

    ``left``: rows with ``left_key`` (the reference's lower/strip name).
    ``right``: one row per ``right_key`` with ``right_value``.
    Returns ``left_key, best_key, score, value`` for every distinct left
    key (value 0 and null best_key when nothing reaches the threshold).
    """
    _check_threshold(threshold)
    lnames = materialize(left.select(F.col(left_key).alias("lkey")).distinct()
                         .withColumn("lp", S.token_sort("lkey")), "fuzzy-left")
    rnames = materialize(right.select(F.col(right_key).alias("rkey"), F.col(right_value).alias("rvalue"))
                         .withColumn("rp", S.token_sort("rkey")), "fuzzy-right")
    lp = lnames.select("lp").where(F.length("lp") > 0).distinct()
    rp = rnames.select("rp").where(F.length("rp") > 0).distinct()

    # 1. exact equality of normalised names
    exact = lp.join(rp, lp["lp"] == rp["rp"]).select("lp", "rp")

    # 2. the lengths of both sides
    llens, rlens = ([r[0] for r in df.select(F.length(c)).distinct().collect()] for df, c in ((lp, "lp"), (rp, "rp")))
    lplan, rplan = _meetings(threshold, llens, rlens), _meetings(threshold, rlens, llens)

    # 3-4. tagged bigrams of the names that need them, global frequency, prefixes
    def grams(df: DataFrame, name: str, plan: tuple) -> DataFrame:
        return df.where(F.length(name).isin(list(plan[1]))).select(name, F.explode(_tagged_bigrams(name)).alias("g"))

    both = [grams(lp, "lp", lplan), grams(rp, "rp", rplan)]
    freq = both[0].select("g").unionByName(both[1].select("g")).groupBy("g").agg(F.count(F.lit(1)).alias("f"))

    # Few bytes of names make many keys: their own number of parts keeps them from being dealt by those bytes,
    # and the join below from broadcasting keys for the names' size.
    spark = left.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def keys(df: DataFrame, name: str, ex: DataFrame, plan: tuple, bits: str, known: Broadcast | None = None) -> DataFrame:
        some = df.where(F.length(name).isin(list({*plan[0], *plan[1]})))
        rare = F.lit(None).cast("array<bigint>")
        if plan[1]:
            # A name's own grams only: the list is as long as the name.
            ranked = ex.join(freq, "g").groupBy(name).agg(F.sort_array(F.collect_list(F.struct("f", "g"))).alias("gs"))
            some = some.join(ranked.select(name, F.expr("transform(gs, x -> xxhash64(x.g))").alias("gs")), name, "left")
            rare = F.col("gs")
        some = some.select(name, rare.alias("rare")).repartition(parts, F.hash(name))
        return some.select(name, _parities(name).alias(bits), F.explode(_key_column(name, F.col("rare"), plan, known)).alias("key"))

    sides = [(lp, "lp", both[0], lplan, "lbits"), (rp, "rp", both[1], rplan, "rbits")]
    fewer = 0 if lnames.count() < rnames.count() else 1
    made = materialize(keys(*sides[fewer]), "fuzzy-keys")
    met = keys(*sides[1 - fewer], spark.sparkContext.broadcast(_key_map(made)))
    pl, prr = (met, made) if fewer else (made, met)
    total = F.length("lp") + F.length("rp")
    need = S.min_lcs_for(threshold, total)
    near = (F.least(F.length("lp"), F.length("rp")) >= need) & \
           (F.bit_count(F.col("lbits").bitwiseXOR(F.col("rbits"))) <= total - F.lit(2) * need)
    checked = pl.join(prr.hint("merge"), (pl["key"] == prr["key"]) & near & (F.col("lp") != F.col("rp"))).select("lp", "rp").distinct()

    # 5. exact LCS of unequal names; equal ones score 100.
    scored = (checked.select("lp", "rp", S.half_even_score(S.lcs("lp", "rp"), total).alias("score"))
              .unionByName(exact.select("lp", "rp", F.lit(100).alias("score"))))

    # 6. winner per left name: highest score, then smallest right key. The
    # threshold is applied after the aggregate, so no filter on the score is
    # pushed below the LCS.
    keyed = scored.join(rnames, "rp")
    best = (keyed.groupBy("lp").agg(F.min(F.struct((-F.col("score")).alias("minus"), F.col("rkey"), F.col("rvalue"))).alias("w"))
                 .select("lp", F.col("w.rkey").alias("best_key"), (-F.col("w.minus")).alias("score"), F.col("w.rvalue").alias("value"))
                 .where(F.col("score") >= threshold))
    return (lnames.join(best, "lp", "left")
                  .select(F.col("lkey").alias(left_key), "best_key",
                          F.coalesce("score", F.lit(0)).alias("score"),
                          F.coalesce(F.col("value").cast("double"), F.lit(0.0)).alias("value")))

"""Pairs from shared keys, verified once, and their connected components; no group is collected or fully expanded.

``components`` is union-find by large-star and small-star steps: each joins the
edges to one minimum per node (partial sums before the shuffle, so a node with
very many edges is one row on that side, and its edges can be split), writes the
edges to the shared folder and ends when a round changes nothing.

``linked`` finds all links between nodes that share a key without comparing all
members of a key with each other: in a few rounds every member meets the key's
leader only, another one each time; nodes linked so far form components, and
keys whose members are all in one component are done. What is left - members of
one key in different components - is compared completely. Which nodes are
connected is the same as with all pairs, for members of one component are
connected already.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest reachable node) for every node of edges (a, b) but the smallest ones themselves."""
    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    seen = _print(now)
    while seen[0]:
        # Large star: the larger neighbours of a node move to the smallest node around it.
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: a node and its smaller neighbours move to the smallest of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = written(least.select("u", F.col("m").alias("v")).unionByName(moved).distinct(), "edges")
        before, seen = seen, _print(now)
        if before == seen:
            break
    return now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))


def _print(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.hash("v", "u").cast("long"))).first()
    return tuple(row)


def linked(members: DataFrame, rank: list[str], carried: list[str], possible: Callable[[str, str], Column],
           verify: Callable[[DataFrame], DataFrame], first: Callable[[str, str], Column] | None = None, rounds: int = 3, few: int = 0) -> DataFrame:
    """Links (a, b), a < b, that connect what all verified pairs of ``members`` (key, node, carried columns) would.

    In each of ``rounds`` every key has one leader: first the least by ``rank``,
    then one by a hash of key and node, so a node meets other leaders on each of
    its keys. ``possible(x, y)`` is a cheap condition on the columns of two
    members, by prefix. ``verify`` gets distinct pairs (a, b), each once in all,
    and returns those that are links. ``first(x, y)``, for the comparison of what
    is left, is false where both members certainly share an earlier key, so that
    a pair is not made again on all of its keys. ``few``: what is left is compared at
    once, without further rounds, if it has at most so many pairs for each member, or if
    the last round left more than four fifths of them.
    ``members`` is read several times: pass a written table.
    """
    pair = [F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")]
    apart = (F.col("x.key") == F.col("y.key")) & (F.col("x.component") != F.col("y.component")) & possible("x", "y")
    carried = list(dict.fromkeys(["node", "component", *carried]))
    left, placed_once = members.withColumn("component", F.col("node")), members
    links = seen = pairs_left = None

    def verified(pairs: DataFrame) -> None:
        nonlocal links, seen
        if seen is not None:
            pairs = pairs.join(seen, ["a", "b"], "left_anti")
        pairs = written(pairs, "pairs")
        seen = pairs if seen is None else seen.unionByName(pairs)
        found = written(verify(pairs), "links") if not pairs.isEmpty() else pairs
        links = found if links is None else links.unionByName(found)

    for r in range(rounds):
        order = [F.col(c).alias(f"o_{c}") for c in rank] if r == 0 else [F.xxhash64(F.lit(r), "key", "node").alias("o")]
        heads = left.groupBy("key").agg(F.min(F.struct(*order, *carried)).alias("head")).select("key", *(f"head.{c}" for c in carried))
        verified(left.alias("x").join(heads.alias("y"), apart).select(*pair).distinct())
        # Keys that are done stay so, as components only grow: later rounds look at the open ones alone.
        placed = placed_once.join(components(links), "node", "left").withColumn("component", F.coalesce("component", "node"))
        mixed = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("key")
        left = written(placed.join(mixed, "key", "left_semi"), "open-members")
        placed_once = left.drop("component")
        if left.isEmpty():
            return links
        if few:
            n = F.count(F.lit(1)).cast("double")
            size = left.groupBy("key").agg(n.alias("n")).agg(F.sum(F.col("n") * (F.col("n") - 1) / 2), F.sum("n")).first()
            if size[0] <= few * size[1] or (pairs_left is not None and size[0] > 0.8 * pairs_left):
                break
            pairs_left = size[0]
    once = apart & (F.col("x.node") < F.col("y.node"))
    once = once & first("x", "y") if first else once
    verified(left.alias("x").join(left.alias("y"), once).select(*pair).distinct())
    return links

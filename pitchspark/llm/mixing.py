"""Mixing sources to target weights by hash-threshold histograms. DataFrame operations only.

Each row has a 60-bit hash of its id. Tokens are summed by source and the top
12 bits of the hash; the running sum finds the bucket in which a source's
budget ends; only the rows of that boundary bucket are summed again by the next
12 bits, and those of the boundary there by the hash itself. A row is in the
mix if its hash is below its source's threshold: a filter, without sorting.
Thresholds of smaller budgets are lower, so their mixes are contained in those
of larger ones. Every step has partial sums before its shuffle; the windows run
over at most 4,096 buckets of a source, or the few rows of a boundary bucket.

Targets: source k in code-point order (null last) has the k-th of the repeating
weights and that share of all tokens, but at most ``cap`` times its own; the
excess is shared again by weight until no source is above. In closed form:
sources ordered by cap/weight fill up in that order, so the level at which the
rest share evenly follows from running sums. A target of q whole sizes plus a
rest takes every document q times and those below the threshold once more; the
document at the threshold is taken if that comes nearer to the target.

Null ids hash as the empty text, null texts have size 0, repeated rows share a
hash and are taken alike; empty tables give empty results; sources without
words have target 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import small, written

WEIGHTS = (5, 2, 1)
CAP = 3
BUCKET_BITS = 12
HASH_BITS = 60


def id_hash(doc_id: Column) -> Column:
    """The first 60 bits of the MD5 of the id's text, as a non-negative long."""
    text = F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """source, source_size, target: one row per source of ``sized`` (source, size)."""
    rows = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    # One row per source from here on; windows over all of them see only these.
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    rows = (rows.withColumn("place", place)
            .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int")))
            .withColumn("most", F.col("source_size") * cap)
            .withColumn("ratio", F.col("most") / F.col("weight")))
    fill = W.orderBy("ratio", "place")
    full = F.coalesce(F.sum("most").over(fill.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(fill.rowsBetween(W.currentRow, W.unboundedFollowing))
    total = F.sum("source_size").over(W.partitionBy())
    rows = rows.withColumn("level", (total - full) / rest)
    level = F.min_by(F.when(F.col("level") <= F.col("ratio"), F.col("level")),
                     F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "place"))).over(W.partitionBy())
    share = F.coalesce(level * F.col("weight"), F.col("most"))
    return rows.select("source", "source_size", F.least(share, F.col("most").cast("double")).alias("target"))


def _boundary(sums: DataFrame, key: str) -> DataFrame:
    """Per source the ``key`` in which the budget ``rest`` ends, and the tokens before it (``base``)."""
    run = F.sum("tokens").over(W.partitionBy("source").orderBy(key))
    return (sums.withColumn("upto", F.col("base") + run)
            .withColumn("before", F.col("upto") - F.col("tokens"))
            .where((F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("upto"))))


def thresholds(sized: DataFrame, budgets: DataFrame) -> DataFrame:
    """source and ``below``: the rows of ``sized`` (source, size, hash) with ``hash < below`` come next to ``rest`` tokens.

    ``budgets`` has source and rest. Sources whose budget reaches all their tokens have no row.
    """
    same = F.col("d.source").eqNullSafe(F.col("b.source"))
    bounds = budgets.select("source", "rest", F.lit(0).cast("long").alias("base"), F.lit(0).cast("long").alias("head"))
    for level in (1, 2):
        shift = HASH_BITS - BUCKET_BITS * level
        inside = F.shiftright("d.hash", shift + BUCKET_BITS) == F.col("b.head")
        # Sums come first: the join then meets at most 4,096 rows of a source, or the boundary bucket alone.
        sums = sized.groupBy("source", F.shiftright("hash", shift).alias("bucket")).agg(F.sum("size").alias("tokens")) if level == 1 else (
            sized.alias("d").join(small(bounds).alias("b"), same & inside)
            .groupBy("d.source", F.shiftright("d.hash", shift).alias("bucket")).agg(F.sum("d.size").alias("tokens")))
        sums = (sums.alias("d").join(small(bounds).alias("b"), same)
                .select("d.source", "bucket", "tokens", "b.rest", "b.base"))
        bounds = written(_boundary(sums, "bucket").select("source", "rest", F.col("before").alias("base"),
                                                          F.col("bucket").alias("head")), f"mix-bound-{level}")
    inside = F.shiftright("d.hash", HASH_BITS - 2 * BUCKET_BITS) == F.col("b.head")
    exact = (sized.alias("d").join(small(bounds).alias("b"), same & inside)
             .groupBy("d.source", "d.hash").agg(F.sum("d.size").alias("tokens"), F.first("b.rest").alias("rest"), F.first("b.base").alias("base")))
    last = _boundary(exact, "hash")
    nearer = (F.col("upto") - F.col("rest")) < (F.col("rest") - F.col("before"))
    return last.select("source", (F.col("hash") + F.when(nearer, 1).otherwise(0)).alias("below"))


def plan_mix(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """Per source: source_size, target, whole (times all its documents are taken) and below (the threshold of one time more).

    ``sized`` has source, size and hash, and is read several times: pass a written table.
    """
    goal = written(targets(sized, weights, cap)
                   .withColumn("whole", F.coalesce(F.floor(F.expr("target / nullif(source_size, 0)")), F.lit(0)).cast("long"))
                   .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")), "mix-targets")
    found = thresholds(sized, goal)
    return written(goal.alias("g").join(found.alias("t"), F.col("g.source").eqNullSafe(F.col("t.source")), "left")
                   .select("g.source", "source_size", "target", "whole", F.when(F.col("rest") > 0, F.col("below")).otherwise(0).alias("below"))
                   .fillna(0, ["below"]), "mix-plan")


def times(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Add to ``rows`` (with mix_source, mix_hash) the columns of the plan and ``times``, how often a row is taken."""
    plan = small(plan).select(F.col("source").alias("p_source"), "source_size", "target", "whole", "below")
    joined = rows.join(plan, rows["mix_source"].eqNullSafe(plan["p_source"])).drop("p_source")
    once = F.when(F.col("mix_hash") < F.col("below"), 1).otherwise(0)
    return joined.withColumn("times", F.col("whole") + once).drop("whole", "below")

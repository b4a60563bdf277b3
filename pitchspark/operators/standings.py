"""Points tables, positions, position counts, wild cards and stage-reach rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Points for a win, a draw and a loss.
WIN_POINTS, DRAW_POINTS, LOSS_POINTS = 3, 1, 0


def points_table(results: DataFrame, keys: list[str], outcome: str = "outcome",
                 team_a: str = "team_a", team_b: str = "team_b") -> DataFrame:
    """Points per (keys..., team) from outcomes 2 (A wins) / 1 (draw) / 0 (B wins) (A10).

    One pass: each match gives both of its sides; matches without an outcome
    (not played yet) give none. Partial aggregation runs before the shuffle,
    so a hot key only ships one partial row per map task.
    """
    o = F.col(outcome)

    def side(team: str, won: int, lost: int) -> Column:
        return F.struct(F.col(team).alias("team"),
                        F.when(o == won, WIN_POINTS).when(o == 1, DRAW_POINTS).otherwise(LOSS_POINTS).alias("pts"),
                        (o == won).cast("int").alias("w"), (o == 1).cast("int").alias("d"), (o == lost).cast("int").alias("l"))

    both = (results.where(o.isNotNull())
            .select(*keys, F.explode(F.array(side(team_a, 2, 0), side(team_b, 0, 2))).alias("s")).select(*keys, "s.*"))
    return (both.groupBy(*keys, "team")
             .agg(F.count(F.lit(1)).alias("played"), F.sum("w").alias("wins"), F.sum("d").alias("draws"),
                  F.sum("l").alias("losses"), F.sum("pts").alias("points")))


def rank_in_group(table: DataFrame, group_keys: list[str], order: list[Column], out: str = "position") -> DataFrame:
    """Position inside each group by the given order (W3); ties need a final key in ``order``."""
    return table.withColumn(out, F.row_number().over(Window.partitionBy(*group_keys).orderBy(*order)))


def wild_cards(ranked: DataFrame, run_keys: list[str], order: list[Column], place: int = 3,
               k: int = 8, out: str = "wildcard_rank") -> DataFrame:
    """Best ``k`` of the teams finishing ``place`` across groups, per run."""
    third = ranked.where(F.col("position") == place)
    if run_keys:
        w = Window.partitionBy(*run_keys).orderBy(*order)
        return third.withColumn(out, F.row_number().over(w)).where(F.col(out) <= k)
    # One run: each task keeps its k best, then those are merged; only k rows are numbered.
    best = third.orderBy(*order).limit(k).agg(F.collect_list(F.struct(*[F.col(f"`{c}`") for c in third.columns])).alias("rows"))
    return best.select(F.posexplode("rows").alias("place", "row")).select("row.*", (F.col("place") + 1).alias(out))


def advancement(ranked: DataFrame, run_keys: list[str], keys: list[str], order: list[Column], direct: int = 2, wild: int = 8, best: int = 4) -> DataFrame:
    """How often each (keys..., team) finished first to ``best``-th over its runs, and advanced.

    A team advances as one of the ``direct`` first of its group, or as one of the ``wild`` best
    of the next place across a run's groups (W3 with W4). ``ranked`` has one row per run,
    group and team with its ``position``; positions are numbered per run by one window that
    ranks the next place's teams only, and all counts come from one conditional aggregate.
    """
    across = Window.partitionBy(*run_keys, F.col("position") == direct + 1).orderBy(*order)
    ranked = ranked.withColumn("_wild", F.when(F.col("position") == direct + 1, F.row_number().over(across)))
    through = (F.col("position") <= direct) | F.coalesce(F.col("_wild") <= wild, F.lit(False))
    return (ranked.groupBy(*keys, "team")
            .agg(F.count(F.lit(1)).alias("tables"), *[F.count_if(F.col("position") == i).alias(f"times_{i}") for i in range(1, best + 1)],
                 F.count_if(through).alias("advances")))


def stage_rates(log: DataFrame, run: str = "run_id", entity: str = "entity", stage: str = "stage",
                n_runs: Column | None = None) -> DataFrame:
    """Share of runs (x100) in which each entity reached each stage.

    The run count is a scalar subquery over the log; entities that never
    appear are absent, as in the reference.
    """
    total = n_runs if n_runs is not None else log.select(F.count_distinct(run)).scalar()
    return (log.groupBy(entity, stage).agg(F.count_distinct(run).alias("runs"))
               .withColumn("pct", F.col("runs") / total * 100.0))


def position_counts(ranked: DataFrame, keys: list[str], best: int = 3) -> DataFrame:
    """How often each (keys..., team) finished first to ``best``-th over its tables, and in how many it stood.

    ``ranked`` has one row per team and table with its ``position``.
    """
    return (ranked.groupBy(*keys, "team")
            .agg(F.count(F.lit(1)).alias("tables"), *[F.count_if(F.col("position") == i).alias(f"times_{i}") for i in range(1, best + 1)]))

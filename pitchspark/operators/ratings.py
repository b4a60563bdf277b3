"""Chronological Elo ratings (ST1) and the active leaderboard.

Everything that does not depend on running state (result score, home
advantage, competition weight, raw goal index) is computed as columns
before the fold. Entities that never meet those of another group are folded in parallel by
``applyInPandas``. The groups are those of a column the caller
names (``pool``: its entities never meet those of another, and equal names in two pools are two
entities), or else the connected components of the entities that meet at all, found once.
A group with more matches than a task may hold is cut into slices of its own order; round i folds
the i-th slice of every group, each starting from the state table, and its
last ratings make the new state. So the number of rounds follows the largest group, not
the history, a task holds at most the matches of one slice - also of a
pool with a third of the history -, all state is a table in the shared
folder, and every match is in exactly one slice, so none is lost.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchspark.functions import elo as E
from pitchspark.functions.money import strip_ws
from pitchspark.functions.text import title_case
from pitchspark.operators.graph import components
from pitchspark.session import materialize, shared_path

# Matches of one slice of a group: they must fit one task.
SLICE_ROWS = 2_000_000
# What the reference's text conversion makes of a missing team.
NO_TEAM = "nan"


def prepare_matches(df: DataFrame, team_a: str = "team_a", team_b: str = "team_b",
                    date_col: str = "date", home: str = "home_score", away: str = "away_score",
                    tournament: str = "tournament", neutral: str | None = "neutral",
                    clean_names: bool = True) -> DataFrame:
    """Clean inputs and add the stateless terms of each match.

    String team names are stripped and title-cased (P3), a missing one is the
    team ``Nan``; rows with a null date or score are dropped (F1). Adds ``_t`` (order time), ``s``, ``h``,
    ``k`` and ``g_raw``.
    """
    out = df
    if clean_names:
        for c in (team_a, team_b):
            if isinstance(df.schema[c].dataType, T.StringType):
                out = out.withColumn(c, title_case(strip_ws(F.coalesce(F.col(c), F.lit(NO_TEAM)))))
    out = out.dropna(subset=[date_col, home, away])
    neutral_col = F.col(neutral) if neutral and neutral in df.columns else F.lit(False)
    return (out.withColumn("_t", F.unix_micros(F.col(date_col).cast("timestamp")))
               .withColumn("s", E.result_score(home, away))
               .withColumn("h", E.home_advantage(neutral_col, tournament))
               .withColumn("k", E.k_factor(tournament))
               .withColumn("g_raw", E.goal_index_raw(home, away)))


def _elo_step(ra: float, rb: float, s: float, h: float, k: float, g: float) -> float:
    """Points moved from B to A by one match (P14, P15, zero-sum update)."""
    e = 1.0 / (1.0 + 10.0 ** ((rb - (ra + h)) / E.ELO_SCALE))
    if (s == 1.0 and e > E.FAVOURITE_EXPECTATION) or (s == 0.0 and (1.0 - e) > E.FAVOURITE_EXPECTATION):
        g = min(g, E.GD_CAP)
    return k * g * (s - e)


def _fold(pdf: pd.DataFrame) -> pd.DataFrame:
    """The matches of one group in order; ``ra0``/``rb0`` are the ratings before the group's first match."""
    pdf = pdf.sort_values(["_t", "match_id"], kind="mergesort")
    ratings: dict = {}
    ta, tb = pdf["_a"].tolist(), pdf["_b"].tolist()
    s, h, k, g, ra0, rb0 = (pdf[c].astype("float64").tolist() for c in ("s", "h", "k", "g_raw", "ra0", "rb0"))
    n = len(ta)
    pre_a, pre_b, post_a, post_b = [0.0] * n, [0.0] * n, [0.0] * n, [0.0] * n
    for i in range(n):
        ra = ratings.get(ta[i], ra0[i])
        rb = ratings.get(tb[i], rb0[i])
        x = _elo_step(ra, rb, s[i], h[i], k[i], g[i])
        ratings[ta[i]] = ra + x
        ratings[tb[i]] = rb - x
        pre_a[i], pre_b[i], post_a[i], post_b[i] = ra, rb, ra + x, rb - x
    return pd.DataFrame({"match_id": pdf["match_id"].to_numpy(), "_t": pdf["_t"].to_numpy(), "_a": ta, "_b": tb,
                         "elo_a": pre_a, "elo_b": pre_b, "post_a": post_a, "post_b": post_b, "_nth": range(n)})


FOLD_SCHEMA = "match_id long, _t long, _a string, _b string, elo_a double, elo_b double, post_a double, post_b double, _nth long"
_RESULT = ["match_id", "elo_a", "elo_b", "post_a", "post_b", "_nth"]


def _team_key(c: str) -> Column:
    """A team as the fold's key; a missing one is a team like any other."""
    return F.coalesce(F.col(c).cast("string"), F.lit(NO_TEAM))


def _terms(prepared: DataFrame, *more: Column) -> DataFrame:
    return prepared.select(F.col("match_id").cast("long").alias("match_id"), "_t", _team_key("team_a").alias("_a"),
                           _team_key("team_b").alias("_b"), "s", "h", "k", "g_raw", *more)


def _last(rows: DataFrame) -> DataFrame:
    """team, rating after its last match of ``rows``."""
    def side(team: str, post: str, n: int) -> Column:
        return F.struct(F.col(team).alias("team"), F.struct("_t", "match_id", F.lit(n)).alias("at"), F.col(post).alias("rating"))
    both = rows.select(F.explode(F.array(side("_a", "post_a", 0), side("_b", "post_b", 1))).alias("x")).select("x.*")
    return both.groupBy("team").agg(F.max_by("rating", "at").alias("rating"))


def _pooled(team: str) -> Column:
    """A team's key inside its pool; the pool's length keeps different pairs apart."""
    return F.concat(F.length("component").cast("string"), F.lit("|"), F.col("component"), F.lit("|"), F.col(team))


def _sliced(matches: DataFrame, slice_rows: int) -> tuple[DataFrame, int]:
    """``matches`` with ``_slice``, a number inside its component, and how many there are.

    Equal times fall into one slice, so the order across slices is strict.
    """
    sizes = matches.groupBy("component").agg(F.count(F.lit(1)).alias("n"))
    most = sizes.agg(F.max("n")).first()[0] or 0
    slices = max(1, math.ceil(most / slice_rows))
    if slices == 1:
        return matches, 1
    # Only components too large for a task are cut: no more of them than the history has slices.
    large = sizes.where(F.col("n") > slice_rows).select("component")
    at = F.percentile_approx("_t", [i / slices for i in range(1, slices)], 10 * slices)
    bounds = matches.join(large, "component", "left_semi").groupBy("component").agg(F.array_distinct(at).alias("_bounds"))
    number = F.when(F.col("_bounds").isNull(), 0).otherwise(F.size(F.filter("_bounds", lambda b: b <= F.col("_t"))))
    cut = matches.join(bounds, "component", "left").withColumn("_slice", number).drop("_bounds")
    path = shared_path(matches.sparkSession, "elo-slices")
    cut.write.partitionBy("_slice").parquet(path)
    return matches.sparkSession.read.schema(cut.schema).parquet(path), slices


def _sliced_fold(prepared: DataFrame, slice_rows: int, pool: str | None) -> DataFrame:
    if pool:
        terms = _terms(prepared, F.coalesce(F.col(pool).cast("string"), F.lit("")).alias("_pool"))
        matches = terms.withColumnRenamed("_pool", "component")
    else:
        matches = materialize(_terms(prepared), "elo-matches")
        of = components(matches.select(F.col("_a").alias("a"), F.col("_b").alias("b")))
        matches = matches.join(of.select(F.col("node").alias("_a"), "component"), "_a")
    matches, slices = _sliced(matches, slice_rows)
    start = F.lit(E.INITIAL_RATING)
    if slices == 1:
        return matches.withColumn("ra0", start).withColumn("rb0", start).groupBy("component").applyInPandas(_fold, FOLD_SCHEMA).select(_RESULT)
    if pool:  # the state has the teams of all pools
        matches = matches.withColumn("_a", _pooled("_a")).withColumn("_b", _pooled("_b"))
    state = prepared.sparkSession.createDataFrame([], "team string, rating double")
    done = None
    for i in range(slices):
        part = matches.where(F.col("_slice") == i).drop("_slice")
        if i:
            part = (part.join(state.select(F.col("team").alias("_a"), F.col("rating").alias("ra0")), "_a", "left")
                        .join(state.select(F.col("team").alias("_b"), F.col("rating").alias("rb0")), "_b", "left")
                        .withColumn("ra0", F.coalesce("ra0", start)).withColumn("rb0", F.coalesce("rb0", start)))
        else:
            part = part.withColumn("ra0", start).withColumn("rb0", start)
        folded = materialize(part.groupBy("component").applyInPandas(_fold, FOLD_SCHEMA), "elo-done")
        done = folded if done is None else done.unionByName(folded)
        if i < slices - 1:
            last = _last(folded)
            state = materialize(state.join(last.select("team"), "team", "left_anti").unionByName(last), "elo-state")
    return done.select(_RESULT)


def elo_ratings(prepared: DataFrame, pool: str | None = None, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Ratings around each match: ``match_id, elo_a, elo_b, post_a, post_b, _nth`` (its place in its fold).

    ``prepared`` comes from :func:`prepare_matches`. The groups of ``pool``, or else
    the connected components, are folded in parallel, each in slices of about
    ``slice_rows`` matches. With ``pool``, ``prepared`` is read twice, for the groups' sizes and their
    matches: it should come from a written table.
    """
    return _sliced_fold(prepared, slice_rows, pool)


def elo_history(prepared: DataFrame, folded: DataFrame) -> DataFrame:
    """Match rows with the rating of each side before the match."""
    return (prepared.drop("s", "h", "k", "g_raw")
                    .join(folded.select(_RESULT), "match_id")
                    .withColumn("delta_elo", F.col("elo_a") - F.col("elo_b")))


def final_ratings(history: DataFrame, date_col: str = "date", entity: str = "team") -> DataFrame:
    """Rating after each entity's last match and that match's date (A8); of matches of one id, the one folded first counts."""
    def side(team: str, post: str, n: int) -> Column:
        return F.struct(F.col(team).alias(entity), F.struct("_t", "match_id", F.lit(n), (-F.col("_nth")).alias("_nth")).alias("_at"), F.col(date_col).alias("_d"), F.col(post).alias("_r"))

    # Both sides from one row: the fold below runs once.
    sides = history.select(F.explode(F.array(side("team_a", "post_a", 0), side("team_b", "post_b", 1))).alias("_x")).select("_x.*")
    return sides.groupBy(entity).agg(F.max_by("_r", "_at").alias("elo_rating"), F.max("_d").alias("last_date"))


def active_leaderboard(final: DataFrame, cutoff: str, entity: str = "team") -> DataFrame:
    """Entities whose last match is on or after ``cutoff``."""
    return final.where(F.col("last_date") >= F.lit(cutoff).cast(final.schema["last_date"].dataType)) \
                .select(entity, "elo_rating", "last_date")


def leaderboard_head(board: DataFrame, n: int = 15, entity: str = "team") -> DataFrame:
    """Top ``n`` by rating, ties by entity (T2; ``TakeOrderedAndProject``)."""
    return board.orderBy(F.col("elo_rating").desc(), F.col(entity).asc()).limit(n)


"""Pairs of entities and their feature deltas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchspark.functions.elo import outcome_label

def feature_deltas(features: list[str], left: str = "a", right: str = "b",
                   prefix: str = "delta_") -> list[Column]:
    """One ``left.f - right.f`` column per feature (P18); null if either is null."""
    return [(F.col(f"{left}.{f}") - F.col(f"{right}.{f}")).alias(f"{prefix}{f}") for f in features]


def first_per_key(dim: DataFrame, key: str | Column, order: str) -> DataFrame:
    """Keep the first row per key by ``order`` (J5, ``.iloc[0]``); one partial aggregate, no sort."""
    k = F.col(key) if isinstance(key, str) else key
    row = F.struct(order, *[c for c in dim.columns if c != order])
    return dim.groupBy(k.alias("_k")).agg(F.min_by(row, F.col(order)).alias("_row")).select(*[f"_row.{c}" for c in dim.columns])


def pair_matrix(dim: DataFrame, key: str, order: str, features: list[str],
                block: str | None = None, label: str | None = None) -> DataFrame:
    """All unordered pairs a < b (by ``order``) with feature deltas.

    With ``block`` the pairs stay inside a block (equi join plus range
    condition): the form for tables that grow. Without it the result has
    n(n-1)/2 rows by definition; it is meant for a tournament's few dozen
    entities, and how the theta join runs is left to the planner.
    """
    cols = [key, order] + ([block] if block else []) + ([label] if label and label != key else []) + features
    cols = list(dict.fromkeys(cols))
    d = dim.select(*cols)
    a, b = d.alias("a"), d.alias("b")
    lab = label or key
    cond = F.col(f"a.{order}") < F.col(f"b.{order}")
    if block:
        cond = (F.col(f"a.{block}") == F.col(f"b.{block}")) & cond
    head = [F.col(f"a.{block}").alias(block)] if block else []
    return a.join(b, cond, "inner").select(*head, F.col(f"a.{lab}").alias("team_a"), F.col(f"b.{lab}").alias("team_b"),
                                           *feature_deltas(features))


def attach_sides(matches: DataFrame, dim: DataFrame, key: str, features: list[str],
                 side_a: str = "team_a", side_b: str = "team_b") -> DataFrame:
    """Inner-join the dimension to both sides (J3, P22): misses drop rows.

    Columns come back as ``f_A`` / ``f_B``. The planner picks broadcast or
    sort-merge per side from runtime sizes (AQE).
    """
    da = dim.select(F.col(key).alias(side_a), *[F.col(f).alias(f"{f}_A") for f in features])
    db = dim.select(F.col(key).alias(side_b), *[F.col(f).alias(f"{f}_B") for f in features])
    return matches.join(da, side_a, "inner").join(db, side_b, "inner")


def unmatched_entities(entities: DataFrame, entity_col: str, dim: DataFrame, key: str) -> DataFrame:
    """Entities without a dimension row (J8), as a report instead of a crash."""
    return entities.join(dim.select(F.col(key).alias(entity_col)), entity_col, "left_anti")


def training_matrix(matches: DataFrame, dim: DataFrame, key: str, features: list[str],
                    home: str = "home_score", away: str = "away_score", neutral: str = "neutral",
                    date_col: str = "date", decay_days: float = 1000.0) -> DataFrame:
    """Matches with side features, deltas, label, neutral flag and decay weight.

    (J3, P16, P18, P19, P23, A9.) Matches without a score or date are no
    training rows. The decay counts back from the latest date of the rows that
    survive the joins, a scalar subquery, not a window over all rows.
    """
    played = matches.where(F.col(home).isNotNull() & F.col(away).isNotNull() & F.col(date_col).isNotNull())
    sided = attach_sides(played, dim, key, features)
    latest = sided.select(F.max(date_col)).scalar()
    days = F.floor((latest.cast("timestamp").cast("long") - F.col(date_col).cast("timestamp").cast("long")) / 86400)
    deltas = [(F.col(f"{f}_A") - F.col(f"{f}_B")).alias(f"delta_{f}") for f in features]
    return sided.select(
        "match_id", date_col, "team_a", "team_b", home, away,
        outcome_label(home, away).alias("target"), *deltas,
        F.col(neutral).cast("int").alias("is_neutral"),
        days.alias("days_ago"),
        F.exp(-days / F.lit(decay_days)).alias("match_weight"))


def orient_by_host(pairs: DataFrame, hosts: DataFrame, host_key: str = "team") -> DataFrame:
    """Host plays at home.

    Only when exactly one side is a host does that side become home with
    ``is_neutral = 0``; otherwise the pair stays as given and neutral.
    ``reversed`` marks pairs whose home side is ``team_b``. Hosts are
    compared case-insensitively; the host list has no size bound of its
    own, so the join strategy is left to AQE (a broadcast when it is small).
    """
    h = hosts.select(F.lower(F.col(host_key)).alias("_h")).distinct()
    p = (pairs.join(h.withColumnRenamed("_h", "_ha"), F.lower("team_a") == F.col("_ha"), "left")
              .join(h.withColumnRenamed("_h", "_hb"), F.lower("team_b") == F.col("_hb"), "left"))
    a_host, b_host = F.col("_ha").isNotNull(), F.col("_hb").isNotNull()
    rev = b_host & ~a_host
    return (p.withColumn("reversed", rev)
             .withColumn("home_team", F.when(rev, F.col("team_b")).otherwise(F.col("team_a")))
             .withColumn("away_team", F.when(rev, F.col("team_a")).otherwise(F.col("team_b")))
             .withColumn("is_neutral", F.when(a_host != b_host, F.lit(0)).otherwise(F.lit(1)))
             .drop("_ha", "_hb"))


def reorient_probs(p: Column, reversed_flag: Column) -> Column:
    """``[p0, p1, p2] -> [p2, p1, p0]`` when the pair was reversed (P25)."""
    return F.when(reversed_flag, F.reverse(p)).otherwise(p)


def pair_lookup(dim: DataFrame, order: str, label: str, requests: DataFrame, features: list[str],
                req_a: str = "req_a", req_b: str = "req_b") -> DataFrame:
    """Order-insensitive lookup of (a, b) among the pairs of a dimension.

    Two equi joins on the lower-cased names and a subtraction: linear in the
    requests, the pair table is never built. ``reversed`` marks requests whose
    first entity comes second in the pair; their deltas are those of the pair
    negated. Of names that differ in case only the first by ``order`` counts.
    Requests without a pair are dropped (see J8).
    """
    one = first_per_key(dim.select(order, label, *features), F.lower(F.col(label)), order)
    a = one.select(F.lower(label).alias("_ka"), F.col(order).alias("_oa"), *[F.col(f).alias(f"_a_{f}") for f in features])
    b = one.select(F.lower(label).alias("_kb"), F.col(order).alias("_ob"), *[F.col(f).alias(f"_b_{f}") for f in features])
    j = (requests.select(req_a, req_b, F.lower(req_a).alias("_ka"), F.lower(req_b).alias("_kb"))
         .join(a, "_ka").join(b, "_kb").where("_oa <> _ob"))
    return j.select(req_a, req_b, (F.col("_oa") > F.col("_ob")).alias("reversed"),
                    *[(F.col(f"_a_{f}") - F.col(f"_b_{f}")).alias(f"delta_{f}") for f in features])


def argmax_label(p: Column, names: list[str] | None = None) -> Column:
    """Index of the largest probability, first index on ties."""
    idx = F.array_position(p, F.array_max(p)) - 1
    if not names:
        return idx.cast("int")
    return F.element_at(F.array(*[F.lit(n) for n in names]), idx.cast("int") + 1)


def two_way(p0: Column, p2: Column) -> Column:
    """Win probability with the draw removed."""
    return p2 / (p2 + p0)

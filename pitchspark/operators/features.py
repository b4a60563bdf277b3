"""Per-entity features: top-N aggregates, cohesion, form, rank.

All functions declare plans only. Top-N uses ``row_number() <= n`` so the
planner inserts ``WindowGroupLimit`` on both sides of the shuffle: a hot
entity ships at most ``n`` rows per map task, never its whole group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitchspark.functions.money import exact_money, money_millions
from pitchspark.functions.text import join_key, league_key
from pitchspark.operators.numbering import running_total

# Fixed values of the form-rating feature.
BASELINE_FORM_RATING = 6.5 * 0.5
TOP5_LEAGUES = ["england_premier_league", "spain_la_liga", "italy_serie_a",
                "germany_bundesliga", "france_ligue_1"]
LEAGUE_WEIGHTS = [
    ("england_premier_league", 1.00),
    ("spain_la_liga", 0.97),
    ("italy_serie_a", 0.96),
    ("germany_bundesliga", 0.95),
    ("france_ligue_1", 0.93),
    ("portugal_primeira_liga", 0.89),
    ("netherlands_eredivisie", 0.87),
    ("brazil_serie_a", 0.86),
    ("england_efl_championship", 0.84),
    ("argentina_liga_profesional", 0.83),
    ("turkiye_super_lig", 0.82),
    ("saudi_arabia_pro_league", 0.82),
    ("usa_mls", 0.81),
    ("spain_la_liga_2", 0.80),
    ("germany_2.bundesliga", 0.79),
    ("italy_serie_b", 0.78),
    ("france_ligue_2", 0.77),
]
# Club labels that mean "no club" for the cohesion feature.
NO_CLUB_LABELS = ["Unknown", "Without Club", "Retired"]
EXCLUDED_SOURCE_MARKER = "tm_"


def league_weights_df(spark) -> DataFrame:
    """The league weight dimension (P9): always these 17 rows, so it is broadcast and ratings are not shuffled by their few leagues."""
    return F.broadcast(spark.createDataFrame(
        [(k, w, k in TOP5_LEAGUES) for k, w in LEAGUE_WEIGHTS],
        "league_key string, league_weight double, top5 boolean"))


def clean_roster(roster: DataFrame, value_col: str = "market_value",
                 out_col: str = "market_value_m") -> DataFrame:
    """Add the parsed money column in millions."""
    return roster.withColumn(out_col, money_millions(value_col))


def top_n(df: DataFrame, group_cols: list[str], order_col: str, n: int) -> DataFrame:
    """The ``n`` largest rows of ``order_col`` per group.

    Ties are broken arbitrarily, which is harmless because only the values
    are used afterwards.
    """
    w = Window.partitionBy(*group_cols).orderBy(F.col(order_col).desc_nulls_last())
    return (df.withColumn("_rn", F.row_number().over(w))
              .where(F.col("_rn") <= n).drop("_rn"))


def squad_value(roster: DataFrame, entity: str = "country", value: str = "market_value_m",
                n: int = 15) -> DataFrame:
    """log1p of the sum of the ``n`` largest values per entity."""
    top = top_n(roster.select(entity, value), [entity], value, n)
    return (top.groupBy(entity)
               .agg(F.sum(exact_money(value)).cast("double").alias("top_value_sum"))
               .withColumn("log_squad_value", F.log1p("top_value_sum")))


def group_cohesion(roster: DataFrame, entity: str = "country", group: str = "club",
                   value: str = "market_value_m",
                   excluded: list[str] = NO_CLUB_LABELS) -> DataFrame:
    """Two-level weighted aggregate.

    Per (entity, group), null group dropped and excluded labels removed:
    n members and mean value; groups with n >= 2 add
    ``n(n-1)/2 * (ln(1+mean) if mean > 0 else 1)``. Entities without such a
    group get 0.
    """
    kept = roster.where(F.col(group).isNotNull() & ~F.col(group).isin(excluded))
    per_group = (kept.groupBy(entity, group)
                     .agg(F.count(F.lit(1)).alias("n"),
                          (F.sum(exact_money(value)) / F.count(F.lit(1))).cast("double").alias("mean_value"))
                     .where(F.col("n") >= 2))
    weight = F.when(F.col("mean_value") > 0, F.log1p("mean_value")).otherwise(F.lit(1.0))
    scored = (per_group
              .withColumn("pairs", F.col("n") * (F.col("n") - 1) / 2)
              .groupBy(entity)
              .agg(F.sum(F.col("pairs") * weight).alias("chemistry_score")))
    entities = roster.select(entity).distinct()
    return (entities.join(scored, entity, "left")
                    .select(entity, F.coalesce("chemistry_score", F.lit(0.0)).alias("chemistry_score")))


def listed_league(source: Column) -> Column:
    """Whether a file belongs to a league of the weight table (S4, P5, P9): for ``read_reconciled(only=...)``."""
    return ~F.contains(source, F.lit(EXCLUDED_SOURCE_MARKER)) & league_key(source).isin([k for k, _ in LEAGUE_WEIGHTS])


def league_universe(ratings: DataFrame, weights: DataFrame, file_col: str = "source_file",
                    name_col: str = "player", rating_col: str = "rating") -> DataFrame:
    """League ratings restricted to listed leagues, weighted.

    Sources whose path contains ``tm_`` are skipped, and so are sources whose
    key is not in the weight table (inner join; a small table is broadcast by its size).
    """
    keyed = (ratings
             .where(~F.col(file_col).contains(EXCLUDED_SOURCE_MARKER))
             .withColumn("league_key", league_key(file_col)))
    return (keyed.join(weights, "league_key", "inner")
                 .where(F.col(rating_col).isNotNull())
                 .select(join_key(name_col).alias("match_name"), "league_key", "top5",
                         (F.col(rating_col) * F.col("league_weight")).alias("weighted_rating")))


def form_rating(roster: DataFrame, universe: DataFrame, entity: str = "country",
                name_col: str = "name", n: int = 15) -> DataFrame:
    """Current form and top-5 league density per entity.

    The roster is left-joined to the universe on the normalised name; a
    player listed in k leagues gives k rows (fan-out kept on purpose). Rows
    without a rating get the baseline 3.25. Form = mean of the ``n`` best;
    density = distinct matched names in a top-5 league / roster rows.
    """
    keyed = roster.select(entity, join_key(name_col).alias("match_name"))
    sizes = keyed.groupBy(entity).agg(F.count(F.lit(1)).alias("roster_rows"))
    merged = (keyed.join(universe, "match_name", "left")
                   .withColumn("final_rating",
                               F.coalesce("weighted_rating", F.lit(BASELINE_FORM_RATING))))
    form = (top_n(merged.select(entity, "final_rating"), [entity], "final_rating", n)
            .groupBy(entity).agg(F.avg("final_rating").alias("current_form_rating")))
    top5 = (merged.where(F.col("top5"))
                  .groupBy(entity)
                  .agg(F.count_distinct("match_name").alias("top5_players")))
    return (sizes.join(form, entity, "left").join(top5, entity, "left")
                 .select(entity, "current_form_rating",
                         F.when(F.col("roster_rows") > 0,
                                F.coalesce("top5_players", F.lit(0)) / F.col("roster_rows"))
                          .otherwise(F.lit(0.0)).alias("top5_league_density")))


def sum_by_key(df: DataFrame, key: Column | str, value: Column | str, key_name: str = "match_name",
               value_name: str = "minutes") -> DataFrame:
    """Sum of a value per key (A1); partial aggregation happens before the shuffle."""
    k = F.col(key) if isinstance(key, str) else key
    v = F.col(value) if isinstance(value, str) else value
    return df.groupBy(k.alias(key_name)).agg(F.sum(v).alias(value_name))


def top_n_mean(df: DataFrame, entity: str, value: str, n: int, out: str) -> DataFrame:
    """Mean of the ``n`` largest values per entity (A4)."""
    return (top_n(df.select(entity, value), [entity], value, n)
            .groupBy(entity).agg(F.avg(value).alias(out)))


def top_n_median(df: DataFrame, entity: str, value: str, n: int, out: str) -> DataFrame:
    """Exact (interpolated) median of the ``n`` largest values per entity (A5)."""
    return (top_n(df.select(entity, value), [entity], value, n)
            .groupBy(entity).agg(F.median(value).alias(out)))


def last_activity(matches: DataFrame, side_a: str = "team_a", side_b: str = "team_b",
                  date_col: str = "date", entity: str = "entity") -> DataFrame:
    """Latest date per entity over both sides."""
    sides = (matches.select(F.col(side_a).alias(entity), F.col(date_col))
             .unionByName(matches.select(F.col(side_b).alias(entity), F.col(date_col))))
    return sides.groupBy(entity).agg(F.max(date_col).alias("last_date"))


def average_rank_desc(df: DataFrame, value: str, out: str = "avg_rank") -> DataFrame:
    """pandas ``rank(ascending=False)``: ties share the mean position.

    A global rank would pull every row into one task. Instead rows are counted
    per distinct value (partial aggregation) and the counts summed up from the
    largest value down (``numbering.running_total``):
    rank = rows with a larger value + (ties + 1) / 2. Null stays null.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    summed = running_total(counts, [F.col("_v").desc()], "_upto", F.col("_n"))
    ranked = summed.select("_v", (F.col("_upto") - F.col("_n") + (F.col("_n") + 1) / 2.0).alias(out))
    return df.join(ranked, df[value] == ranked["_v"], "left").drop("_v")


# Fixed fill values of the master table (P20).
DEFAULT_RANK = 100.0
DEFAULT_POINTS = 1000.0


def squad_base(roster: DataFrame, entity: str = "country", value: str = "market_value_m",
               n_median: int = 11) -> DataFrame:
    """Total value and median of the ``n_median`` largest values per entity."""
    total = roster.groupBy(entity).agg(F.sum(exact_money(value)).cast("double").alias("total_market_value"))
    med = top_n_median(roster, entity, value, n_median, "median_top11_value")
    return total.join(med, entity, "left")


def build_master(base: DataFrame, features: list[DataFrame], rankings: DataFrame | None = None,
                 elo: DataFrame | None = None, entity: str = "country", dedupe: bool = False) -> DataFrame:
    """Chain of left joins on the title-cased, stripped entity, fills and value rank.

    Feature tables are small per-entity tables; each join is left, so an
    entity without a feature keeps a null (filled only where the reference
    fills). A missing ranking table gives the fill values. ``elo`` has the
    entity and ``elo_rating``. The value rank is taken on ``base``, before the
    joins, so the features are computed once. With ``dedupe`` a feature table
    gives one row per entity (its smallest), else repeated rows fan out.
    """
    from pitchspark.functions.money import strip_ws
    from pitchspark.functions.text import title_case
    key = "_key"

    def keyed(df: DataFrame, cols: list[str]) -> DataFrame:
        out = df.select(title_case(strip_ws(entity)).alias(key), *cols)
        if dedupe:
            row = F.struct(*cols)
            out = out.groupBy(key).agg(F.min(row).alias("_row")).select(key, *[F.col(f"_row.{c}").alias(c) for c in cols])
        return out

    master = average_rank_desc(base, "total_market_value", "tm_value_rank")
    master = master.withColumn(key, title_case(strip_ws(entity)))
    for f in features:
        master = master.join(keyed(f, [c for c in f.columns if c != entity]), key, "left")
    if rankings is not None:
        master = master.join(keyed(rankings, ["fifa_rank", "fifa_points"]), key, "left")
    else:
        master = (master.withColumn("fifa_rank", F.lit(None).cast("double"))
                        .withColumn("fifa_points", F.lit(None).cast("double")))
    if elo is not None:
        master = master.join(keyed(elo, ["elo_rating"]), key, "left")
    master = (master.withColumn("fifa_rank", F.coalesce(F.col("fifa_rank").cast("double"), F.lit(DEFAULT_RANK)))
                    .withColumn("fifa_points", F.coalesce(F.col("fifa_points").cast("double"), F.lit(DEFAULT_POINTS))))
    if "top5_league_density" in master.columns:
        master = master.withColumn("top5_league_density", F.coalesce("top5_league_density", F.lit(0.0)))
    return master.withColumn(entity, F.col(key)).drop(key)

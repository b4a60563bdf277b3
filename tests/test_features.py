"""Feature operators on hand tables."""

import math

from pyspark.sql import functions as F

from pitchspark.operators import features as feat


def test_group_cohesion_edges(spark):
    rows = [("A", "c1", 10.0), ("A", "c1", 20.0), ("A", "c2", 5.0), ("A", None, 9.0), ("A", None, 9.0),
            ("A", "Unknown", 1.0), ("A", "Unknown", 1.0), ("B", "z", 0.0), ("B", "z", 0.0), ("C", "solo", 3.0)]
    df = spark.createDataFrame(rows, "country string, club string, market_value_m double")
    got = {r.country: r.chemistry_score for r in feat.group_cohesion(df).collect()}
    assert math.isclose(got["A"], 1 * math.log1p(15.0))
    assert got["B"] == 1.0          # zero mean club counts with weight 1
    assert got["C"] == 0.0          # no club with two players


def test_average_rank_ties(spark):
    vals = [5, 3, 5, 1, None, 3, 3, 9]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id int, v int")
    got = {r.id: r.avg_rank for r in feat.average_rank_desc(df, "v", "avg_rank").collect()}
    # pandas rank(ascending=False): 9 -> 1, 5 -> 2.5, 3 -> 5, 1 -> 7, null stays null
    assert got == {0: 2.5, 1: 5.0, 2: 2.5, 3: 7.0, 4: None, 5: 5.0, 6: 5.0, 7: 1.0}


def test_top_n_median_even_and_short(spark):
    rows = [("A", float(v)) for v in range(1, 21)] + [("B", 4.0), ("B", 1.0)]
    df = spark.createDataFrame(rows, "country string, v double")
    got = {r.country: r.m for r in feat.top_n_median(df, "country", "v", 11, "m").collect()}
    assert got["A"] == 15.0   # 11 largest of 1..20 are 10..20, median 15
    assert got["B"] == 2.5


def test_form_rating_fan_out(spark):
    roster = spark.createDataFrame([("X", " Ann "), ("X", "bob")], "country string, name string")
    ratings = spark.createDataFrame(
        [("england_premier_league_25_26.csv", "ann", 8.0), ("usa_mls_2025.csv", "ANN", 7.0),
         ("tm_england_premier_league.csv", "bob", 9.0), ("nowhere.csv", "bob", 9.0)],
        "source_file string, player string, rating double")
    uni = feat.league_universe(ratings, feat.league_weights_df(spark))
    r = feat.form_rating(roster, uni).first()
    # ann appears twice (fan-out): 8.0 and 7*0.81; bob gets the baseline 3.25
    assert math.isclose(r.current_form_rating, (8.0 + 7.0 * 0.81 + 3.25) / 3)
    assert math.isclose(r.top5_league_density, 1 / 2)


def test_top_n_plan_has_group_limit(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), F.col("id").cast("double").alias("v"))
    plan = feat.top_n(df, ["g"], "v", 5)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_running_total_equals_a_window_with_hot_key(spark):
    from pyspark.sql import Window
    from pitchspark.operators.numbering import running_total
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 40).cast("string")).alias("k"),
        (F.col("id") % 7).alias("w"), F.col("id"))
    order = [F.col("k").desc(), F.col("id")]
    got = running_total(df, order, "pos", F.col("w"))
    want = df.withColumn("pos", F.sum("w").over(Window.orderBy(*order)))
    assert sorted(map(tuple, got.select("id", "pos").collect())) == sorted(map(tuple, want.select("id", "pos").collect()))
    assert sorted(r.p for r in running_total(df, order, "p").collect()) == list(range(1, 3001))
    assert running_total(df.limit(0), order, "p").count() == 0


def test_master_joins_cleaned_names_and_ranks_first(spark):
    base = spark.createDataFrame([(" spain", 5.0), ("PERU", 5.0), ("chad", 1.0)], "country string, total_market_value double")
    rank = spark.createDataFrame([("Spain ", 3.0, 1500.0), ("Spain", 4.0, 1400.0)], "country string, fifa_rank double, fifa_points double")
    elo = spark.createDataFrame([("Peru", 1600.0)], "country string, elo_rating double")
    got = {r.country: r for r in feat.build_master(base, [], rank, elo, dedupe=True).collect()}
    assert (got["Spain"].fifa_rank, got["Spain"].fifa_points, got["Spain"].tm_value_rank, got["Spain"].elo_rating) == (3.0, 1500.0, 1.5, None)
    assert (got["Peru"].fifa_rank, got["Peru"].elo_rating, got["Chad"].tm_value_rank) == (100.0, 1600.0, 3.0)
    assert feat.build_master(base, [], rank, elo).count() == 4  # repeated rows fan out unless asked otherwise

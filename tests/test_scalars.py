"""Hand-computed tables for the scalar expressions (P1-P15, J6 scorer)."""

import math

from pyspark.sql import functions as F

from pitchspark.functions import elo as E
from pitchspark.functions import similarity as S
from pitchspark.functions.draws import uniform
from pitchspark.functions.money import money_millions, numeric_or_zero
from pitchspark.functions.text import join_key, label_from_stem, league_key, title_case
from pitchspark.operators.ratings import _elo_step


def test_money_parse(spark):
    rows = [("-", 0.0), (None, 0.0), ("€75.00m", 75.0), ("€500k", 0.5), ("€500", 0.0),
            ("€1.20bn", 0.0), (" €12.5m ", 12.5), ("€1,2m", None)]
    df = spark.createDataFrame(rows, "v string, want double")
    got = df.select("want", money_millions("v").alias("got")).collect()
    for r in got:
        assert r.got == r.want


def test_numeric_coerce(spark):
    df = spark.createDataFrame([("90",), ("n/a",), (None,), (" 7 ",)], "m string")
    assert [r[0] for r in df.select(numeric_or_zero("m")).collect()] == [90.0, 0.0, 0.0, 7.0]


def test_title_case_matches_python(spark):
    names = ["côte d'ivoire", "guinea-bissau", "dr congo", "USA", "bosnia and herzegovina", "o'neil 2nd"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r[0] for r in df.select(title_case("n")).collect()]
    assert got == [n.title() for n in names]


def test_keys_and_labels(spark):
    df = spark.createDataFrame([("\t Kane \n", "south_korea_cleaned.csv", "usa_mls_2025.csv")], "a string, f string, g string")
    r = df.select(join_key("a"), label_from_stem("f", "_cleaned.csv"), league_key("g")).first()
    assert r[0] == "kane" and r[1] == "South korea" and r[2] == "usa_mls"


def test_k_factor_rule_order(spark):
    rows = [("FIFA World Cup", 60.0), ("FIFA World Cup qualifying", 30.0), ("UEFA Euro qualifying", 40.0),
            ("Copa América", 40.0), ("African Cup of Nations", 40.0), ("UEFA Nations League", 30.0),
            ("Friendly", 20.0), (None, 20.0)]
    df = spark.createDataFrame(rows, "t string, want double")
    for r in df.select("want", E.k_factor("t").alias("k")).collect():
        assert r.k == r.want


def test_home_advantage_and_goal_index(spark):
    df = spark.createDataFrame([(True, "Friendly", 3, 0), (False, "World Cup", 1, 1), (False, "Friendly", 5, 0)],
                               "n boolean, t string, h int, a int")
    r = df.select(E.home_advantage("n", "t").alias("h"), E.goal_index_raw("h", "a").alias("g")).collect()
    assert [x.h for x in r] == [0.0, 0.0, 100.0]
    assert [x.g for x in r] == [(11 + 3) / 8, 1.0, (11 + 5) / 8]


def test_goal_cap_is_strict():
    # e > 0.80 caps, e == 0.80 does not: pick rb so that e is just above / below.
    g = (11 + 5) / 8
    ra = 1500.0
    rb_cap = ra - 400 * math.log10(0.81 / 0.19)    # e = 0.81
    rb_free = ra - 400 * math.log10(0.79 / 0.21)   # e = 0.79
    x_cap = _elo_step(ra, rb_cap, 1.0, 0.0, 20.0, g)
    x_free = _elo_step(ra, rb_free, 1.0, 0.0, 20.0, g)
    assert abs(x_cap - 20.0 * 1.5 * (1 - 0.81)) < 1e-9
    assert abs(x_free - 20.0 * g * (1 - 0.79)) < 1e-9


def test_half_even_score(spark):
    rows = [(lcs, tot) for tot in range(1, 60) for lcs in range(0, tot + 1)]
    df = spark.createDataFrame(rows, "lcs int, tot int")
    got = df.select("lcs", "tot", S.half_even_score(F.col("lcs"), F.col("tot")).alias("s")).collect()
    for r in got:
        assert r.s == round(200 * r.lcs / r.tot)


def test_token_sort(spark):
    df = spark.createDataFrame([("  Ring-Small x ",), ("",)], "n string")
    assert [r[0] for r in df.select(S.token_sort("n")).collect()] == ["ring small x", ""]


def test_uniform(spark):
    df = spark.range(20000).select(uniform(7, F.col("id")).alias("u"))
    r = df.agg(F.min("u"), F.max("u"), F.avg("u")).first()
    assert 0.0 <= r[0] and r[1] < 1.0 and abs(r[2] - 0.5) < 0.01

"""Pairs (J4, J7, P18, P24-P26) and Elo (ST1) properties."""

import datetime as dt
import random

from pyspark.sql import functions as F

from pitchspark.functions import elo as E
from pitchspark.operators import pairs as pr
from pitchspark.operators import ratings as rt
from pitchspark.operators.ratings import _elo_step


def _dim(spark, n=12):
    rows = [(i, f"T{i}", float(i * 3 % 7), float(i)) for i in range(n)]
    return spark.createDataFrame(rows, "id int, team string, f1 double, f2 double")


def test_pair_count_and_swap(spark):
    d = _dim(spark)
    pm = pr.pair_matrix(d, "id", "id", ["f1", "f2"], label="team")
    rows = pm.collect()
    assert len(rows) == 12 * 11 // 2
    req = spark.createDataFrame([(r.team_b.lower(), r.team_a) for r in rows], "req_a string, req_b string")
    looked = pr.pair_lookup(d, "id", "team", req, ["f1", "f2"]).collect()
    orig = {(r.team_a, r.team_b): (r.delta_f1, r.delta_f2) for r in rows}
    for r in looked:
        assert r.reversed
        o = orig[(r.req_b, r.req_a.upper())]
        assert (r.delta_f1, r.delta_f2) == (-o[0], -o[1])


def test_blocked_pairs(spark):
    d = _dim(spark).withColumn("grp", (F.col("id") % 3).cast("string"))
    pm = pr.pair_matrix(d, "id", "id", ["f1"], block="grp", label="team")
    assert pm.count() == 3 * (4 * 3 // 2)


def test_host_orientation(spark):
    pairs = spark.createDataFrame([("A", "B"), ("C", "A"), ("A", "D"), ("C", "D")], "team_a string, team_b string")
    hosts = spark.createDataFrame([("a",), ("d",)], "team string")
    got = {(r.team_a, r.team_b): (r.home_team, r.reversed, r.is_neutral)
           for r in pr.orient_by_host(pairs, hosts).collect()}
    assert got[("A", "B")] == ("A", False, 0)
    assert got[("C", "A")] == ("A", True, 0)
    assert got[("A", "D")] == ("A", False, 1)   # both hosts: as given, neutral
    assert got[("C", "D")] == ("D", True, 0)
    p = spark.createDataFrame([([0.2, 0.3, 0.5], True), ([0.2, 0.3, 0.5], False)], "p array<double>, r boolean")
    assert [x[0] for x in p.select(pr.reorient_probs(F.col("p"), F.col("r"))).collect()] == [[0.5, 0.3, 0.2], [0.2, 0.3, 0.5]]


def test_argmax_first_on_ties(spark):
    df = spark.createDataFrame([([0.4, 0.4, 0.2],), ([0.2, 0.4, 0.4],), ([0.1, 0.2, 0.7],)], "p array<double>")
    assert [r[0] for r in df.select(pr.argmax_label(F.col("p"))).collect()] == [0, 1, 2]


def _matches(spark, n_matches=400, n_teams=9, pools=2, seed=3):
    rnd = random.Random(seed)
    tours = ["World Cup", "World Cup qualifying", "Copa America", "Friendly", "Nations League"]
    rows = []
    for i in range(n_matches):
        pool = i % pools
        a, b = rnd.sample(range(n_teams), 2)
        rows.append((i, pool, dt.datetime(2000, 1, 1) + dt.timedelta(days=rnd.randint(0, 300)),
                     f"p{pool}t{a}", f"p{pool}t{b}", rnd.randint(0, 5), rnd.randint(0, 4), rnd.choice(tours),
                     rnd.random() < 0.3))
    schema = ("match_id long, pool int, date timestamp, team_a string, team_b string, home_score int, "
              "away_score int, tournament string, neutral boolean")
    return rows, spark.createDataFrame(rows, schema)


def _serial(rows):
    ratings = {}
    out = {}
    for r in sorted(rows, key=lambda r: (r[2], r[0])):
        _, _, _, a, b, hs, as_, t, n = r
        a, b = a.strip().title(), b.strip().title()
        ra, rb = ratings.get(a, 1500.0), ratings.get(b, 1500.0)
        s = 1.0 if hs > as_ else 0.5 if hs == as_ else 0.0
        tl = t.lower()
        finals = "world cup" in tl and "qualifying" not in tl
        h = 0.0 if n or finals else 100.0
        k = 60.0 if finals else 40.0 if any(m in tl for m in ("euro", "copa", "cup of nations")) else \
            30.0 if ("qualifying" in tl or "nations league" in tl) else 20.0
        gd = abs(hs - as_)
        g = 1.0 if gd <= 1 else 1.5 if gd == 2 else (11 + gd) / 8
        x = _elo_step(ra, rb, s, h, k, g)
        ratings[a], ratings[b] = ra + x, rb - x
        out[r[0]] = (ra, rb)
    return out, ratings


def test_pool_fold_equals_serial_and_zero_sum(spark):
    rows, df = _matches(spark)
    prepared = rt.prepare_matches(df)
    got = {r.match_id: (r.elo_a, r.elo_b) for r in rt.elo_ratings(prepared, pool="pool").collect()}
    want, final = _serial(rows)
    assert got.keys() == want.keys()
    for k, v in want.items():
        assert abs(got[k][0] - v[0]) < 1e-9 and abs(got[k][1] - v[1]) < 1e-9
    assert abs(sum(final.values()) - E.INITIAL_RATING * len(final)) < 1e-6


def test_pools_cut_by_time_equal_the_serial_fold(spark):
    """A pool with most of the matches is folded slice by slice; equal names in two pools are two teams."""
    rows, df = _matches(spark, n_matches=80, n_teams=6, pools=3, seed=9)
    rows = [(*r[:1], 0 if r[0] % 4 else r[1], *r[2:]) for r in rows]
    plain = [(*r[:3], r[3][2:], r[4][2:], *r[5:]) for r in rows]
    prepared = rt.prepare_matches(spark.createDataFrame(plain, df.schema))
    want, _ = _serial([(*r[:3], f"{r[1]}{r[3]}", f"{r[1]}{r[4]}", *r[5:]) for r in plain])
    for slice_rows in (1000, 15):
        got = {r.match_id: (r.elo_a, r.elo_b) for r in rt.elo_ratings(prepared, pool="pool", slice_rows=slice_rows).collect()}
        assert got.keys() == want.keys()
        assert all(abs(got[k][0] - want[k][0]) < 1e-9 and abs(got[k][1] - want[k][1]) < 1e-9 for k in want)


def test_sliced_fold_equals_the_serial_one(spark):
    """Also with a missing team, a team that meets itself, equal dates and slices of a few matches."""
    rows, _ = _matches(spark, n_matches=60, n_teams=8, pools=3, seed=5)
    day = rows[0][2]
    rows += [(900, 0, day, None, "p0t1", 2, 0, "Friendly", False), (901, 0, day, "p0t1", "p0t1", 3, 0, "Friendly", True),
             (902, 0, day, "p1t1", None, 1, 1, "Friendly", False), (903, 2, day, "p2t0", "p1t3", 4, 0, "World Cup", False)]
    schema = ("match_id long, pool int, date timestamp, team_a string, team_b string, home_score int, "
              "away_score int, tournament string, neutral boolean")
    prepared = rt.prepare_matches(spark.createDataFrame(rows, schema))
    want, final = _serial([(*r[:3], r[3] or "nan", r[4] or "nan", *r[5:]) for r in rows])
    for slice_rows in (10_000, 25, 7):
        folded = rt.elo_ratings(prepared, slice_rows=slice_rows)
        got = {r.match_id: (r.elo_a, r.elo_b) for r in folded.collect()}
        assert got.keys() == want.keys()
        assert all(abs(got[k][0] - want[k][0]) < 1e-9 and abs(got[k][1] - want[k][1]) < 1e-9 for k in want)
        last = {r.team: r.elo_rating for r in rt.final_ratings(rt.elo_history(prepared, folded)).collect()}
        assert last.keys() == final.keys() and all(abs(last[t] - final[t]) < 1e-9 for t in final)


def test_rounds_follow_the_largest_group(spark, monkeypatch):
    """Ten groups of equal size: as many slices as one group needs, not as the history would; components are found once."""
    rows, df = _matches(spark, n_matches=400, n_teams=4, pools=10, seed=2)
    prepared = rt.prepare_matches(df)
    want, _ = _serial(rows)
    found, states = [], []
    components, materialize = rt.components, rt.materialize
    monkeypatch.setattr(rt, "components", lambda e: found.append(1) or components(e))
    monkeypatch.setattr(rt, "materialize", lambda d, name: states.append(name) or materialize(d, name))
    for pool in ("pool", None):
        found.clear(), states.clear()
        got = {r.match_id: (r.elo_a, r.elo_b) for r in rt.elo_ratings(prepared, pool=pool, slice_rows=30).collect()}
        assert got.keys() == want.keys() and all(abs(got[k][0] - want[k][0]) < 1e-9 for k in want)
        assert len(found) == (0 if pool else 1) and 2 <= states.count("elo-done") <= 4


def test_components_by_hand(spark):
    from pitchspark.operators.graph import components
    edges = [("d", "e"), ("b", "a"), ("c", "b"), ("z", "z")] + [(f"n{i:03}", f"n{i + 1:03}") for i in range(70)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert {k: v for k, v in got.items() if k < "n"} == {"a": "a", "b": "a", "c": "a", "d": "d", "e": "d"} and got["z"] == "z"
    assert {v for k, v in got.items() if k.startswith("n")} == {"n000"}


def test_missing_scores_are_no_results(spark):
    m = spark.createDataFrame([(1, "a", "b", 1, 0), (2, "a", "b", None, 0), (3, "a", "b", 2, None)],
                              "match_id int, team_a string, team_b string, home_score int, away_score int")
    got = [r.o for r in m.select(E.outcome_label("home_score", "away_score").alias("o")).collect()]
    assert got == [2, None, None]
    full = m.withColumn("date", F.to_timestamp(F.concat(F.lit("2020-01-0"), "match_id"))).withColumn("neutral", F.lit(False))
    tm = pr.training_matrix(full, spark.createDataFrame([("a", 1.0), ("b", 2.0)], "team string, f double"), "team", ["f"]).collect()
    assert [(r.match_id, r.days_ago) for r in tm] == [(1, 0)]  # the decay counts from the rows that remain
    from pitchspark.operators.standings import points_table
    assert {r.team: r.played for r in points_table(m.withColumn("outcome", E.outcome_label("home_score", "away_score")), []).collect()} == {"a": 1, "b": 1}

def test_leaderboard(spark):
    rows, df = _matches(spark, n_matches=100)
    prepared = rt.prepare_matches(df)
    hist = rt.elo_history(prepared, rt.elo_ratings(prepared, pool="pool"))
    final = {r.team: r.elo_rating for r in rt.final_ratings(hist).collect()}
    _, want = _serial(rows)
    for t, v in want.items():
        assert abs(final[t] - v) < 1e-9
    head = rt.leaderboard_head(rt.active_leaderboard(rt.final_ratings(hist), "2000-01-01"), 5).collect()
    assert len(head) == 5 and head[0].elo_rating == max(want.values())


def test_the_first_of_matches_of_one_id_gives_the_final_rating(spark):
    import datetime as dt
    day = dt.datetime(2020, 1, 1)
    rows = [(1, "p", day, "A", "B", 2, 0, "Friendly", True)] * 2 + [(2, "p", day + dt.timedelta(1), "C", "B", 1, 1, "Friendly", True)]
    df = spark.createDataFrame(rows, "match_id long, pool string, date timestamp, team_a string, team_b string, home_score int, away_score int, tournament string, neutral boolean")
    prepared = rt.prepare_matches(df)
    for side in (prepared, prepared.hint("merge"), prepared.hint("broadcast")):  # however the join runs
        folded = rt.elo_ratings(prepared, pool="pool")
        first = folded.where("match_id = 1").orderBy("_nth").first()
        assert folded.where("match_id = 1").orderBy(F.desc("_nth")).first().post_a > first.post_a
        final = {r.team: r.elo_rating for r in rt.final_ratings(rt.elo_history(side, folded)).collect()}
        assert final["A"] == first.post_a

"""Splits, metrics, registry, and standings."""

from pyspark.sql import functions as F

from pitchspark.operators import evaluate as ev
from pitchspark.operators import standings as st


def test_split_sizes_and_folds(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 3).cast("int").alias("label"))
    out = ev.stratified_split(df, "label", "id")
    for r in out.groupBy("label").agg(F.count_if("is_test").alias("t"), F.count("*").alias("n")).collect():
        assert r.t == round(0.2 * r.n)
    folds = out.where(~F.col("is_test")).groupBy("fold").count().collect()
    assert sorted(r.fold for r in folds) == [0, 1, 2, 3, 4]
    again = ev.stratified_split(df.repartition(7), "label", "id")
    a = {r.id: r.is_test for r in out.collect()}
    b = {r.id: r.is_test for r in again.collect()}
    assert a == b


def test_metrics_by_hand(spark):
    rows = [(0, 0), (0, 1), (1, 1), (1, 1), (2, 0), (2, 2)]
    df = spark.createDataFrame(rows, "label int, prediction int")
    assert ev.accuracy(df).first().accuracy == 4 / 6
    rep = {r["class"]: r for r in ev.class_report(df).collect()}
    assert rep["0"].precision == 0.5 and rep["0"].recall == 0.5
    assert rep["1"].precision == 2 / 3 and rep["1"].recall == 1.0
    assert rep["2"].precision == 1.0 and rep["2"].recall == 0.5
    cm = {r.label: (r.pred_0, r.pred_1, r.pred_2) for r in ev.confusion_matrix(df).collect()}
    assert cm == {0: (1, 1, 0), 1: (0, 2, 0), 2: (1, 0, 1)}


def test_run_leaderboard_failures_last(spark):
    reg = spark.createDataFrame([("a", 0.5, None), ("b", None, "x" * 80), ("c", 0.7, None)],
                                "run_name string, accuracy double, error string")
    rows = ev.run_leaderboard(reg).orderBy("position").collect()
    assert [r.run_name for r in rows] == ["c", "a", "b"]
    assert rows[2].accuracy_pct == "N/A" and len(rows[2].status) == 60


def test_a_long_board_is_placed_by_parts(spark, monkeypatch):
    reg = spark.createDataFrame([(f"r{i:03}", None if i % 9 == 0 else (i % 40) / 40, "e") for i in range(300)], "run_name string, accuracy double, error string")
    board = lambda: [tuple(r) for r in ev.run_leaderboard(reg).orderBy("position").collect()]
    short = board()
    monkeypatch.setattr(ev, "BOARD_ROWS", 10)
    assert board() == short and [r[-1] for r in short] == list(range(1, 301))
    assert ev.run_leaderboard(reg.limit(0)).isEmpty()


def test_dropped_rows_are_counted_by_the_job(spark):
    df = spark.createDataFrame([(1, "x"), (None, "x"), (None, None), (3, None), (5, "y")], "a int, b string")
    kept, first = ev.drop_counted(df, "first", {"no a": F.col("a").isNull(), "no b": F.col("b").isNull(), "odd": F.col("a") > 100})
    kept, second = ev.drop_counted(kept, "second", {"y": F.col("b") == "y"})
    assert [tuple(r) for r in kept.collect()] == [(1, "x")]
    got = [tuple(r) for r in ev.flow_report(spark, {"first": first, "second": second}).collect()]
    assert sorted(got) == sorted([("first", "read", 5), ("first", "no a", 2), ("first", "no b", 1), ("first", "odd", 0), ("first", "kept", 2),
                                  ("second", "read", 2), ("second", "y", 1), ("second", "kept", 1)])


def test_classes_come_from_the_data(spark):
    df = spark.createDataFrame([(0, 0), (3, 0), (None, 1), (1, None), (1, 5)], "label int, prediction int")
    a = ev.accuracy(df).first()
    assert (a.accuracy, a.rows) == (0.25, 4)
    rep = {r["class"]: r for r in ev.class_report(df).collect()}
    assert {"0", "1", "3", "5"} <= set(rep) and rep["3"].support == 1 and rep["macro avg"].support == 4
    cm = {r.label: (r.pred_0, r.pred_1, r.pred_2, r.pred_other) for r in ev.confusion_matrix(df).collect()}
    assert cm[3] == (1, 0, 0, 0) and cm[None] == (0, 1, 0, 0) and cm[1] == (0, 0, 0, 2) and cm[2] == (0, 0, 0, 0)


def test_position_counts(spark):
    ranked = spark.createDataFrame([(2000, "g", "A", 1), (2001, "g", "A", 2), (2000, "g", "B", 4)], "year int, grp string, team string, position int")
    got = {r.team: (r.tables, r.times_1, r.times_2, r.times_3) for r in st.position_counts(ranked, ["grp"]).collect()}
    assert got == {"A": (2, 1, 1, 0), "B": (1, 0, 0, 0)}


def test_points_positions_wildcards(spark):
    res = spark.createDataFrame([("g1", "A", "B", 2), ("g1", "A", "C", 1), ("g1", "B", "C", 0),
                                 ("g2", "D", "E", 1), ("g2", "D", "F", 0), ("g2", "E", "F", 2)],
                                "grp string, team_a string, team_b string, outcome int")
    table = st.points_table(res, ["grp"])
    pts = {r.team: r.points for r in table.collect()}
    # g1: A beats B, A-C draw, C beats B; g2: D-E draw, F beats D, E beats F
    assert pts == {"A": 4, "B": 0, "C": 4, "D": 1, "E": 4, "F": 3}
    ranked = st.rank_in_group(table, ["grp"], [F.col("points").desc(), F.col("team").asc()])
    pos = {r.team: r.position for r in ranked.collect()}
    assert pos == {"A": 1, "C": 2, "B": 3, "E": 1, "F": 2, "D": 3}
    wc = st.wild_cards(ranked, [], [F.col("points").desc(), F.col("team").asc()], place=3, k=1).collect()
    assert [r.team for r in wc] == ["D"]

"""Scans and sinks round trips (S1-S8) and model behaviour (M1-M5)."""

import os
import tempfile

from pyspark.sql import functions as F

from pitchspark.operators import learn as ml
from pitchspark.sources import files


def _scratch(spark):
    from pitchspark.session import ensure_checkpoint_dir
    base = ensure_checkpoint_dir(spark)
    return tempfile.mkdtemp(prefix="io-", dir=base.replace("file:", ""))


def test_read_keyed_round_trip(spark):
    d = _scratch(spark)
    for country, rows in {"south_korea": "Kim,Club A,€1.5m\nLee,,€500k\n", "brazil": "Ana,Club B,-\n"}.items():
        with open(os.path.join(d, f"{country}_cleaned.csv"), "w") as fh:
            fh.write("Name,Club,Market_Value\n" + rows)
    df = files.read_keyed(spark, d, "Name string, Club string, Market_Value string", "country", "_cleaned.csv")
    got = sorted((r.country, r.Name) for r in df.collect())
    assert got == [("Brazil", "Ana"), ("South korea", "Kim"), ("South korea", "Lee")]


def test_read_reconciled_and_quarantine(spark):
    d = _scratch(spark)
    files_ = {"a.csv": "player,rating\nx,7.5\ny,bad\n", "b.csv": "name,averageRating,rating\nz,6.0,9.9\n",
              "c.csv": "player,goals\nq,3\n", "d.csv": "name,Minutes Played\nm,90\n",
              # the same two columns at other places, quoted fields, a row that is too long
              "e.csv": "id,player,rating\n1,v,1.5\n2,\"w, jr\",2.5\n3,u,1,2,3\n", "f.csv": "rating,player\r\n4.5,t\r\n"}
    for n, body in files_.items():
        with open(os.path.join(d, n), "w", newline="") as fh:
            fh.write(body)
    rec = files.read_reconciled(spark, d, "rating")
    rows = sorted((r.player, r.rating) for r in rec.data.collect())
    assert rows == [("t", "4.5"), ("v", "1.5"), ("w, jr", "2.5"), ("x", "7.5"), ("y", "bad"), ("z", "9.9")]
    assert sorted(r.source_file for r in rec.skipped.collect()) == ["c.csv", "d.csv"]
    assert [(r.source_file, r.line) for r in rec.corrupt.collect()] == [("e.csv", "3,u,1,2,3")]
    good, bad = files.split_quarantine(rec.data, F.col("rating").try_cast("double").isNotNull())
    assert good.count() == 5 and [r.player for r in bad.collect()] == ["y"]
    mins = files.read_reconciled(spark, d, "minutes")
    assert [(r.player, r.minutes) for r in mins.data.collect()] == [("m", "90")]


def test_a_thousand_layouts_are_one_scan(spark):
    d = _scratch(spark)
    for i in range(1000):  # each file has columns of its own, name and value at different places
        columns = [f"c{i}_{j}" for j in range(i % 7)]
        columns.insert(i % (len(columns) + 1), "name")
        columns.insert(i % (len(columns) + 1), "averageRating")
        values = {"name": f'"p, ""{i}"""', "averageRating": str(i)}
        with open(os.path.join(d, f"f{i}.csv"), "w") as fh:
            fh.write(",".join(columns) + "\n" + ",".join(values.get(c, "x") for c in columns) + "\n")
    rec = files.read_reconciled(spark, d, "rating")
    plan = rec.data._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") <= 2 and "Union" not in plan  # lines and heads, whatever the layouts
    assert sorted((r.player, int(r.rating)) for r in rec.data.collect()) == sorted((f'p, "{i}"', i) for i in range(1000))
    assert rec.skipped.isEmpty() and rec.corrupt.isEmpty() and rec.unreadable.isEmpty()


def test_unlisted_files_are_dropped_at_listing(spark):
    from pitchspark.operators import features as feat
    d = _scratch(spark)
    for n in ("england_premier_league_25_26", "usa_mls_2025", "tm_usa_mls_2025", "unlisted_league"):
        with open(os.path.join(d, f"{n}.csv"), "w") as fh:
            fh.write("player,goals\nx,1\n" if n == "usa_mls_2025" else f"player,rating\n{n[:3]},7.5\n")
    rec = files.read_reconciled(spark, d, "rating", only=feat.listed_league)
    assert [(r.source_file, r.player) for r in rec.data.collect()] == [("england_premier_league_25_26.csv", "eng")]
    assert [r.source_file for r in rec.skipped.collect()] == ["usa_mls_2025.csv"] and rec.unreadable.isEmpty()
    lines = spark.read.text(d).where(feat.listed_league(files.file_label())).select("value")
    lines.collect()
    scan = next(x for x in _leaves(lines) if "Scan text" in x.nodeName())
    assert scan.metrics().apply("numFiles").value() == 2


def _leaves(df):
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    return [leaves.apply(i) for i in range(leaves.size())]


def test_broken_archive_does_not_stop_the_job(spark):
    import gzip
    d = _scratch(spark)
    for n in ("a", "b"):
        with gzip.open(os.path.join(d, f"{n}.csv.gz"), "wt") as fh:
            fh.write(f"player,rating\n{n},1.5\n")
    with open(os.path.join(d, "broken.csv.gz"), "wb") as fh:
        fh.write(b"\x1f\x8b\x08\x00 this is no archive")
    with open(os.path.join(d, "empty.csv"), "w"):
        pass
    rec = files.read_reconciled(spark, d, "rating")
    assert sorted((r.player, r.rating) for r in rec.data.collect()) == [("a", "1.5"), ("b", "1.5")]
    assert [(r.source_file, r.reason) for r in rec.unreadable.collect()] == [("broken.csv.gz", "no line could be read")]


def test_partitioned_sink_round_trip(spark):
    d = _scratch(spark)
    df = spark.createDataFrame([("A", 1), ("B", 2), ("A", 3)], "country string, v int")
    files.write_partitioned(df, d + "/t", "country")
    back = spark.read.parquet(d + "/t").where(F.col("country") == "A")
    assert sorted(r.v for r in back.collect()) == [1, 3]
    assert "PartitionFilters: [isnotnull(country" in back._jdf.queryExecution().executedPlan().toString()


def test_model_probabilities_and_registry(spark):
    n = 600
    df = spark.range(n).select(
        F.col("id").alias("match_id"),
        ((F.col("id") % 3)).cast("int").alias("target"),
        ((F.col("id") % 3) * 2.0 + (F.col("id") % 7) / 10.0).alias("x1"),
        (F.col("id") % 5).cast("double").alias("x2"),
        F.lit(1.0).alias("match_weight"))
    model, preds = ml.train_and_split(df, ["x1", "x2"], model="gbt", params={"maxIter": 5})
    rows = preds.select("target", "prediction", "p").collect()
    assert all(abs(sum(r.p) - 1.0) < 1e-9 for r in rows)
    acc = sum(r.target == r.prediction for r in rows) / len(rows)
    assert acc > 0.9          # separable fixture beats the majority class (1/3)
    _, preds2 = ml.train_and_split(df, ["x1", "x2"], model="gbt", params={"maxIter": 5})
    assert [r.prediction for r in preds2.orderBy("match_id").collect()] == \
           [r.prediction for r in preds.orderBy("match_id").collect()]
    imp = ml.feature_importance(model, ["x1", "x2"]).collect()
    assert imp[0].feature == "x1"
    d = _scratch(spark)
    ml.save_run(model, d + "/m1", d + "/registry", "m1", acc, ["x1", "x2"], n, {"maxIter": 5})
    loaded, feats = ml.load_run(spark, d + "/registry", "m1")
    assert feats == ["x1", "x2"]
    again = ml.score(loaded, df.limit(20), feats).collect()
    assert len(again) == 20
    rep = ml.inspect_run(spark, d + "/registry", "m1", df)
    assert rep["accuracy"].first().accuracy == acc
    assert rep["report"].count() == 5 and rep["importance"].first().feature == "x1"


def test_write_table_and_observed_rows(spark):
    from pitchspark.operators.evaluate import observed_rows
    d = _scratch(spark)
    df = spark.range(10).select(F.col("id"), (F.col("id") % 2).alias("k"))
    files.write_table(df, d + "/csv", fmt="csv")
    back = files.read_table(spark, d + "/csv", "id long, k long", fmt="csv")
    assert sorted(r.id for r in back.collect()) == list(range(10))
    counted, obs = observed_rows(back.where("k = 1"), "odd")
    assert counted.count() == 5 and obs.get["rows"] == 5


def test_first_per_key_and_unmatched(spark):
    from pitchspark.operators import pairs as pr
    dim = spark.createDataFrame([("a", 2, 1.0), ("a", 1, 2.0), ("b", 1, 3.0)], "k string, o int, v double")
    assert sorted((r.k, r.v) for r in pr.first_per_key(dim, "k", "o").collect()) == [("a", 2.0), ("b", 3.0)]
    ents = spark.createDataFrame([("a",), ("c",)], "team string")
    assert [r.team for r in pr.unmatched_entities(ents, "team", dim, "k").collect()] == ["c"]


def test_grid_search_on_stratified_folds(spark):
    from pitchspark.operators.evaluate import stratified_split
    df = spark.range(300).select(
        F.col("id").alias("match_id"), (F.col("id") % 3).cast("int").alias("target"),
        ((F.col("id") % 3) * 2.0 + (F.col("id") % 7) / 10.0).alias("x1"), F.lit(1.0).alias("match_weight"))
    split = ml.training_weights(stratified_split(df, "target", "match_id"))
    best = ml.tune(split.where(~F.col("is_test")), ["x1"], {"maxIter": [2, 3]}, folds=5, parallelism=2)
    preds = ml.score(best, split.where(F.col("is_test")), ["x1"])
    assert preds.count() == 60


def test_file_label_is_made_once_a_file(spark):
    d = _scratch(spark)
    keys = ["usa mls+2025.csv", "a=b 50%.csv", "\u00e9t\u00e9.csv", "plain.csv"]
    rows = spark.createDataFrame([(k, f"{k[0]}{i}", str(i)) for k in keys for i in range(3)], "file string, player string, rating string")
    files.write_partitioned(rows, f"{d}/t", "file", "csv")
    rec = files.read_reconciled(spark, f"{d}/t", "rating", folder=True)
    pattern = F.regexp_extract(F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B"))), r"([^/=]+)/[^/]+$", 1)  # as a pattern would find it
    expected = {r[0] for r in spark.read.option("recursiveFileLookup", True).text(f"{d}/t").select(pattern).distinct().collect()}
    got = rec.data.collect()
    assert {r.source_file for r in got} == expected and len(got) == 12 and "usa mls+2025.csv" in expected
    plan = rec.data._jdf.queryExecution().optimizedPlan().toString()
    # The label is cut from the path above the aggregate of one row a file, never for the lines; nothing searches by pattern.
    assert "regexp_extract(" not in plan
    lines, heads = plan[: plan.index("Aggregate")], plan[plan.index("Aggregate") :]
    assert lines.count("substring_index") > 0 and "substring_index" not in heads
    assert "file_path" in heads and "Generate" in lines


def test_model_rows_and_matches_are_written_once(spark):
    from pitchspark.plans import catalog
    small = "/root/testdata/sf0.001"
    rows = catalog._model_rows(spark, small)
    assert "FlatMapGroupsInPandas" not in rows._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(rows.columns) == sorted(["match_id", "target", *catalog.MODEL_FEATURES, "match_weight"])
    for query in (catalog.standings_by_rating, catalog.elo_history):
        assert not [f for f in query(spark, small).inputFiles() if f.endswith("orders.parquet")]


def test_positions_are_numbered_without_a_second_shuffle(spark):
    from pitchspark.operators.numbering import running_total
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), "id")
    out = running_total(df, [F.col("k"), F.col("id")], "p")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window") == 1  # over the parts' totals only
    expected = {r: i for i, r in enumerate(sorted((i % 7, i) for i in range(1000)), 1)}
    assert {(r.k, r.id): r.p for r in out.collect()} == expected

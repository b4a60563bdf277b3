"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the whole driver tables through the fixtures of
FIXTURES.md. Floating outputs are rounded at the last step only (6
decimals) so that Spark and DuckDB print the same numbers.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitchspark.operators import evaluate as ev
from pitchspark.operators import features as feat
from pitchspark.operators import pairs as pr
from pitchspark.operators import ratings as rt
from pitchspark.operators import similarity as sim
from pitchspark.operators import standings as st
from pitchspark.session import materialize, shared_path
from pitchspark.sources.fixtures import fixture

QueryFn = Callable[[SparkSession, str], DataFrame]
DECIMALS = 6


def _r(col: str, name: str | None = None):
    return F.round(F.col(col).cast("double"), DECIMALS).alias(name or col)


def squad_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    roster = feat.clean_roster(fixture(spark, sf_dir, "fx_roster"))
    out = feat.squad_value(roster, "country", "market_value_m", n=15)
    return out.select("country", _r("top_value_sum"), _r("log_squad_value"))


def chemistry(spark: SparkSession, sf_dir: str) -> DataFrame:
    roster = feat.clean_roster(fixture(spark, sf_dir, "fx_roster"))
    out = feat.group_cohesion(roster, "country", "club", "market_value_m")
    return out.select("country", _r("chemistry_score"))


def form_rating(spark: SparkSession, sf_dir: str) -> DataFrame:
    roster = fixture(spark, sf_dir, "fx_roster")
    uni = feat.league_universe(fixture(spark, sf_dir, "fx_league_ratings"), feat.league_weights_df(spark))
    out = feat.form_rating(roster, uni, "country", "name", n=15)
    return out.select("country", _r("current_form_rating"), _r("top5_league_density"))


def average_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    ent = fixture(spark, sf_dir, "fx_entity")
    out = feat.average_rank_desc(ent.select("entity_id", "f_cnt"), "f_cnt", "avg_rank")
    return out.select("entity_id", "f_cnt", _r("avg_rank"))


ENTITY_FEATURES = ["f_cnt", "f_value", "f_max"]


def pair_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    ent = fixture(spark, sf_dir, "fx_entity")
    out = pr.pair_matrix(ent, "entity_id", "entity_id", ENTITY_FEATURES, block="nation", label="country")
    return out.select("nation", "team_a", "team_b", *[_r(f"delta_{f}") for f in ENTITY_FEATURES])


def training_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    matches = fixture(spark, sf_dir, "fx_matches")
    team = fixture(spark, sf_dir, "fx_team")
    out = pr.training_matrix(matches, team, "team", ENTITY_FEATURES)
    return out.select("match_id", "team_a", "team_b", "home_score", "away_score", "target",
                      *[_r(f"delta_{f}") for f in ENTITY_FEATURES], "is_neutral", "days_ago", _r("match_weight"))


def _matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The matches, written once for queries that read them several times."""
    return materialize(fixture(spark, sf_dir, "fx_matches"), "matches")


def _elo(spark: SparkSession, sf_dir: str, pool: str | None = "pool", matches: DataFrame | None = None):
    """Match history with ratings; the teams of different pools never meet."""
    prepared = rt.prepare_matches(_matches(spark, sf_dir) if matches is None else matches)
    return rt.elo_history(prepared, rt.elo_ratings(prepared, pool=pool, slice_rows=POOL_SLICE_ROWS if pool else ELO_SLICE_ROWS))


ELO_SLICE_ROWS = 50_000
POOL_SLICE_ROWS = 1_000_000


def elo_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = _elo(spark, sf_dir)
    return h.select("match_id", "pool", "team_a", "team_b", _r("elo_a"), _r("elo_b"), _r("delta_elo"))


def elo_history_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same history folded as one global pool, in slices of its order."""
    h = _elo(spark, sf_dir, pool=None)
    return h.select("match_id", "pool", "team_a", "team_b", _r("elo_a"), _r("elo_b"), _r("delta_elo"))


ELO_CUTOFF = "1998-01-01"


def elo_leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    board = rt.active_leaderboard(rt.final_ratings(_elo(spark, sf_dir)), ELO_CUTOFF)
    return board.select("team", _r("elo_rating"))


def elo_top15(spark: SparkSession, sf_dir: str) -> DataFrame:
    board = rt.active_leaderboard(rt.final_ratings(_elo(spark, sf_dir)), ELO_CUTOFF)
    return rt.leaderboard_head(board, 15).select("team", _r("elo_rating"))


def _match_outcomes(spark: SparkSession, sf_dir: str, matches: DataFrame | None = None) -> DataFrame:
    m = fixture(spark, sf_dir, "fx_matches") if matches is None else matches
    from pitchspark.functions.elo import outcome_label
    return m.withColumn("outcome", outcome_label("home_score", "away_score"))


def standings(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = st.points_table(_match_outcomes(spark, sf_dir), ["pool"])
    ranked = st.rank_in_group(table, ["pool"], [F.col("points").desc(), F.col("team").asc()])
    return ranked.select("pool", "team", "played", "wins", "draws", "losses", "points", "position")


def wild_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = st.points_table(_match_outcomes(spark, sf_dir), ["pool"])
    ranked = st.rank_in_group(table, ["pool"], [F.col("points").desc(), F.col("team").asc()])
    out = st.wild_cards(ranked, [], [F.col("points").desc(), F.col("team").asc()], place=3, k=8)
    return out.select("pool", "team", "points", "wildcard_rank")


def standings_by_rating(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions with ties broken by the final rating."""
    matches = _matches(spark, sf_dir)
    ratings = rt.final_ratings(_elo(spark, sf_dir, matches=matches)).select("team", _r("elo_rating"))
    table = st.points_table(_match_outcomes(spark, sf_dir, matches), ["pool"]).join(ratings, "team")
    ranked = st.rank_in_group(table, ["pool"], [F.col("points").desc(), F.col("elo_rating").desc(), F.col("team").asc()])
    return ranked.select("pool", "team", "points", "elo_rating", "position")


def position_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each team came first, second and third over its pool's yearly tables."""
    played = _match_outcomes(spark, sf_dir).where("date is not null").withColumn("year", F.year("date"))
    table = st.points_table(played, ["year", "pool"])
    ranked = st.rank_in_group(table, ["year", "pool"], [F.col("points").desc(), F.col("team").asc()])
    return st.position_counts(ranked, ["pool"])


def advancement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First to fourth places and qualifications over the yearly tables: two of each pool and the eight best thirds of the year."""
    played = _match_outcomes(spark, sf_dir).where("date is not null").withColumn("year", F.year("date"))
    by_points = [F.col("points").desc(), F.col("team").asc()]
    ranked = st.rank_in_group(st.points_table(played, ["year", "pool"]), ["year", "pool"], by_points)
    return st.advancement(ranked, ["year"], ["pool"], by_points)


def stage_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = fixture(spark, sf_dir, "fx_stage_log")
    out = st.stage_rates(log, "run_id", "entity", "stage")
    return out.select("entity", "stage", "runs", _r("pct"))


def accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ev.accuracy(fixture(spark, sf_dir, "fx_predictions"))
    return out.select(_r("accuracy"), "rows")


def class_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ev.class_report(fixture(spark, sf_dir, "fx_predictions"))
    return out.select("class", _r("precision"), _r("recall"), _r("f1"), "support")


def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.confusion_matrix(fixture(spark, sf_dir, "fx_predictions"))


def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ev.stratified_split(fixture(spark, sf_dir, "fx_predictions"), "label", "row_id")
    return out.select("row_id", "label", "is_test", "fold")


def run_leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ev.run_leaderboard(fixture(spark, sf_dir, "fx_runs"))
    return out.select("run_name", _r("score"), "accuracy_pct", "status", "position")


def pair_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ent = fixture(spark, sf_dir, "fx_entity")
    # Requests: each entity against the next one, asked in reverse order
    # for odd ids, in upper case to exercise the case-insensitive match.
    nxt = ent.select(F.col("entity_id").alias("e1"), "country")
    req = (nxt.alias("x").join(nxt.alias("y"), F.col("y.e1") == F.col("x.e1") + 1)
              .select(F.when(F.col("x.e1") % 2 == 1, F.upper(F.col("y.country"))).otherwise(F.col("x.country")).alias("req_a"),
                      F.when(F.col("x.e1") % 2 == 1, F.col("x.country")).otherwise(F.col("y.country")).alias("req_b")))
    out = pr.pair_lookup(ent, "entity_id", "country", req, ENTITY_FEATURES)
    return out.select("req_a", "req_b", "reversed", *[_r(f"delta_{f}") for f in ENTITY_FEATURES])


OUTCOME_NAMES = ["Away Win", "Draw", "Home Win"]


def probs_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = fixture(spark, sf_dir, "fx_probs")
    arr = F.array("p0", "p1", "p2")
    return p.select("pair_id", pr.argmax_label(arr).alias("label_idx"),
                    pr.argmax_label(arr, OUTCOME_NAMES).alias("label_name"),
                    F.round(pr.two_way(F.col("p0"), F.col("p2")), DECIMALS).alias("p_two_way"))


def _minutes(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Minutes per normalised name (S3 output shape, P6, A1)."""
    from pitchspark.functions.money import numeric_or_zero
    from pitchspark.functions.text import join_key
    return feat.sum_by_key(fixture(spark, sf_dir, name), join_key("player"), numeric_or_zero("minutes"), "match_name", "minutes")


def _fuzzy(names: DataFrame, minutes: DataFrame) -> DataFrame:
    """``names`` (with ``name``) and the best match of each: best_key, score, value."""
    from pitchspark.functions.text import join_key
    keyed = names.withColumn("match_name", join_key("name"))
    return keyed.join(sim.fuzzy_best_match(keyed, minutes, "match_name", "match_name", "minutes", 85), "match_name", "left")


def fuzzy_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _fuzzy(fixture(spark, sf_dir, "fx_fuzzy_queries"), _minutes(spark, sf_dir, "fx_appearances"))
    return out.select("query_id", "best_key", "score", F.round("value", DECIMALS).alias("minutes"))


def _experience(names: DataFrame, minutes: DataFrame, out: str) -> DataFrame:
    """Mean of the 15 largest matched minutes per entity."""
    return feat.top_n_mean(_fuzzy(names, minutes).select("country", F.col("value").alias("minutes")), "country", "minutes", 15, out)


def experience(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _experience(fixture(spark, sf_dir, "fx_fuzzy_queries"), _minutes(spark, sf_dir, "fx_appearances"), "experience_minutes")
    return out.select("country", _r("experience_minutes"))


def tournament_experience(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _experience(fixture(spark, sf_dir, "fx_roster"), _minutes(spark, sf_dir, "fx_tournaments"), "tournament_minutes")
    return out.select("country", _r("tournament_minutes"))


MASTER_COLUMNS = ["country", "total_market_value", "median_top11_value", "chemistry_score",
                  "current_form_rating", "top5_league_density", "ucl_minutes", "tournament_minutes", "log_squad_value",
                  "fifa_rank", "fifa_points", "elo_rating", "tm_value_rank"]
PAIR_FEATURES = ["total_market_value", "median_top11_value", "chemistry_score", "current_form_rating", "ucl_minutes", "tournament_minutes",
                 "tm_value_rank", "fifa_rank", "fifa_points", "top5_league_density"]


def _country_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared = rt.prepare_matches(fixture(spark, sf_dir, "fx_country_matches"))
    return rt.elo_history(prepared, rt.elo_ratings(prepared, slice_rows=ELO_SLICE_ROWS))


def _master(spark: SparkSession, sf_dir: str, history: DataFrame | None = None) -> DataFrame:
    roster = feat.clean_roster(fixture(spark, sf_dir, "fx_roster"))
    uni = feat.league_universe(fixture(spark, sf_dir, "fx_league_ratings"), feat.league_weights_df(spark))
    feats = [feat.group_cohesion(roster), feat.form_rating(roster, uni),
             _experience(roster, _minutes(spark, sf_dir, "fx_appearances"), "ucl_minutes"),
             _experience(roster, _minutes(spark, sf_dir, "fx_tournaments"), "tournament_minutes"),
             feat.squad_value(roster).select("country", "log_squad_value")]
    history = _country_history(spark, sf_dir) if history is None else history
    elo = rt.final_ratings(history, entity="country")
    return feat.build_master(feat.squad_base(roster), feats, fixture(spark, sf_dir, "fx_rankings"), elo, dedupe=True)


def master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _master(spark, sf_dir).select("country", *[_r(c) for c in MASTER_COLUMNS[1:]])


def master_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of the master's countries with the ten deltas and that of the ratings."""
    m = materialize(_master(spark, sf_dir), "master")
    out = pr.pair_matrix(m, "country", "country", [*PAIR_FEATURES, "elo_rating"])
    return out.select("team_a", "team_b", *[_r(f"delta_{f}") for f in [*PAIR_FEATURES, "elo_rating"]])


def master_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Played country matches with the master's ten deltas and the pre-match rating delta, joined on cleaned names."""
    history = materialize(_country_history(spark, sf_dir), "country-history")
    m = materialize(_master(spark, sf_dir, history), "master")
    # prepare_matches has stripped and title-cased the teams, build_master the countries.
    out = pr.training_matrix(history, m, "country", PAIR_FEATURES).join(history.select("match_id", "delta_elo"), "match_id")
    return out.select("match_id", "team_a", "team_b", "target", *[_r(f"delta_{f}") for f in PAIR_FEATURES], _r("delta_elo"),
                      "is_neutral", "days_ago", _r("match_weight"))


def training_with_elo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training matrix with the pre-match ratings attached."""
    matches = _matches(spark, sf_dir)
    tm = pr.training_matrix(matches, fixture(spark, sf_dir, "fx_team"), "team", ENTITY_FEATURES)
    hist = _elo(spark, sf_dir, matches=matches).select("match_id", "elo_a", "elo_b", "delta_elo")
    out = tm.join(hist, "match_id")
    return out.select("match_id", "target", *[_r(f"delta_{f}") for f in ENTITY_FEATURES], "is_neutral",
                      _r("match_weight"), _r("elo_a"), _r("elo_b"), _r("delta_elo"))


def group_pair_probs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs inside each group, host orientation and re-oriented probabilities.

    Groups are four consecutive customers (fx_team_groups). The stand-in
    probability row of a pair is the row keyed by its second team.
    """
    groups = fixture(spark, sf_dir, "fx_team_groups")
    pairs = pr.pair_matrix(groups, "team", "slot", ["slot"], block="grp", label="team")
    keys = groups.select(F.col("team").alias("team_b"), F.col("team_key").alias("key_b"))
    pairs = pairs.join(keys, "team_b")
    oriented = pr.orient_by_host(pairs, groups.where("is_host").select("team"))
    probs = fixture(spark, sf_dir, "fx_probs")
    j = oriented.join(probs, F.col("pair_id") == F.col("key_b"))
    p = pr.reorient_probs(F.array("p0", "p1", "p2"), F.col("reversed"))
    return j.select("grp", "team_a", "team_b", "reversed", "is_neutral",
                    p[0].alias("p0"), p[1].alias("p1"), p[2].alias("p2"))


def group_probabilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = group_pair_probs(spark, sf_dir)
    return out.select("grp", "team_a", "team_b", "reversed", "is_neutral", _r("p0"), _r("p1"), _r("p2"))


MODEL_FEATURES = [f"delta_{f}" for f in ENTITY_FEATURES] + ["delta_elo", "is_neutral"]


def _model_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training rows with what the models read, written once: a split reads them twice, and each reading would fold the ratings again."""
    matches = _matches(spark, sf_dir)
    tm = pr.training_matrix(matches, fixture(spark, sf_dir, "fx_team"), "team", ENTITY_FEATURES)
    rows = tm.join(_elo(spark, sf_dir, matches=matches).select("match_id", "delta_elo"), "match_id")
    return materialize(rows.select("match_id", "target", *MODEL_FEATURES, "match_weight"), "model-rows")


def _metrics(*named) -> list:
    return [F.struct(F.lit(n).alias("metric"), F.round(v.cast("double"), DECIMALS).alias("value")) for n, v in named]


def _prediction_checks(preds: DataFrame, split: DataFrame) -> DataFrame:
    """metric, value: what any correct fit must give exactly (a fit itself has no SQL)."""
    off = F.abs(F.aggregate("p", F.lit(0.0), lambda a, x: a + x) - 1) > 1e-9
    of_preds = preds.agg(*[F.count_if(F.col("target") == c).alias(f"n{c}") for c in range(3)],
                         F.count_if(off | F.exists("p", lambda x: (x < 0) | (x > 1))).alias("off"),
                         F.count_if(~F.coalesce(F.col("prediction").isin(0, 1, 2), F.lit(False))).alias("outside"))
    of_preds = of_preds.select(F.explode(F.array(*_metrics(*[(f"support_{c}", F.col(f"n{c}")) for c in range(3)],
                                                           ("probability_off", F.col("off")), ("outside_classes", F.col("outside"))))).alias("m"))
    of_split = split.agg(F.count_if(~F.col("is_test")).alias("train"), F.sum(F.when(~F.col("is_test"), F.col("train_weight"))).alias("weight"))
    of_split = of_split.select(F.explode(F.array(*_metrics(("train_rows", F.col("train")), ("train_weight", F.col("weight"))))).alias("m"))
    return of_preds.unionByName(of_split).select("m.*")


def _accuracy_checks(preds: DataFrame, split: DataFrame) -> DataFrame:
    """Whether the model is right on test rows at least as often as the commonest class would be (less one row in a
    hundred), and whether its weighted log loss on training rows is below that of the classes' shares."""
    rows = split.where("is_test").groupBy("target").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("most"), F.sum("n").alias("n"))
    hits = preds.where("is_test").agg(F.count_if(F.col("prediction") == F.col("target")).alias("hits"))
    loss = preds.where("not is_test").agg((F.sum(-F.col("train_weight") * F.log(F.get("p", F.col("target").cast("int")))) / F.sum("train_weight")).alias("loss"))
    share = split.where("not is_test").groupBy("target").agg(F.sum("train_weight").alias("w"))
    prior = share.agg((F.log(F.sum("w")) - F.sum(F.col("w") * F.log("w")) / F.sum("w")).alias("prior"))
    one = rows.crossJoin(F.broadcast(hits)).crossJoin(F.broadcast(loss)).crossJoin(F.broadcast(prior))  # one row each
    return one.select(F.explode(F.array(*_metrics(("as_good_as_majority", (F.col("hits") + F.col("n") / 100 >= F.col("most")).cast("int")),
                                                  ("loss_below_prior", (F.col("loss") < F.col("prior")).cast("int"))))).alias("m")).select("m.*")


def train_evaluate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Joint weighted boosting, 100 rounds, on the 80% split, scored on the rest."""
    from pitchspark.operators import learn as ml
    split = ml.weighted_split(_model_rows(spark, sf_dir), "match_id", "target")
    model = ml.fit(split.where("not is_test"), MODEL_FEATURES, "target", "train_weight", "boosted")
    preds = materialize(ml.score(model, split, MODEL_FEATURES), "scored")
    return _prediction_checks(preds.where("is_test"), split).unionByName(_accuracy_checks(preds, split))


GRID = {"depth": [2, 3], "rate": [0.05, 0.3], "rounds": [5, 10]}


def grid_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A grid of three tree parameters by stratified folds, the best point refitted (M2, W6): folds, points and what the chosen model must satisfy."""
    from pitchspark.operators import learn as ml
    split = ml.weighted_split(_model_rows(spark, sf_dir), "match_id", "target")
    train = split.where("not is_test")
    model, found = ml.tune_boosted(train, MODEL_FEATURES, GRID, "target", "train_weight")
    best = max(a for _, a, _ in found)
    chosen = next(p for p, a, _ in found if a == best)
    folds = train.groupBy("fold").count().select(F.concat(F.lit("fold_"), F.col("fold").cast("string")).alias("metric"), F.col("count").cast("double").alias("value"))
    rows = [("points", float(len(found))), ("chosen_is_best", float(model.params == chosen)), ("accuracies_in_range", float(all(0 < x < 1 for _, _, f in found for x in f)))]
    preds = materialize(ml.score(model, split, MODEL_FEATURES), "scored")
    return (folds.unionByName(spark.createDataFrame(rows, "metric string, value double")).unionByName(_prediction_checks(preds.where("is_test"), split))
            .unionByName(_accuracy_checks(preds, split).where("metric <> 'loss_below_prior'")))  # a point of few rounds need not be


def batch_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row scored by a saved and reloaded model (M3, M6, S8); the label is the first largest probability."""
    from pitchspark.operators import learn as ml
    split = ml.weighted_split(_model_rows(spark, sf_dir), "match_id", "target")
    model = ml.fit(split.where("not is_test"), MODEL_FEATURES, "target", "train_weight", "logreg")
    base = shared_path(spark, "runs")
    ml.save_run(model, f"{base}/model", f"{base}/registry", "batch", None, MODEL_FEATURES, split.count())
    loaded, features = ml.load_run(spark, f"{base}/registry", "batch")
    scored = ml.score(loaded, split, features)
    same = ml.score(model, split.select("match_id", *MODEL_FEATURES), features).select("match_id", F.col("p").alias("q"))
    close = F.forall(F.zip_with("p", "q", lambda x, y: F.abs(x - y) < 1e-9), lambda x: x)
    return scored.join(same, "match_id").select("match_id", "target", (pr.argmax_label(F.col("p")) == F.col("prediction")).alias("label_is_largest"),
                                                close.alias("reloaded_equal"))


def importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of the 100-round model by importance (M5, T3): positions in falling order, shares that sum to 1."""
    from pitchspark.operators import learn as ml
    split = ml.weighted_split(_model_rows(spark, sf_dir), "match_id", "target")
    model = ml.fit(split.where("not is_test"), MODEL_FEATURES, "target", "train_weight", "boosted")
    imp = ml.feature_importance(model, MODEL_FEATURES)
    place = Window.orderBy(F.monotonically_increasing_id())  # one row a feature
    at = imp.withColumn("position", F.row_number().over(place))
    falling = F.coalesce(F.lag("importance").over(Window.orderBy("position")) >= F.col("importance"), F.lit(True))
    whole = F.abs(F.sum("importance").over(Window.partitionBy()) - 1) < 1e-9
    names = F.array_sort(F.collect_list("feature").over(Window.partitionBy()))
    return at.select("position", (falling & (F.col("importance") >= 0)).alias("falling"), whole.alias("sums_to_one"), names[F.col("position") - 1].alias("one_of_the_features"))


def inspect_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registered run reloaded, split again and scored again (M6): its metrics must be those stored."""
    from pitchspark.operators import learn as ml
    rows = _model_rows(spark, sf_dir)
    split = ml.weighted_split(rows, "match_id", "target")
    model = ml.fit(split.where("not is_test"), MODEL_FEATURES, "target", "train_weight", "logreg")
    acc = ev.accuracy(ml.score(model, split.where("is_test"), MODEL_FEATURES), "target").first().accuracy
    base = shared_path(spark, "runs")
    ml.save_run(model, f"{base}/model", f"{base}/registry", "inspected", acc, MODEL_FEATURES, split.count())
    got = ml.inspect_run(spark, f"{base}/registry", "inspected", rows)
    again = got["accuracy"].crossJoin(F.broadcast(got["run"].select(F.col("accuracy").alias("stored"), "training_rows")))  # one row each
    checks = again.select(F.explode(F.array(*_metrics(("accuracy_as_stored", (F.abs(F.col("accuracy") - F.col("stored")) < 1e-12).cast("int")),
                                                      ("test_rows", F.col("rows")), ("training_rows", F.col("training_rows"))))).alias("m")).select("m.*")
    support = got["report"].where("class in ('0', '1', '2')").select(F.concat(F.lit("support_"), "class").alias("metric"), F.col("support").cast("double").alias("value"))
    counted = got["confusion"].agg(F.sum(F.col("pred_0") + F.col("pred_1") + F.col("pred_2") + F.col("pred_other")).alias("n"))
    return checks.unionByName(support).unionByName(counted.select(F.lit("confusion_rows").alias("metric"), F.col("n").cast("double").alias("value")))


def file_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rosters written per country and league ratings in three CSV layouts, read back.

    A fourth layout lacks the wanted column (skipped), some rows do not parse
    (quarantine).
    """
    from pitchspark.sources import files
    base = shared_path(spark, "files")
    roster = fixture(spark, sf_dir, "fx_roster")
    stem = F.concat(F.replace(F.lower("country"), F.lit(" "), F.lit("_")), F.lit("_cleaned.csv"))
    files.write_partitioned(roster.select("player_id", "club", "market_value", stem.alias("file")), f"{base}/squads", "file", "csv")
    squads = files.read_keyed(spark, f"{base}/squads", "player_id long, club string, market_value string", "country", "_cleaned.csv", folder=True)
    keyed = squads.groupBy("country").agg(F.count(F.lit(1)).alias("n"), F.sum("player_id").cast("double").alias("total")).select(
        F.concat(F.lit("squad "), "country").alias("item"), "n", "total")
    ratings = fixture(spark, sf_dir, "fx_league_ratings").withColumn("layout", F.pmod("row_id", F.lit(4)))
    text = F.when(F.pmod("row_id", F.lit(10)) == 0, F.lit("n/a")).otherwise(F.coalesce(F.col("rating").cast("string"), F.lit("")))
    for k, cols in enumerate((["player", "rating"], ["id", "name", "averageRating"], ["averageRating", "id", "player"], ["id", "goals"])):
        named = {"player": F.col("player"), "name": F.col("player"), "rating": text, "averageRating": text, "id": F.col("row_id"), "goals": F.col("row_id")}
        files.write_table(ratings.where(F.col("layout") == k).select(*[named[c].alias(c) for c in cols]), f"{base}/ratings/layout{k}", "csv")
    found = files.read_reconciled(spark, f"{base}/ratings", "rating")
    good, bad = files.split_quarantine(found.data, F.col("rating").isNull() | F.col("rating").try_cast("double").isNotNull())
    whole = files.read_table(spark, f"{base}/ratings/layout3", "id long, goals long", "csv")
    number = F.sum(F.col("rating").try_cast("double").cast("decimal(24,6)")).cast("double")
    rows = [good.agg(F.count(F.lit(1)).alias("n"), number.alias("total")).select(F.lit("good ratings").alias("item"), "n", "total"),
            bad.agg(F.count(F.lit(1)).alias("n")).select(F.lit("quarantined").alias("item"), "n", F.lit(0.0).alias("total")),
            found.skipped.agg((F.count(F.lit(1)) > 0).cast("long").alias("n")).select(F.lit("skipped layouts").alias("item"), "n", F.lit(0.0).alias("total")),
            whole.agg(F.count(F.lit(1)).alias("n"), F.sum("goals").cast("double").alias("total")).select(F.lit("plain table").alias("item"), "n", "total")]
    out = keyed
    for r in rows:
        out = out.unionByName(r)
    return out.select("item", "n", _r("total"))


def league_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """League ratings written a folder per source and read back from the listed leagues' files only."""
    from pitchspark.sources import files
    base = shared_path(spark, "leagues")
    ratings = fixture(spark, sf_dir, "fx_league_ratings")
    files.write_partitioned(ratings.select("player", F.coalesce(F.col("rating").cast("string"), F.lit("")).alias("rating"), F.col("source_file").alias("file")),
                            base, "file", "csv")
    found = files.read_reconciled(spark, base, "rating", only=feat.listed_league, folder=True)
    uni = feat.league_universe(found.data.withColumn("rating", F.col("rating").try_cast("double")), feat.league_weights_df(spark))
    # Names first: a league's distinct names are then a count, without rows expanded for a distinct aggregate.
    names = uni.groupBy("league_key", "top5", "match_name").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("weighted_rating").cast("decimal(24,6)")).alias("total"))
    out = names.groupBy("league_key", "top5").agg(F.sum("n").alias("n"), F.count("match_name").alias("players"), F.sum("total").cast("double").alias("total"))
    return out.select("league_key", "top5", "n", "players", F.round("total", 3).alias("total"))


def match_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows read, kept and dropped by reason at each stage from matches to training rows, counted by the one job that writes them."""
    team = fixture(spark, sf_dir, "fx_team_partial").select("team").distinct()
    unscored = F.col("home_score").isNull() | F.col("away_score").isNull()
    played, results = ev.drop_counted(fixture(spark, sf_dir, "fx_matches"), "results", {"no score": unscored, "no date": F.col("date").isNull()})
    sided = played
    for side in ("team_a", "team_b"):
        known = team.select(F.col("team").alias(f"known_{side}"))
        sided = sided.join(known, F.col(side) == F.col(f"known_{side}"), "left")
    training, sides = ev.drop_counted(sided, "sides", {f"{side} without features": F.col(f"known_{side}").isNull() for side in ("team_a", "team_b")})
    training.select("match_id", "team_a", "team_b").write.parquet(shared_path(spark, "training-rows"))
    return ev.flow_report(spark, {"results": results, "sides": sides})


def unmatched_teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Teams of the match history without a feature row (J8): the rows the
    inner joins of the training matrix drop, reported instead of lost."""
    m = fixture(spark, sf_dir, "fx_matches")
    teams = (m.select(F.col("team_a").alias("team"))
             .unionByName(m.select(F.col("team_b").alias("team"))).distinct())
    return pr.unmatched_entities(teams, "team", fixture(spark, sf_dir, "fx_team_partial"), "team")


QUERIES: dict[str, QueryFn] = {
    "unmatched_teams": unmatched_teams,
    "train_evaluate": train_evaluate,
    "master": master,
    "training_with_elo": training_with_elo,
    "group_probabilities": group_probabilities,
    "fuzzy_lookup": fuzzy_lookup,
    "experience": experience,
    "squad_value": squad_value,
    "chemistry": chemistry,
    "form_rating": form_rating,
    "average_rank": average_rank,
    "pair_matrix": pair_matrix,
    "training_matrix": training_matrix,
    "elo_history": elo_history,
    "elo_leaderboard": elo_leaderboard,
    "elo_top15": elo_top15,
    "standings": standings,
    "wild_cards": wild_cards,
    "standings_by_rating": standings_by_rating,
    "position_counts": position_counts,
    "advancement": advancement,
    "elo_history_sliced": elo_history_sliced,
    "tournament_experience": tournament_experience,
    "master_pairs": master_pairs,
    "master_training": master_training,
    "grid_search": grid_search,
    "batch_scores": batch_scores,
    "importance": importance,
    "inspect_run": inspect_run,
    "file_round_trip": file_round_trip,
    "league_files": league_files,
    "match_flow": match_flow,
    "stage_rates": stage_rates,
    "accuracy": accuracy,
    "class_report": class_report,
    "confusion_matrix": confusion_matrix,
    "stratified_split": stratified_split,
    "run_leaderboard": run_leaderboard,
    "pair_lookup": pair_lookup,
    "probs_label": probs_label,
}

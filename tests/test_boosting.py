"""Joint boosting against a single-machine brute force, grids against single fits, and the registry."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from pitchspark.operators import boosting as bo
from pitchspark.operators import learn as ml
from pitchspark.session import shared_path


@pytest.fixture(scope="module")
def rows(spark):
    rnd = np.random.default_rng(7)
    x = rnd.normal(size=(1200, 4))
    x[:, 3] = np.round(x[:, 3])
    y = (x[:, 0] + 0.5 * x[:, 1] * x[:, 3] + 0.4 * rnd.normal(size=1200) > 0).astype(int) + (x[:, 2] > 0.8)
    data = [(i, *(float(v) if rnd.random() > 0.05 else None for v in x[i]), int(y[i]), float(rnd.uniform(0.5, 1.5)), int(i % 5)) for i in range(1200)]
    return spark.createDataFrame(data, "match_id long, a double, b double, c double, d double, target int, train_weight double, fold int")


FEATURES = ["a", "b", "c", "d"]


def brute(pdf, keys, edges, p, left_out=None):
    """Row by row and split by split: every node's gain from its own rows."""
    bins = bo.bin_values([pdf[f].to_numpy(float) for f in FEATURES], edges)
    y, w = pdf.target.to_numpy(), pdf.train_weight.to_numpy()
    m, trees = np.zeros((len(y), 3)), []
    for r in range(p.rounds):
        use = bo.sampled_rows(keys, p, r) & (pdf.fold.to_numpy() != (-9 if left_out is None else left_out))
        e = np.exp(m)
        prob = e / e.sum(axis=1, keepdims=True)
        trees.append([])
        grown = []
        for c in range(3):
            g = (prob[:, c] - (y == c)) * w
            h = 2 * prob[:, c] * (1 - prob[:, c]) * w
            soft = lambda v: np.sign(v) * max(abs(v) - p.alpha, 0)
            point = lambda s: soft(g[s].sum()) ** 2 / (h[s].sum() + p.lam)
            leaf = lambda s: -p.rate * soft(g[s].sum()) / (h[s].sum() + p.lam)
            tree, members = {}, {0: np.ones(len(y), bool)}
            for node in range(2**p.depth - 1):
                if node not in members:
                    continue
                here, best = members[node] & use, None
                for missing in (False, True):
                    for j in bo.sampled_columns(4, p, r, c):
                        for b in range(1, bo.BINS - 1):
                            left = np.where(bins[:, j] == 0, missing, bins[:, j] <= b)
                            lo, hi = here & left, here & ~left
                            if h[lo].sum() < p.min_child or h[hi].sum() < p.min_child:
                                continue
                            gain = point(lo) + point(hi) - point(here)
                            if gain > 1e-6 and (best is None or gain > best[0] + 1e-9 * abs(best[0])):
                                best = (gain, int(j), b, missing, left)
                tree[node] = best
                if best:
                    members[2 * node + 1], members[2 * node + 2] = members[node] & best[4], members[node] & ~best[4]
            for node, rows_of in members.items():
                if not tree.get(node):
                    grown.append((c, rows_of, leaf(rows_of & use)))
            trees[-1].append({n: s[1:4] for n, s in tree.items() if s})
        for c, rows_of, value in grown:
            m[rows_of, c] += value
    return trees, m


def test_same_trees_as_brute_force(spark, rows):
    p = bo.Params(rounds=3, depth=2, rate=0.3)
    model = bo.fit_boosted(rows, FEATURES, "target", "train_weight", "match_id", p)
    pdf = rows.withColumn("k", F.xxhash64(F.col("match_id").cast("string"))).toPandas()
    trees, m = brute(pdf, pdf.k.to_numpy().view(np.uint64), model.edges, p)
    got = [[{n: (int(t.feature[n]), int(t.bin[n]), bool(t.missing_left[n])) for n in np.flatnonzero(t.feature >= 0)} for t in r] for r in model.trees]
    assert got == trees
    bins = bo.bin_values([pdf[f].to_numpy(float) for f in FEATURES], model.edges)
    assert np.allclose(bo.margins(np.zeros_like(m), bins, model.trees, p), m, atol=1e-9)
    scored = bo.score(model, rows).select("match_id", "p", "prediction").toPandas().set_index("match_id").loc[pdf.match_id]
    assert np.allclose(np.stack(scored.p.to_numpy()), bo.softmax(m)) and (scored.prediction.to_numpy() == m.argmax(axis=1)).mean() > 0.999


def test_sums_by_key_equal_sums_on_the_driver(spark, rows, monkeypatch):
    p = bo.Params(rounds=2, depth=2, rate=0.3)
    one = bo.fit_boosted(rows.repartition(6), FEATURES, "target", None, "match_id", p)
    monkeypatch.setattr(bo, "DRIVER_CELLS", 0)
    two = bo.fit_boosted(rows, FEATURES, "target", None, "match_id", p)
    assert [t.feature.tolist() for r in one.trees for t in r] == [t.feature.tolist() for r in two.trees for t in r]
    assert np.allclose([t.value for r in one.trees for t in r], [t.value for r in two.trees for t in r])


def test_grid_points_equal_single_fits(spark, rows):
    grid = {"depth": [1, 2], "rounds": [2, 12]}
    found = bo.grid_accuracies(rows, FEATURES, grid, "target", "train_weight", "match_id", folds=2, base=bo.Params(rate=0.3))
    assert [(p.depth, p.rounds) for p, _, _ in found] == [(1, 2), (1, 12), (2, 2), (2, 12)]
    for p, mean, by_fold in (found[1], found[2]):
        f = bo.Fit(p, 1)
        edges, _ = bo.fit_many(rows, FEATURES, [f], "target", "train_weight", "match_id", "fold")
        model = bo.BoostedModel(FEATURES, edges, 3, p, f.trees)
        right = bo.score(model, rows.where("fold = 1")).agg(F.avg((F.col("prediction") == F.col("target")).cast("int"))).first()[0]
        assert abs(right - by_fold[1]) < 0.01 and abs(mean - sum(by_fold) / 2) < 1e-12
    assert found[3][1] > 0.7


def test_registry_versions_and_round_trip(spark, rows):
    model = ml.fit(rows, FEATURES, model="boosted", params={"rounds": 2})
    later = ml.fit(rows, FEATURES, model="boosted", params={"rounds": 3})
    base = shared_path(spark, "test-runs")
    # Two runs of one name within a second: the later one loads, the first one's folder stays.
    assert ml.save_run(model, f"{base}/m", f"{base}/registry", "x", 0.5, FEATURES, 10) == 1
    assert ml.save_run(later, f"{base}/m", f"{base}/registry", "x", 0.6, FEATURES, 10) == 2
    loaded, features = ml.load_run(spark, f"{base}/registry", "x")
    assert features == FEATURES and len(loaded.trees) == 3
    a, b = (ml.score(m, rows, FEATURES).select("match_id", "p").orderBy("match_id").collect() for m in (later, loaded))
    assert a == b
    imp = ml.feature_importance(loaded, FEATURES).collect()
    assert abs(sum(r.importance for r in imp) - 1) < 1e-9 and imp[0].importance >= imp[-1].importance
    with pytest.raises(KeyError):
        ml.load_run(spark, f"{base}/registry", "y")


def test_constant_and_missing_features(spark):
    df = spark.createDataFrame([(i, None, 1.0, i % 3, 1.0) for i in range(30)], "match_id long, a double, b double, target int, train_weight double")
    model = ml.fit(df, ["a", "b"], model="boosted", params={"rounds": 2})
    p = ml.score(model, df, ["a", "b"]).first().p
    assert abs(sum(p) - 1) < 1e-12 and all((t.feature == -1).all() for r in model.trees for t in r)


def test_nodes_equal_a_walk_by_hand():
    """Leaves above the last level, both sides of missing values, columns of any layout."""
    import numpy as np

    from pitchspark.operators.boosting import BINS, Tree
    r = np.random.default_rng(5)
    for _ in range(20):
        t = Tree.empty(3)
        t.feature[:7] = r.integers(-1, 4, 7)
        t.bin[:7], t.missing_left[:7] = r.integers(1, BINS, 7), r.integers(0, 2, 7).astype(bool)
        bins = np.asfortranarray(r.integers(0, BINS, (200, 4)).astype(np.uint8))
        for levels in range(4):
            want = []
            for row in bins:
                at = 0
                for _ in range(levels):
                    f = t.feature[at]
                    if f >= 0:
                        left = t.missing_left[at] if row[f] == 0 else row[f] <= t.bin[at]
                        at = 2 * at + (1 if left else 2)
                want.append(at)
            assert t.nodes(bins, levels).tolist() == want
    assert t.nodes(bins[:0], 3).tolist() == []


def test_lookups_equal_walks():
    """Depths within and beyond a lookup's, leaves above the last level, more trees than a word holds; margins add up in the order of the rounds."""
    r = np.random.default_rng(9)
    for depth in (1, 2, 3, 4):
        rounds = []
        for _ in range(4):
            rounds.append([])
            for _ in range(3):
                t = bo.Tree.empty(depth)
                inner = 2**depth - 1
                t.feature[:inner], t.bin[:inner] = r.integers(-1, 5, inner), r.integers(1, bo.BINS, inner)
                t.missing_left[:inner], t.value[:] = r.integers(0, 2, inner).astype(bool), r.normal(size=len(t.value))
                rounds[-1].append(t)
        bins = r.integers(0, bo.BINS, (300, 5)).astype(np.uint8)
        trees = [t for x in rounds for t in x]
        for levels in range(depth + 1):
            got = list(bo.Lookup(trees, levels, lambda t: np.arange(len(t.feature)), 5)(bo._columns(bins.T)))
            assert all((a == t.nodes(bins, levels)).all() for a, t in zip(got, trees, strict=True))
        start = r.normal(size=(300, 3))
        want = start.copy()
        for x in rounds:
            for c, t in enumerate(x):
                want[:, c] += t.value[t.nodes(bins, depth)]
        assert (bo.margins(start, bins, rounds, bo.Params(depth=depth)) == want).all()


def test_margins_are_carried_only_for_rounds_that_follow(spark, rows, monkeypatch):
    """No pass that writes margins after the last round; small blocks, chunks and joint sets and carrying every other round give the same trees."""
    p, passes, carried = bo.Params(rounds=4, depth=3, rate=0.3), [], bo._carried
    monkeypatch.setattr(bo, "_carried", lambda *a: passes.append(1) or carried(*a))
    found = bo.binned(rows.coalesce(1), FEATURES, "target", "train_weight", "match_id", "fold")
    want = bo.fit_boosted(found, FEATURES, "target", "train_weight", "match_id", p)
    for name, value in {"CARRY": 2, "CHUNK_ROWS": 100, "JOINT_CELLS": 1, "BLOCK_ROWS": 256}.items():
        monkeypatch.setattr(bo, name, value)
    monkeypatch.setattr(bo, "bin_edges", lambda *a: found.edges)
    got = bo.fit_boosted(rows, FEATURES, "target", "train_weight", "match_id", p)
    assert len(passes) == 1
    assert [t.feature.tolist() for r in got.trees for t in r] == [t.feature.tolist() for r in want.trees for t in r]
    assert np.allclose([t.value for r in got.trees for t in r], [t.value for r in want.trees for t in r])

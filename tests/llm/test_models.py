import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitchspark.llm import quality_model, toxicity


DATA = "/root/testdata/sf0.1"


def held(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{DATA}/labels.parquet")


def test_flattened_trees_equal_a_walk():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(800, 5)).astype(np.float32)
    y = ((x[:, 0] > 0.3) ^ (x[:, 2] > 0)).astype(float)
    m = quality_model.fit_trees(x, y, trees=20, depth=3)
    assert ((m.score(x) > 0.5) == y).mean() > 0.95
    margin = np.full(len(x), m.base)
    for i, row in enumerate(x):
        for t in range(20):
            node = 0
            for _ in range(3):
                node = 2 * node + (2 if row[m.feature[t, node]] > m.cut[t, node] else 1)
            margin[i] += m.value[t, node - 7]
    assert np.allclose(m.score(x), 1 / (1 + np.exp(-margin)))


def test_trees_without_both_classes():
    for y in (np.zeros(0), np.ones(4)):
        m = quality_model.fit_trees(np.zeros((len(y), 3), np.float32), y)
        assert np.isfinite(m.score(np.zeros((2, 3), np.float32))).all()


def test_quality_on_held_out_rows(tables):
    docs, labels = tables
    model = quality_model.fit_quality(docs, labels)
    rows = quality_model.score_quality(docs, model).join(labels, "doc_id").select("doc_id", "quality", "score").collect()
    out = [r for r in rows if held(r.doc_id)]
    assert len(out) > 300
    assert np.mean([(r.score >= 0.3) == bool(r.quality) for r in out]) > 0.97
    assert np.mean([r.score >= 0.3 for r in out if r.quality]) > 0.99


def test_toxicity_on_held_out_rows(tables):
    docs, labels = tables
    model = toxicity.fit_toxicity(docs, labels)
    rows = toxicity.score_toxicity(docs, model).join(labels, "doc_id").select("doc_id", "toxic", "score").collect()
    out = [r for r in rows if held(r.doc_id)]
    assert np.mean([r.score >= 0.5 for r in out if r.toxic]) > 0.8
    assert np.mean([r.score >= 0.5 for r in out if not r.toxic]) < 0.01


def known_features(positive, unlabelled, keep, least, unlike):
    """The choice of features on one machine."""
    size = 1 + max(max(x.max() for x in positive), max(x.max() for x in unlabelled))
    p, u = (np.bincount(np.concatenate(x), minlength=size) for x in (positive, unlabelled))
    n, m = len(positive), len(unlabelled)
    z = np.abs(p / n - u / m) / np.sqrt(np.maximum((p + u) / (n + m) * (1 / n + 1 / m), 1e-12))
    z[(p < least) | (z < unlike)] = 0
    best = np.argsort(-z, kind="stable")[:keep]
    return np.sort(best[z[best] > 0])


def test_non_negative_risk_beats_a_wrong_negative_class(spark):
    """Half of the unlabelled rows are positive: calling them all negative would reject positives."""
    rng = np.random.default_rng(2)
    def sample(toxic, n):
        return [np.unique(np.concatenate((rng.integers(100, 400, 20), rng.integers(0, 10, 3) if toxic else rng.integers(10, 20, 3)))).astype(np.int32) for _ in range(n)]
    positive, mixed = sample(True, 400), sample(True, 600) + sample(False, 600)
    sets = spark.createDataFrame([(k, x.tolist()) for k, of in ((1, positive), (0, mixed)) for x in of], "is_p int, x array<int>")
    for keep, unlike in ((1024, 3.0), (4, 1.0)):
        assert toxicity.choose_features(sets, keep, 5, unlike).tolist() == known_features(positive, mixed, keep, 5, unlike).tolist()
    m = toxicity.fit_pu(positive, mixed, 0.5, toxicity.choose_features(sets, 1024, 5, 3.0))
    table = m.weight.mean(axis=0)
    score = lambda sets: np.array([table[toxicity._select(s, m.known)].sum() + table[-1] for s in sets])
    assert (score(sample(True, 300)) > 0).mean() > 0.95 and (score(sample(False, 300)) > 0).mean() < 0.05


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(10, 1, 0), (11, 0, 1), (11, 0, 0), (None, 1, 1), (12, None, None), (13, 1, 1)], "doc_id long, quality int, toxic int")
    for fit, add in ((quality_model.fit_quality, quality_model.score_quality), (toxicity.fit_toxicity, toxicity.score_toxicity)):
        model = fit(odd_docs, labels)
        scored = add(odd_docs, model, out="s")
        assert scored.count() == odd_docs.count()
        assert scored.where(F.col("s").isNull() | F.isnan("s") | (F.col("s") < 0) | (F.col("s") > 1)).count() == 0
        empty = fit(no_docs, labels.limit(0))
        assert add(no_docs, empty).count() == 0 and add(odd_docs, empty).count() == odd_docs.count()

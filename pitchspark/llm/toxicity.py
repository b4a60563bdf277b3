"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents (P) and unlabelled text (U, whatever its label) train
linear classifiers in numpy. With the class prior ``pi`` = P(toxic) the risk is

    pi * E_P[l(g)] + max(0, E_U[l(-g)] - pi * E_P[l(-g)])

with the logistic loss l: the second part estimates the loss on clean text
without a clean example. When a batch drives it below zero, which only
overfitting can, the step goes the other way (the non-negative correction).
Features are the distinct words of the lower-cased text and the first bytes of
each word, hashed; those most unlike between P and U are kept, and several
classifiers from different seeds are averaged. Features are counted and chosen in
Spark; only the columns of the chosen ones reach the driver.

The fit uses at most ``max_positive`` and ``max_unlabelled`` documents (bounds
that do not grow with the data), chosen by a hash of the id among those not
held out. The prior is the share of toxic labels among all labelled rows that
are not held out, unless given. Scoring maps over all documents without a
shuffle. Null texts count as empty; an empty text has no feature and gets the
score of the bias; without a toxic label every score is 0. Repeated labels of
an id count as the larger.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, chunks, held_out, texts_of, written

MAX_POSITIVE, MAX_UNLABELLED = 4_000, 12_000
HASH_BITS = 20
HEAD_BYTES = 4
#: A feature must occur in ``LEAST`` positive documents, its shares in P and U must differ by ``UNLIKE`` standard errors; the ``KEEP`` most unlike stay.
KEEP, LEAST, UNLIKE = 1024, 5, 4.0
#: Everything in ASCII but letters and digits ends a word; bytes of other scripts belong to it.
_SEPARATORS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def feature_sets(texts: list[bytes]) -> list[np.ndarray]:
    """Sorted distinct hashed features of each text: its words and the heads of its words."""
    out: list[np.ndarray] = []
    for a, b in chunks(texts):
        w = Words([t.lower() for t in texts[a:b]], _SEPARATORS)
        shift = np.uint64(64 - HASH_BITS)
        whole = (w.hashes() >> shift).astype(np.int32)
        heads = (w.span_hashes(w.starts, np.minimum(w.ends, w.starts + HEAD_BYTES)) >> shift).astype(np.int32) | np.int32(1 << HASH_BITS)
        for x, y in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True):
            out.append(np.unique(np.concatenate((whole[x:y], heads[x:y]))))
    return out


def _select(sets: list[np.ndarray], known: np.ndarray) -> np.ndarray:
    """For each feature of a text its column of the model, without those it doesn't know."""
    if not len(known):
        return np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(known, sets), len(known) - 1)
    return at[known[at] == sets]


@dataclass
class PuModel:
    """``known``: sorted features; ``weight``: one row per classifier, the last entry is the bias."""

    known: np.ndarray
    weight: np.ndarray

    def score(self, texts: list[bytes]) -> np.ndarray:
        if not len(self.known):
            return np.zeros(len(texts))
        table = self.weight.mean(axis=0)
        margin = np.array([table[_select(s, self.known)].sum() if len(s) else 0.0 for s in feature_sets(texts)]) + table[-1]
        return _sigmoid(margin)


def _soft(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def choose_features(sets: DataFrame, keep: int = KEEP, least: int = LEAST, unlike: float = UNLIKE) -> np.ndarray:
    """The sorted features of the rows' sets ``x`` that tell P (``is_p`` = 1) and U apart; counts are partial sums, at most ``keep`` rows return."""
    n_p, n = sets.agg(F.coalesce(F.sum("is_p"), F.lit(0)), F.count(F.lit(1))).first()
    n_u = n - n_p
    if not n_p or not n_u:
        return np.zeros(0, np.int32)
    counts = sets.select("is_p", F.explode("x").alias("f")).groupBy("f").agg(F.sum("is_p").alias("in_p"), F.sum(1 - F.col("is_p")).alias("in_u"))
    pooled = (F.col("in_p") + F.col("in_u")) / F.lit(float(n))
    z = (F.col("in_p") / F.lit(float(n_p)) - F.col("in_u") / F.lit(float(n_u))) / F.sqrt(F.greatest(pooled * F.lit(1 / n_p + 1 / n_u), F.lit(1e-12)))
    rows = (counts.where(F.col("in_p") >= least).select("f", F.abs(z).alias("z")).where((F.col("z") >= unlike) & (F.col("z") > 0))
            .orderBy(F.desc("z"), "f").limit(keep).collect())
    return np.sort(np.array([r.f for r in rows], np.int32))


def fit_pu(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, known: np.ndarray, seeds: tuple[int, ...] = (1, 2, 3),
           epochs: int = 60, rate: float = 0.1, l2: float = 1e-5) -> PuModel:
    """Fit on feature sets, with one column for each of the sorted features ``known``."""
    if not positive or not unlabelled or not len(known):
        return PuModel(np.zeros(0, np.int32), np.zeros((1, 1)))

    def dense(sets):
        x = np.zeros((len(sets), len(known) + 1), dtype=np.float32)
        x[:, -1] = 1
        for row, s in zip(x, sets, strict=True):
            if len(s):
                row[_select(s, known)] = 1
        return x

    xp, xu = dense(positive), dense(unlabelled)
    weight = _train(xp, xu, prior, seeds, epochs, rate, l2, None)
    return PuModel(known, _train(xp, xu, prior, seeds, epochs, rate, l2, weight))


def _train(xp: np.ndarray, xu: np.ndarray, prior: float, seeds: tuple[int, ...], epochs: int, rate: float, l2: float,
           begin: np.ndarray | None) -> np.ndarray:
    """One row of weights per seed: minibatch Adam on the non-negative risk.

    Without ``begin`` with the convex logistic loss; from ``begin`` on with the
    sigmoid loss, which is bounded and so settles on which side a text lies.
    """
    weights = []
    for k, seed in enumerate(seeds):
        rng = np.random.default_rng(seed)
        w = np.zeros(xp.shape[1], dtype=np.float32) if begin is None else begin[k].copy()
        w[-1] = np.log(prior / (1 - prior)) if begin is None else w[-1]
        first, second, step = np.zeros_like(w), np.zeros_like(w), 0
        for _ in range(epochs):
            order_p, order_u = rng.permutation(len(xp)), rng.permutation(len(xu))
            for part_p, part_u in zip(np.array_split(order_p, 8), np.array_split(order_u, 8), strict=True):
                if not len(part_p) or not len(part_u):
                    continue
                bp, bu = xp[part_p], xu[part_u]
                gp, gu = bp @ w, bu @ w
                sp, su = _sigmoid(gp), _sigmoid(gu)
                if begin is None:  # risk of calling a text toxic, and the slopes of both parts
                    clean_risk = _soft(gu).mean() - prior * _soft(gp).mean()
                    slope_u, slope_p, slope_toxic = su, sp, 1 - sp
                else:
                    clean_risk = su.mean() - prior * sp.mean()
                    slope_u, slope_p, slope_toxic = su * (1 - su), sp * (1 - sp), sp * (1 - sp)
                clean = bu.T @ slope_u / len(bu) - prior * (bp.T @ slope_p) / len(bp)
                toxic = -prior * (bp.T @ slope_toxic) / len(bp)
                grad = (toxic + clean if clean_risk >= 0 else -clean) + l2 * w
                step += 1
                first = 0.9 * first + 0.1 * grad
                second = 0.99 * second + 0.01 * grad**2
                w = w - rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
                w = w.astype(np.float32)
        weights.append(w)
    return np.array(weights)


def class_prior(labels: DataFrame, id_col: str = "doc_id", label: str = "toxic") -> float:
    """The share of toxic rows among all labelled rows that are not held out."""
    share = labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col)).agg(F.avg(F.col(label).cast("double"))).first()[0]
    return float(np.clip(share or 0.0, 1e-3, 1 - 1e-3))


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic",
                 max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED, prior: float | None = None) -> PuModel:
    """Draw P and U, collect their feature sets (bounded by the two maxima) and fit."""
    place = F.xxhash64("fit_id")
    confirmed = (labels.where((F.col(label) == 1) & F.col(id_col).isNotNull() & ~held_out(id_col)).select(F.col(id_col).alias("fit_id")).distinct()
                 .orderBy(place, "fit_id").limit(max_positive).withColumn("is_p", F.lit(1)))
    some = (docs.where(F.col(id_col).isNotNull() & ~held_out(id_col)).select(F.col(id_col).alias("fit_id")).distinct()
            .orderBy(place, "fit_id").limit(max_unlabelled).withColumn("is_p", F.lit(0)))

    @F.arrow_udf("array<int>")
    def features(column):
        import pyarrow as pa

        return pa.array(feature_sets(texts_of(column)), pa.list_(pa.int32()))

    rows = written(docs.select(F.col(id_col).alias("fit_id"), F.col(text).alias("t")).join(F.broadcast(confirmed.unionByName(some)), "fit_id")  # bounded
                   .select("fit_id", "is_p", features(F.col("t")).alias("x")), "toxicity-features")
    known = choose_features(rows)
    chosen = F.array_intersect("x", F.lit(known.tolist()).cast("array<int>"))
    of = rows.select("fit_id", "is_p", chosen.alias("x")).toArrow().sort_by([("is_p", "ascending"), ("fit_id", "ascending")])
    is_p = of["is_p"].to_numpy()
    sets = [np.asarray(x.values, dtype=np.int32) for x in of["x"]]
    return fit_pu([s for s, k in zip(sets, is_p, strict=True) if k], [s for s, k in zip(sets, is_p, strict=True) if not k],
                  class_prior(labels, id_col, label) if prior is None else prior, known)


def score_toxicity(df: DataFrame, model: PuModel, text: str = "text", out: str = "score") -> DataFrame:
    """Add the toxicity of each whole text, 0 to 1. No shuffle."""

    @F.arrow_udf("double")
    def score(column):
        import pyarrow as pa

        return pa.array(model.score(texts_of(column)), pa.float64())

    return df.withColumn(out, score(F.col(text)))

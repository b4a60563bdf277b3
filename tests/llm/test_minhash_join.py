import random

import numpy as np
from pyspark.sql import functions as F

from pitchspark.llm import minhash_join

from .conftest import words


def shingle_set(t):
    w = (t or "").encode().lower().split()
    return frozenset(zip(w, w[1:])) if len(w) >= 2 else frozenset([tuple(w)] if w else [])  # noqa: B905


def brute(rows, percent=80):
    sets = [shingle_set(t) for _, t in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                up[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    out = []
    for i, (d, _) in enumerate(rows):
        c = least.get(find(i))
        out.append((d, len(sets[i]), c, c is None or d == c))
    return sorted(out, key=str)


def check(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash_join.near_duplicates(df).collect()), key=str)
    assert got == brute(rows)
    return got


def test_components_equal_brute_force(spark):
    rnd = random.Random(12)
    rows, common = [], words(rnd, 30)
    for _ in range(14):
        base = words(rnd, rnd.choice([5, 6, 20, 60, 200]))
        for _ in range(rnd.choice([1, 3, 9])):
            w = list(base)
            for _ in range(rnd.choice([0, 1, 2, 5])):
                w[rnd.randrange(len(w))] = words(rnd, 1)[0].upper()
            rows.append(" ".join(w))
    rows += [" ".join(common + words(rnd, rnd.choice([2, 8, 30]))) for _ in range(60)]  # a passage that many share
    rows += [f"hot pair {w}" for w in words(rnd, 30)]
    rows += ["a b", "A\tb", "a", "A", None, "", " \n"]
    rnd.shuffle(rows)
    ids = [i * 3 + 1 for i in range(len(rows))]
    got = check(spark, list(zip(ids, rows, strict=True)))
    assert sum(not k for *_, k in got) > 20


def test_rows_without_an_id_and_repeated_rows(spark):
    rnd = random.Random(3)
    base = words(rnd, 40)
    near = " ".join([*base[:-1], "xyz"])
    other = words(rnd, 40)
    rows = [(None, near), (4, " ".join(base)), (2, " ".join([*base[:-1], "uvw"])), (4, " ".join(base)), (None, " ".join(other)), (None, " ".join(other[:-1] + ["q"])), (None, None)]
    check(spark, rows)


def test_odd_rows_and_empty_table(spark, odd_docs, no_docs):
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash_join.near_duplicates(odd_docs).collect()), key=str)
    assert got == brute([(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()])
    assert minhash_join.near_duplicates(no_docs).collect() == []


def test_keys_meet_all_signatures_within_the_distance(spark):
    """Pigeonhole: whatever symbols differ, up to the distance a key is shared."""
    rnd = np.random.default_rng(1)
    a = rnd.integers(0, 256, (300, minhash_join.SYMBOLS), dtype=np.uint8)
    b = a.copy()
    for i in range(300):
        at = rnd.permutation(minhash_join.SYMBOLS)[: minhash_join.DISTANCE if i % 3 else 30]
        b[i, at] ^= rnd.integers(1, 256, len(at), dtype=np.uint8)
    # The worst case: every chunk but one has two errors, that one has one.
    b[0] = a[0]
    b[0, [j for c in range(minhash_join.CHUNKS) for j in (4 * c, 4 * c + 1)][:-1]] ^= 7
    name = minhash_join._WORDS
    rows = [tuple(x) for x in np.hstack([a.view("<i8"), b.view("<i8")]).tolist()]
    df = spark.createDataFrame(rows, [f"a_{w}" for w in name] + [f"b_{w}" for w in name]).withColumn("at", F.monotonically_increasing_id())
    x, y = (df.select("at", *(F.col(f"{s}_{w}").alias(w) for w in name)) for s in "ab")
    got = (x.withColumn("keys", minhash_join.chunk_keys()).alias("x").join(y.withColumn("keys", minhash_join.chunk_keys()).alias("y"), "at")
           .select("at", F.arrays_overlap("x.keys", "y.keys").alias("meet"), minhash_join.distance("x", "y").alias("d")).orderBy("at").collect())
    assert [r.d for r in got] == (a != b).sum(1).tolist()
    assert all(r.meet for r in got if r.d <= minhash_join.DISTANCE) and min(r.d for r in got) >= 20


def test_signatures_estimate_the_similarity():
    rnd = np.random.default_rng(2)
    left, right = [], []
    for _ in range(400):
        x = rnd.integers(0, 2**64, 110, dtype=np.uint64)
        left.append(np.unique(x[:100]))
        right.append(np.unique(np.concatenate((x[11:100], x[100:]))))  # 89 of 110
    d = (minhash_join.signatures(left).view(np.uint8) != minhash_join.signatures(right).view(np.uint8)).sum(1)
    assert abs(d.mean() / minhash_join.SYMBOLS - (1 - 89 / 110) * 255 / 256) < 0.015 and d.max() <= minhash_join.DISTANCE

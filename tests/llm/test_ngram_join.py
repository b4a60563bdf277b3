import random
from collections import defaultdict

from pyspark.sql import functions as F

from pitchspark.llm import links, ngram_join

from .conftest import words


def shingle_set(t, k=4):
    w = (t or "").encode().lower().split()
    return frozenset(zip(*(w[i:] for i in range(k)))) if len(w) >= k else frozenset([tuple(w)] if w else [])  # noqa: B905


def brute(rows, percent=85, k=4):
    sets = [shingle_set(t, k) for _, t in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                up[find(i)] = find(j)
    group = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        group[find(i)].append(d)
    return sorted((d, len(sets[i]), min(group[find(i)])) for i, (d, _) in enumerate(rows))


def check(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.similar_documents(df).collect())
    assert got == brute(rows)
    return got


def test_components_equal_brute_force(spark):
    rnd = random.Random(11)
    rows, common = [], words(rnd, 30)
    for _ in range(12):
        base = words(rnd, rnd.choice([6, 20, 60, 200]))
        for _ in range(rnd.choice([1, 3, 9])):
            w = list(base)
            for _ in range(rnd.choice([0, 0, 1, 2, 5])):
                w[rnd.randrange(len(w))] = words(rnd, 1)[0].upper()
            if rnd.random() < 0.3:
                w = w[: rnd.randint(1, len(w))]
            rows.append(" ".join(w))
    rows += [" ".join(common + words(rnd, rnd.choice([2, 8, 30]))) for _ in range(60)]  # a passage that many share
    rows += ["a b c", "A b\tc", "a b", None, "", " \n"]
    rnd.shuffle(rows)
    got = check(spark, [(i * 3 + 1, t) for i, t in enumerate(rows)])
    assert len({c for _, _, c in got}) < len(got) - 20


def test_chain_of_near_copies_is_one_component(spark):
    """Neighbours link, the ends share little: leaders alone would not connect them."""
    rnd = random.Random(12)
    w, rows = words(rnd, 120), []
    for i in range(40):
        rows.append((i, " ".join(w)))
        w[i * 3] = f"new{i}"
    got = check(spark, rows)
    assert {c for _, _, c in got} == {0}


def test_dense_group_below_the_threshold_stays_apart(spark):
    rnd = random.Random(13)
    base, rows = words(rnd, 100), []
    for i in range(60):
        w = list(base)
        for _ in range(6):
            w[rnd.randrange(100)] = f"own{i}x{rnd.random():.3f}"
        rows.append((i, " ".join(w)))
    check(spark, rows)


def test_odd_rows(spark, odd_docs, no_docs):
    rows = ngram_join.similar_documents(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by_id = defaultdict(list)
    for r in rows:
        by_id[r.doc_id].append(r)
    assert [by_id[i][0].component_id for i in (1, 2, 3)] == [1, 2, 3] and by_id[None][0].component_id is None
    assert [r.component_id for r in by_id[5]] == [5, 5]
    assert all(by_id[10 + i][0].component_id == 10 + i % 6 for i in range(18))
    assert ngram_join.similar_documents(no_docs).count() == 0


def test_components_on_random_graphs(spark):
    rnd = random.Random(14)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(180)] + [(500, 500 + i) for i in range(1, 80)] + [(700 + i, 701 + i) for i in range(60)]
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        if a != b:
            up[max(find(a), find(b))] = min(find(a), find(b))
    got = {r.node: r.component for r in links.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in list(up) if find(x) != x}
    assert links.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_every_pair_is_verified_once(spark):
    members = spark.createDataFrame([(k, n) for k in range(5) for n in range(8)], "key long, node long")
    seen = []

    def verify(pairs):
        seen.extend((r.a, r.b) for r in pairs.collect())
        return pairs.where((F.col("a") % 2) == (F.col("b") % 2))

    links.linked(members, [], [], lambda x, y: F.lit(True), verify).collect()
    assert len(seen) == len(set(seen))

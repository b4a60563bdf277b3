"""Fuzzy best-match join equals brute force; no cartesian product."""

import random
import re

from pitchspark.functions import similarity as S
from pitchspark.operators.similarity import fuzzy_best_match


def _norm(s):
    s = re.sub(r"[\x80-\xff]", "", s)
    s = re.sub(r"[^0-9A-Za-zĀ-￿]", " ", s).lower().strip()
    return " ".join(sorted(s.split()))


def _lcs(a, b):
    prev = [0] * (len(b) + 1)
    for ca in a:
        cur = [0]
        for j in range(1, len(b) + 1):
            cur.append(prev[j - 1] + 1 if ca == b[j - 1] else max(prev[j], cur[j - 1]))
        prev = cur
    return prev[-1]


def _score(a, b):
    if not a or not b:
        return 0
    return round(200 * _lcs(a, b) / (len(a) + len(b)))


def _brute(left, right, threshold=85):
    out = {}
    for l in left:
        best = None
        for rk, rv in sorted(right):
            s = _score(_norm(l), _norm(rk))
            if best is None or s > best[0]:
                best = (s, rk, rv)
        out[l] = (best[1], best[0], best[2]) if best and best[0] >= threshold else (None, 0, 0.0)
    return out


def test_fuzzy_equals_brute_force(spark):
    rnd = random.Random(11)
    words = ["lionel", "messi", "kylian", "mbappe", "harry", "kane", "jude", "bellingham", "a", "ab",
             "vinicius", "junior", "son", "heung", "min", "kim", "lee", "park"]
    right = {}
    for _ in range(120):
        name = " ".join(rnd.sample(words, rnd.randint(1, 3)))
        right[name] = right.get(name, 0.0) + rnd.randint(1, 900)
    left = set()
    for name in list(right)[:80]:
        v = rnd.randint(0, 4)
        if v == 0:
            left.add(name)
        elif v == 1:
            left.add(" ".join(reversed(name.split())))
        elif v == 2 and len(name) > 3:
            i = rnd.randrange(len(name))
            left.add(name[:i] + name[i + 1:])
        elif v == 3:
            left.add(name + "-x")
        else:
            left.add("zz" + name[::-1])
    left |= {"a", "b", "", "ab"}
    ldf = spark.createDataFrame([(n,) for n in left], "match_name string")
    rdf = spark.createDataFrame(list(right.items()), "match_name string, minutes double")
    res = fuzzy_best_match(ldf, rdf, "match_name", "match_name", "minutes", 85)
    got = {r.match_name: (r.best_key, r.score, r.value) for r in res.collect()}
    want = _brute(left, right.items())
    assert got == want
    plan = res._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_long_and_short_names_equal_brute_force(spark):
    """Names around a machine word's length and far beyond, one or two letters, and edits of all of them."""
    rnd = random.Random(4)
    base = ["".join(rnd.choice("abcdefgh ") for _ in range(n)).strip() or "a" for n in (1, 2, 3, 4, 5, 61, 62, 63, 64, 65, 200) for _ in range(3)]
    right = {b: float(i) for i, b in enumerate(dict.fromkeys(base))}
    left = set()
    for b in right:
        for _ in range(3):
            x = list(b)
            for _ in range(rnd.choice([0, 1, max(1, len(x) // 12)])):
                x[rnd.randrange(len(x))] = rnd.choice("abcdefgh")
            left.add("".join(x).strip() or "b")
    ldf = spark.createDataFrame([(x,) for x in left], "name string")
    rdf = spark.createDataFrame(list(right.items()), "key string, value double")
    got = {r.name: (r.best_key, r.score, r.value) for r in fuzzy_best_match(ldf, rdf, "name", "key", "value").collect()}
    assert got == _brute(left, right.items())


def test_lanes_equal_the_dynamic_program():
    """Carries over word borders, empty strings, characters beyond 16 bits, many slabs."""
    rnd = random.Random(8)
    say = lambda n, letters: "".join(rnd.choice(letters) for _ in range(n))
    a, b = [], []
    for _ in range(600):
        letters = rnd.choice(["a", "ab", "abcdefgh ", "aé日😀"])
        x = say(rnd.choice([0, 1, 2, 9, 30, 63, 64, 65, 127, 128, 129, 200]), letters)
        y = list(x)
        for _ in range(rnd.choice([0, 1, 5, 20])):
            if y:
                y[rnd.randrange(len(y))] = rnd.choice(["", "a", "b", "ba"])
        a.append(x)
        b.append(rnd.choice(["".join(y), say(rnd.choice([0, 5, 70]), letters)]))
    want = [_lcs(x, y) for x, y in zip(a, b)]
    before = S.SLAB_CHARS
    try:
        for S.SLAB_CHARS in (64, 1000, before):
            assert S.lcs_lengths(a, b).tolist() == want
    finally:
        S.SLAB_CHARS = before
    assert S.lcs_lengths([], []).tolist() == []


def test_keys_meet_every_match_and_hardly_anything_else():
    """Names over a small alphabet: matches share a key, and shared keys do not grow with names x names."""
    import numpy as np

    from pitchspark.operators.similarity import MAX_KEYS, _keys, _meetings
    rnd = random.Random(3)
    name = lambda n: "".join(rnd.choice("0123456789abcdef") for _ in range(n))
    left = [name(n) for n in (13, 14, 19, 24) for _ in range(500)]
    right = [x[:2] + x[3:] for x in left[::5]] + [x[:5] + "z" + x[5:] for x in left[::7]] + [name(14) for _ in range(300)]
    tagged = lambda s: {s[i:i + 2] + str(sum(s[j:j + 2] == s[i:i + 2] for j in range(i))) for i in range(len(s) - 1)}
    grams = [tagged(s) for s in left + right]
    often = {}
    for g in (g for x in grams for g in x):
        often[g] = often.get(g, 0) + 1
    code = {g: i for i, g in enumerate(sorted(often))}
    rare = [[code[g] for g in sorted(x, key=lambda g: (often[g], g))] for x in grams]
    lens = {len(x) for x in left}, {len(x) for x in right}
    lkeys = _keys(left, rare[:len(left)], *_meetings(85, *lens))
    rkeys = _keys(right, rare[len(left):], *_meetings(85, *lens[::-1]))
    assert max(map(len, lkeys)) <= 4 * MAX_KEYS
    holders = {}
    for i, keys in enumerate(lkeys):
        for k in keys.tolist():
            holders.setdefault(k, []).append(i)
    met = [(i, j) for j, keys in enumerate(rkeys) for k in keys.tolist() for i in holders.get(k, ())]
    a, b = zip(*[(x, y) for x in range(len(left)) for y in range(len(right))])
    scores = np.rint(200 * np.array(S.lcs_lengths([left[i] for i in a], [right[j] for j in b])) / np.array([len(left[i]) + len(right[j]) for i, j in zip(a, b)]))
    matches = {(i, j) for i, j, s in zip(a, b, scores) if s >= 85}
    assert len(matches) > 600 and matches <= set(met)
    others = set(met) - matches
    assert len(others) < 0.02 * len(left) * len(right)  # before the character parities, the longer names' bigrams
    assert not [1 for i, j in others if max(len(left[i]), len(right[j])) <= 14]


def test_keys_the_other_side_lacks_make_no_rows(spark):
    import numpy as np
    from pyspark.sql import functions as F

    from pitchspark.operators import similarity as sim
    names = [(f"{i:06x} {i * 7919 % 99991:07d}",) for i in range(400)]
    plan = sim._meetings(85, [14], [14])
    none = F.lit(None).cast("array<bigint>")
    df = spark.createDataFrame(names, "name string")
    few = df.where("name < '00000a'").select(F.explode(sim._key_column("name", none, plan, None)).alias("key"))
    words = sim._key_map(few)
    known = np.array([r.key for r in few.collect()], np.int64).view(np.uint64)
    assert len(known) and sim._on_map(words, known).all()
    assert sim._on_map(words, np.random.default_rng(1).integers(0, 2**64 - 1, 10_000, np.uint64)).mean() < 0.01
    every = {r.name: set(r.k) for r in df.select("name", sim._key_column("name", none, plan, None).alias("k")).collect()}
    met = {r.name: set(r.k) for r in df.select("name", sim._key_column("name", none, plan, spark.sparkContext.broadcast(words)).alias("k")).collect()}
    wanted = set(known.view(np.int64).tolist())
    assert all(every[n] & wanted <= met[n] <= every[n] for n in every)
    assert sum(map(len, met.values())) < sum(map(len, every.values())) / 2

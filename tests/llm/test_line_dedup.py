import random

import numpy as np
from pyspark.sql import functions as F

from pitchspark.llm import common
from pitchspark.llm import line_dedup as ld
from pitchspark.llm.common import written
from pitchspark.llm.links import components, linked

from .conftest import words


def sets(line, k=ld.SHINGLE):
    return {line[i : i + k] for i in range(len(line) - k + 1)} if len(line) >= k else {line}


def brute(rows, percent=ld.PERCENT):
    """All pairs of lines by exact similarity; the first of each component stays."""
    lines = [(d, n, x) for d, t in rows for n, x in ld.lines_of(t)]
    nodes = sorted({x for _, _, x in lines})
    up = {x: x for x in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    of = {x: sets(x) for x in nodes}
    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            both = len(of[a] & of[b])
            if both and 100 * both >= percent * (len(of[a]) + len(of[b]) - both):
                up[find(a)] = find(b)
    first = {}
    for d, n, x in sorted(lines):
        first.setdefault(find(x), (d, n))
    return {(d, n) for d, n, x in lines if first[find(x)] != (d, n)}


def corpus(seed, docs=150):
    rnd = random.Random(seed)
    base = [" ".join(words(rnd, rnd.choice([2, 12, 40]))) for _ in range(30)]
    rows = []
    for i in range(docs):
        lines = []
        for _ in range(rnd.randint(1, 5)):
            x = list(rnd.choice(base)) if rnd.random() < 0.6 else list(" ".join(words(rnd, 20)))
            for _ in range(rnd.choice([0, 0, 1, 2])):
                x[rnd.randrange(len(x))] = rnd.choice("é日z")
            lines.append("".join(x))
        if rnd.random() < 0.3:
            lines.insert(1, "  ")
        rows.append((i, "\n".join(lines)))
    return rows


def test_lines_dropped_equal_brute_force(spark):
    found = wanted = 0
    for seed in (1,):
        rows = corpus(seed)
        got = {(r.doc_id, n) for r in ld.dropped_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect() for n in r.dropped}
        want = brute(rows)
        assert got <= want  # verified exactly: nothing is dropped wrongly
        found, wanted = found + len(got), wanted + len(want)
    assert wanted > 100 and found >= 0.98 * wanted


def test_recall_of_the_bands_near_the_threshold():
    rnd = random.Random(3)
    hit = total = 0
    for _ in range(300):
        a = " ".join(words(rnd, 40))
        b = list(a)
        for _ in range(2):
            b[rnd.randrange(len(b))] = "é"
        b = "".join(b)
        x, y = sets(a), sets(b)
        if len(x & y) / len(x | y) >= 0.8:
            total += 1
            keys = ld.Shingles([a, b]).bands()
            hit += bool((keys[0] == keys[1]).any())
    assert total > 100 and hit / total > 0.97


def test_recall_and_candidates_at_all_line_lengths():
    """Links share a key at every length; short lines with little in common do not."""
    rnd = random.Random(8)
    for n in (12, 16, 24, 50, 120, 300):
        lines, pairs = [], []
        while len(pairs) < 400:
            a = "".join(rnd.choice("abcdefghij ") for _ in range(n))
            b = a[: n - 1 - rnd.randrange(max(1, n // 12))] + ("" if n < 30 else "é")
            x, y = sets(a), sets(b)
            if 0.8 <= len(x & y) / len(x | y) < 1:
                pairs.append((len(lines), len(lines) + 1))
                lines += [a, b]
        keys = ld.Shingles(lines).bands()
        hit = [bool((keys[i] == keys[j]).any()) for i, j in pairs]
        assert sum(hit) >= 0.975 * len(hit), (n, sum(hit))
    for n in (12, 16, 24, 40):  # lines that share one shingle of several
        lines = ["template" + "".join(rnd.choice("abcdefghij") for _ in range(n - 8)) for _ in range(400)]
        keys = ld.Shingles(lines).bands()
        met = sum(int((keys[i] == keys[:i]).any(axis=1).sum()) for i in range(400))
        assert met < 0.02 * 400 * 399 / 2, (n, met)


def test_rows_stay_as_many_with_repeated_ids(spark):
    rows = [(1, "same line here today\nfirst of all"), (1, "same line here today\nother things"), (1, None), (None, "same line here today"), (None, "own line")]
    out = [r.text for r in ld.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").withColumn("llm_row", F.lit(0))).collect()]
    # Null ids come first: theirs stays.
    assert sorted(map(str, out)) == sorted(["first of all", "other things", "None", "same line here today", "own line"])


def test_lines_of_null_and_repeated_ids_are_verified_on_their_own_text(spark):
    rnd = random.Random(6)
    say = lambda: " ".join(words(rnd, 40))
    near = lambda x: x[:80] + "é" + x[81:]
    shared, lone, *own = (say() for _ in range(8))
    rows = [(None, shared), (1, shared), (2, near(shared)), (None, lone), (3, "first\n" + near(lone))]
    rows += [(7, x) for x in own] + [(20 + i, near(x)) for i, x in enumerate(own)]  # one id, six texts
    got = ld.dropped_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = {1: [0], 2: [0], 3: [1], **{20 + i: [0] for i in range(6)}}
    assert sorted((r.doc_id or 0, r.dropped) for r in got) == sorted((d or 0, want.get(d, [])) for d, _ in rows)


def test_clean_text_and_odd_rows(spark, odd_docs, no_docs):
    df = spark.createDataFrame([(1, "Same line here today\n\nonly one"), (2, "other words\nsame  LINE here today"), (3, None), (4, "")], "doc_id long, text string")
    out = {r.doc_id: r.text for r in ld.dedup_lines(df).collect()}
    assert out == {1: "Same line here today\n\nonly one", 2: "other words", 3: None, 4: ""}
    rows = ld.dropped_lines(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert sorted(len(r.dropped) for r in rows if r.doc_id == 5) == [0, 1]
    assert all(r.n_lines == 0 for r in rows if r.doc_id in (1, 2, 3))
    assert all(len(r.dropped) == (r.doc_id >= 16) for r in rows if (r.doc_id or 0) >= 10)
    assert ld.dropped_lines(no_docs).count() == 0 and ld.dedup_lines(odd_docs.where(F.col("doc_id") > 9)).columns == odd_docs.columns


def test_maps_of_numbers_miss_none(spark):
    numbers = [random.Random(9).getrandbits(63) - (1 << 62) for _ in range(3000)]
    words_ = common.number_map(spark.createDataFrame([(x,) for x in numbers], "n long").repartition(5))
    assert common.on_map(words_, np.array(numbers)).all()
    assert common.on_map(words_, np.arange(100_000)).mean() < 0.1
    assert not common.on_map(common.number_map(spark.range(0)), np.arange(100)).any()


def test_keys_that_several_lines_share(spark):
    """A key that one line has in several tasks is not shared; keys and nodes travel in blocks, not row by row."""
    rnd = random.Random(10)
    rows = [(i, "\n".join("".join(rnd.choice("ab") for _ in range(12)) for _ in range(3))) for i in range(90)] + [(900 + i, "one line of many tasks") for i in range(9)] + [(990, None), (991, "short")]
    per_row = ld.line_nodes(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)).persist()
    of = {}
    for x in {x for _, t in rows for _, x in ld.lines_of(t) if len(x) >= ld.SHINGLE}:
        for k in ld.Shingles([x]).bands().view(np.int64)[0].tolist():
            of.setdefault(k, set()).add(x)
    want = {k for k, x in of.items() if len(x) > 1}
    got = [r.key for r in ld.shared_keys(per_row).collect()]
    assert len(got) == len(set(got)) and set(got) == want and want
    members = {(r.key, r.node) for r in ld.band_members(per_row).collect()}
    node = lambda x: int(ld.whole_hashes([x]).view(np.int64)[0])
    assert members == {(k, node(x)) for k in want for x in of[k]}
    per_row.unpersist()


def test_few_open_pairs_are_compared_at_once(spark):
    """The same components with fewer rounds, each of which is a job over all open members."""
    rnd = random.Random(12)
    rows = [(k, n) for k in range(30) for n in rnd.sample(range(100), 6)]
    members = written(spark.createDataFrame(rows, "key long, node long"), "t-members")
    out, asked = [], []
    for few in (0, 50):
        calls = []
        links = linked(members, [], [], lambda x, y: F.lit(True), lambda p: (calls.append(1), p.where("(a + b) % 7 = 0"))[1], few=few)
        out.append(sorted(map(tuple, components(links).collect())))
        asked.append(len(calls))
    assert out[0] == out[1] and out[0] and asked[1] == 2 < asked[0]

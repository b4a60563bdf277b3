import hashlib
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from pitchspark.llm import mixing
from pitchspark.llm.common import word_count, written


def mix(df):
    sized = written(df.select("doc_id", "source", word_count(F.col("text")).alias("size"), mixing.id_hash(F.col("doc_id")).alias("hash")), "t-sized")
    rows = sized.select("doc_id", "size", F.col("source").alias("mix_source"), F.col("hash").alias("mix_hash"))
    return mixing.times(rows, mixing.plan_mix(sized)).collect()


def brute_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, target, open_ = sum(sizes.values()), {}, set(order)
    while open_:
        left = total - sum(target.values())
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > 3 * sizes[s]}
        if not over:
            target |= {s: level * weight[s] for s in open_}
            break
        target |= {s: 3.0 * sizes[s] for s in over}
        open_ -= over
    return target


@pytest.mark.parametrize("seed", range(3))
def test_targets_and_selection_by_brute_force(spark, seed):
    rnd = random.Random(seed)
    sources = ["a", "B", "é", None, "zz"]
    rows = [(i if i % 50 else None, "w " * rnd.choice([0, 1, 5, 40]), rnd.choices(sources, [50, 3, 1, 10, 20])[0]) for i in range(900)]
    rows += rows[10:13]
    got = mix(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    sizes, docs = defaultdict(int), defaultdict(lambda: defaultdict(int))
    for i, t, s in rows:
        h = int(hashlib.md5(("" if i is None else str(i)).encode()).hexdigest()[:15], 16)
        sizes[s] += len(t.split())
        docs[s][h] += len(t.split())
    target = brute_targets(sizes)
    taken, times = defaultdict(int), {}
    for r in got:
        assert r.times in (0, 1, 2, 3) and r.target == pytest.approx(target[r.mix_source]) and r.source_size == sizes[r.mix_source]
        taken[r.mix_source] += r.size * r.times
        times[r.mix_source, r.mix_hash] = r.times
    for s in sizes:
        whole = int(target[s] // sizes[s]) if sizes[s] else 0
        rest, run = target[s] - whole * sizes[s], 0
        for h in sorted(docs[s]):
            more = docs[s][h]
            take = run + more <= rest or (run <= rest < run + more and run + more - rest < rest - run)
            if more:
                assert times[s, h] == whole + (take if run <= rest else 0), (s, h)
            run += more
        assert abs(taken[s] - target[s]) <= max(docs[s].values(), default=0)


def test_nested_budgets(spark):
    sized = written(spark.range(2000).select(F.lit("s").alias("source"), F.lit(3).cast("long").alias("size"), mixing.id_hash(F.col("id")).alias("hash")), "t-nest")
    below = [mixing.thresholds(sized, spark.createDataFrame([("s", b)], "source string, rest double")).first().below for b in (300.0, 1500.0, 4000.0)]
    assert below == sorted(below)
    assert [abs(sized.where(F.col("hash") < b).count() * 3 - g) <= 3 for b, g in zip(below, (300, 1500, 4000), strict=True)] == [True] * 3


def test_odd_rows(odd_docs, no_docs):
    assert len(mix(odd_docs)) == odd_docs.count()
    assert mix(no_docs) == []
    assert not re.search("Python|Arrow|Pandas", mixing.targets(odd_docs.select("source", F.lit(1).cast("long").alias("size")))._jdf.queryExecution().toString())

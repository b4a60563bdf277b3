import os
import random

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from pitchspark.llm import decontaminate, pipeline, quality_model
from pitchspark.llm.oracle import ORACLE_SQL

from . import test_mixing, test_ngram_join, test_token_ids
from .conftest import DOCS, SMALL, words


def test_stages_by_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    model = quality_model.fit_quality(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
    score = dict(zip(rows, model.score(quality_model.statistics([r.text.encode() for r in rows.values()])), strict=True))
    left = {i for i in rows if score[i] >= 0.3}
    left = {d for d, _, c in test_ngram_join.brute([(i, rows[i].text) for i in sorted(left)], percent=80, k=5) if d == c}
    items = [(r.item_id, r.text.encode()) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    leaks = dict(zip(sorted(left), decontaminate.ItemIndex(items).leaks([rows[i].text.encode() for i in sorted(left)]), strict=True))
    left = {i for i in left if not leaks[i]}
    mixed = test_mixing.mix(spark.createDataFrame([rows[i] for i in sorted(left)], docs.schema))
    times = {r.doc_id: r.times for r in mixed}
    want = test_token_ids.brute([(i, rows[i].text) for i in sorted(left) for _ in range(times[i])])
    got = corpus_pipeline.run(spark, SMALL).collect()
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got) == [x[:4] for x in want]
    assert 0 < len(left) < len(rows)


def test_near_copies_at_five_words_and_80_percent(spark):
    rnd = random.Random(8)
    rows = []
    for n in (30, 44, 45, 46, 48, 49, 50, 60, 120, 400):  # one changed word in the middle: five words and 80 % link from 45 words on
        base = words(rnd, n)
        rows += [base, [*base[: n // 2], "edit", *base[n // 2 + 1 :]], base[: n - n // 6]]
    rows = [(i, " ".join(w)) for i, w in enumerate(rows)]
    sets = [frozenset(zip(*(w[j:] for j in range(5)))) for w in (t.split() for _, t in rows)]  # noqa: B905
    up = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                low, high = sorted((up[i], up[j]))
                up = [low if u == high else u for u in up]
    want = {i for i, u in enumerate(up) if i == u}
    docs = spark.createDataFrame([(i, t, "en", "a", 0) for i, t in rows], DOCS)
    assert {r.doc_id for r in pipeline.ngram_jaccard(spark, docs, SMALL).collect()} == want
    assert want < {d for d, _, c in test_ngram_join.brute(rows) if d == c}


def test_stages_keep_columns_and_odd_rows(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for name, stage in pipeline.STAGES[:-1]:
            out = stage(spark, docs, SMALL)
            assert out.columns == docs.columns, name
            out.count()
        assert pipeline.STAGES[-1][1](spark, docs, SMALL).count() == docs.count()
    kept = pipeline.ngram_jaccard(spark, odd_docs, SMALL).collect()
    assert sorted(r.doc_id or 0 for r in kept) == [0, 1, 2, 3, 4, 5, 6, 7, *range(10, 16)]


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "benchmark", "embeddings"):
        con.execute(f"create view {t} as select * from read_parquet('{os.path.join(SMALL, t)}.parquet')")
    rel = con.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in rel.description]
    same = lambda rows: sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows), key=repr)
    df = entry.queries()[name](spark, SMALL)
    assert sorted(df.columns) == sorted(columns)
    assert same(tuple(r[c] for c in columns) for r in df.collect()) == same(rel.fetchall())

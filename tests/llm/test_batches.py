"""What a Python worker holds at once is bounded in bytes, not in rows."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pitchspark.llm import common, decontaminate, ngram_join, quality_model


def test_batches_to_workers_are_bounded_in_bytes(spark):
    common.ready(spark)
    rows = spark.range(0, 6000, 1, 1).select("id", F.repeat(F.lit("word "), 800).alias("text"))  # 24 MB in one partition

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], ["n", "bytes"])

    found = rows.mapInArrow(sizes, "n long, bytes long").collect()
    assert sum(r["n"] for r in found) == 6000
    assert max(r["bytes"] for r in found) <= (8 << 20) + 10_000  # the row that reaches the limit

    @F.arrow_udf("long")
    def rows_at_once(column):
        return pa.array([len(column)] * len(column), pa.int64())

    assert rows.select(rows_at_once("text").alias("n")).agg(F.max("n")).first()[0] <= (8 << 20) // 4000 + 1


TEXTS = [f"The item {i} has words, as many as it takes. " .encode() * 20 for i in range(700)] + [b"", b"one"]


@pytest.mark.parametrize("module", [quality_model, decontaminate, ngram_join])
def test_words_are_found_in_small_chunks(module, monkeypatch):
    seen = []

    class Seen(common.Words):
        def __init__(self, texts, *args):
            super().__init__(texts, *args)
            seen.append(len(self.data))

    def work():
        if module is quality_model:
            return quality_model.statistics(TEXTS)
        if module is decontaminate:
            return index.leaks(TEXTS)
        return [s for _, sets in ngram_join._sets(pa.RecordBatch.from_arrays([pa.array(TEXTS).cast(pa.string())], ["t"]), 0, 5) for s in sets]

    index = decontaminate.ItemIndex([(1, TEXTS[7][:200]), (2, b"nothing of the kind stands in any of these texts")])
    monkeypatch.setattr(module, "Words", Seen)
    monkeypatch.setattr(common, "_POWERS", [np.ones(1, np.uint64), np.ones(1, np.uint64)])
    small = work()
    assert sum(map(len, TEXTS)) > 1 << 19
    assert max(seen) <= 1.1 * (1 << 18)
    assert common._POWERS[0].nbytes <= 4 << 20
    monkeypatch.setattr(module, "WORDS_BYTES", 1 << 30, raising=False)  # all at once: the same results
    large = work()
    if module is decontaminate:
        assert small == large and any(small)
    else:
        assert all(np.array_equal(a, b) for a, b in zip(small, large, strict=True))


def test_powers_serve_chunks_of_each_size(monkeypatch):
    monkeypatch.setattr(common, "_POWERS", [np.ones(1, np.uint64), np.ones(1, np.uint64)])
    for n in (10, 1 << 18, 330_000, 100, 1 << 20, 1_120_000, 5 << 20):
        power, inverse = common.powers(n)
        assert min(len(power), len(inverse)) >= n and (power[:n] * inverse[:n] == 1).all()

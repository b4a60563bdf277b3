import random

import pytest
from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and very long texts, ties and repeated rows, clashing and extra columns."""
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 6)))
    long = " ".join(word() for _ in range(30_000))
    rows = [(1, None, "en", "a", 0), (2, "", None, None, None), (3, " \n\t ", "en", "a", 3), (None, "no id here", "en", "b", 10), (4, long, "de", "b", None),
            (5, "one two three", "en", None, 1), (5, "one two three", "en", None, 1), (6, "ünï çödé 日本語 😀 text", "fr", "c", 9), (7, "x" * 70_000, "en", "a", 1)]
    base = [" ".join(word() for _ in range(60)) for _ in range(6)]
    rows += [(10 + i, base[i % 6], "en", "abc"[i % 3], i) for i in range(18)]
    # Columns named like the operators' results and helpers.
    return (spark.createDataFrame(rows, DOCS).withColumn("score", F.lit("mine")).withColumn("node", F.lit(1)).withColumn("key", F.lit("k"))
            .withColumn("size", F.lit(-1)).withColumn("secrets", F.lit(0)).withColumn("stats", F.lit(0)).withColumn("leaks", F.lit(0)).withColumn("hash", F.lit(0)))


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def words(rnd, n, letters="abcdefghijkl"):
    return [rnd.choice(letters) + rnd.choice(letters) + rnd.choice(letters) for _ in range(n)]

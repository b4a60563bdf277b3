"""A training-data pipeline of five operators over ``documents``.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns the rows that go on. ``run`` writes every stage's rows as Parquet in
the shared folder and reads them again as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pitchspark.llm.common import ready, written
from pitchspark.llm.pipeline import ORACLE_SQL, STAGES  # noqa: F401


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)

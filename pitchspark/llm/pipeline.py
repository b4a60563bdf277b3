"""The stages of ``corpus_pipeline.py``; each takes (spark, docs, sf_dir) and returns the rows that go on.

All but the last return exactly the columns of ``docs``. Helper columns carry
the prefix ``llm_`` and an ending that ``docs`` does not use, so clashing names
do no harm. Null and empty texts go through every stage by the rules of its
operator; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, mixing, ngram_join, quality_model
from .common import ready, small, word_count, written
from .queries import tokens_of

LEAST_QUALITY = 0.3
#: Near copies as a stage takes them; op7 alone keeps its own four words and 85 %.
NEAR_SHINGLE, NEAR_PERCENT = 5, 80


def _free(docs: DataFrame, name: str) -> str:
    while name in docs.columns:
        name += "_"
    return name


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores 0.3 or more; it is fitted on the labelled ones that are not held out."""
    ready(spark)
    model = quality_model.fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = _free(docs, "llm_score")
    return quality_model.score_quality(docs, model, out=score).where(F.col(score) >= LEAST_QUALITY).select(docs.columns)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked at five words and 80 %: that with the smallest id.

    Rows that repeat an id are one document, of which one row stays; rows
    without an id link with nothing and stay.
    """
    ready(spark)
    found = ngram_join.similar_documents(docs.select("doc_id", "text"), k=NEAR_SHINGLE, percent=NEAR_PERCENT)
    # Only ids that must go, or of which there are several rows, travel to the texts.
    ids = written(found.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("llm_id"))
                  .agg(F.min("component_id").alias("llm_keep"), F.count(F.lit(1)).alias("llm_rows"))
                  .where((F.col("llm_keep") != F.col("llm_id")) | (F.col("llm_rows") > 1)), "dropped-ids")
    gone = docs.join(small(ids.select("llm_id")), docs["doc_id"] == F.col("llm_id"), "left_anti")
    again = ids.where((F.col("llm_keep") == F.col("llm_id")) & (F.col("llm_rows") > 1)).select("llm_id")
    if not again.take(1):
        return gone
    return gone.unionByName(docs.join(small(again), docs["doc_id"] == F.col("llm_id"), "left_semi").dropDuplicates(["doc_id"]))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    ready(spark)
    leaks = _free(docs, "llm_leaks")
    marked = decontaminate.find_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), out=leaks)
    return marked.where(F.size(leaks) == 0).select(docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it (0 to 3 times)."""
    ready(spark)
    sized = written(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), mixing.id_hash(F.col("doc_id")).alias("hash")), "mix-sized")
    plan = mixing.plan_mix(sized)
    # Row by row next to the documents: a hash and a look-up in one row per source.
    names = [f"llm_{i}" for i in range(len(docs.columns))]
    rows = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names, strict=True)),
                       F.col("source").alias("mix_source"), mixing.id_hash(F.col("doc_id")).alias("mix_hash"))
    taken = mixing.times(rows, plan).withColumn("llm_copy", F.explode(F.array_repeat(F.lit(1), F.col("times").cast("int"))))
    return taken.select(*(F.col(n).alias(c) for c, n in zip(docs.columns, names, strict=True)))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token files' rows: doc_id, start, n_tokens, ids_crc32."""
    ready(spark)
    return tokens_of(docs.select("doc_id", "text"))


STAGES = [("quality", quality), ("ngram_jaccard", ngram_jaccard), ("decontaminate", decontaminated), ("mix", mixed), ("tokens", tokens)]

#: SQL has neither the classifier nor the tokenizer; tests hold the pipeline against brute force.
ORACLE_SQL = None

"""The registered queries of the operators: each applies one to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, hard_negatives, line_dedup, minhash_join, mixing, ngram_join, quality_model, quality_rules, secrets, token_ids, toxicity, warc, whitening
from .common import held_out, shared_path, table, word_count, written


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.find_secrets(docs)
    base = [r.kind for r in secrets.BASE]

    def joined(spans):
        return F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))))

    def of(kind):
        return F.size(F.filter("secrets", lambda x: x["kind"] == kind)).cast("long")

    return found.select("doc_id", *(of(k).alias(f"n_{k}") for k in base),
                        F.sha2(joined(F.filter("secrets", lambda x: x["kind"].isin(base))), 256).alias("base_sha256"),
                        joined(F.col("secrets")).alias("spans"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return (toxicity.score_toxicity(docs, model)
            .select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_model.fit_quality(docs, table(spark, sf_dir, "labels"))
    return (quality_model.score_quality(docs, model)
            .select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    stats = quality_rules.apply_cascade(docs, quality_rules.fit_cascade(docs))
    failed = quality_rules.base_failed(F.col("stats"))
    return stats.select("doc_id", *(f"stats.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
                        failed.alias("base_failed"), (~failed & F.col("stats.rejected_by").isNull()).alias("kept"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "warc")
    warc.write_archive(table(spark, sf_dir, "pages"), path)
    records = written(warc.with_facts(warc.read_records(spark, path), keep_payload=False), "warc-records")
    captures = written(warc.assemble(records), "warc-captures")
    page_id = F.filter(F.flatten(F.transform("metadata", lambda m: m["fields"])), lambda f: f["key"] == "page_id")[0]["value"].cast("long")
    # An archived response's page, for the revisits that refer to it.
    pages = captures.where("type = 'response'").groupBy(F.col("record_id").alias("to_id")).agg(F.min(page_id).alias("to_page"))
    wanted = captures.where("type = 'revisit'").select(F.col("refers_to").alias("to_id")).distinct()
    return (captures.join(pages.join(wanted, "to_id", "left_semi"), captures["refers_to"] == F.col("to_id"), "left")
            .select(page_id.alias("page_id"), "payload_bytes", F.col("payload_sha256").alias("payload_digest"), F.col("type").alias("record_type"),
                    F.col("to_page").alias("refers_to")))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark")).select("doc_id", F.explode("leaks").alias("leak"))
    return found.select("doc_id", "leak.item_id", "leak.overlap", "leak.question_overlap", "leak.answer_overlap", "leak.score", "leak.first_word")


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return ngram_join.similar_documents(docs).select("doc_id", "n_shingles", "component_id")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return (line_dedup.dropped_lines(docs)
            .select("doc_id", "n_lines", F.size("dropped").cast("long").alias("n_dropped"), F.array_join("dropped", ",").alias("dropped_lines")))


def op9_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens_of(table(spark, sf_dir, "documents").select("doc_id", "text"))


def tokens_of(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json") -> DataFrame:
    """Write the documents' token files in the shared folder and return what reading them back gives."""
    import public_tokenizers

    path = public_tokenizers.path(tokenizer)
    ids = written(token_ids.encode_ids(docs, path, keep=["doc_id"], counts="counts"), "token-ids")
    folder = shared_path(docs.sparkSession, "token-files")
    token_ids.write_tokens(ids, folder, token_ids.id_kind(path), counts="counts")
    return token_ids.read_tokens(docs.sparkSession, folder)


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sized = written(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), mixing.id_hash(F.col("doc_id")).alias("hash")), "mix-sized")
    rows = sized.select("doc_id", "size", F.col("source").alias("mix_source"), F.col("hash").alias("mix_hash"))
    return (mixing.times(rows, mixing.plan_mix(sized))
            .select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken")))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


def op12_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_join.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened_embeddings(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_secret_scan, op2_toxicity, op3_quality_classifier, op4_quality_rules, op5_warc, op6_decontaminate,
    op7_ngram_jaccard, op8_line_dedup, op9_token_ids, op10_mix_sources, op11_hard_negatives, op12_minhash_near_dedup, op13_embedding_whitening,
)}

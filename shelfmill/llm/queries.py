"""Registered queries of the operators, with the digest columns they return."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmill.llm import bpe, chat, decontaminate, hard_negatives, jaccard_join, language, pii, quality_rules, simhash, substrings, subword_classifier, token_alignment, toxicity, training
from shelfmill.session import tune


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"), "contaminated")


def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    fields = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return documents.select("doc_id", quality_rules.quality("text").alias("q")).select("doc_id", *[f"q.{f}" for f in fields])


def digest_ids(ids: str):
    return F.sha2(F.concat_ws(",", F.col(ids).cast("array<string>")), 256)


def bpe_digests(documents: DataFrame) -> DataFrame:
    codec = bpe.Codec(documents.sparkSession)
    coded = codec.decode(codec.encode(documents))
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), digest_ids("ids").alias("ids_sha256"), F.sha2("raw", 256).alias("decoded_sha256"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(table(spark, sf_dir, "documents"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents"), texts=False).drop("kept")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = table(spark, sf_dir, "documents").select("doc_id", pii.spans("text").alias("s"))
    kinds = [kind.name for kind in pii.BASIC_KINDS]
    counts = [F.size(F.filter(F.col("s.kind"), lambda x: x == F.lit(k))).cast("long").alias(f"n_{k}") for k in kinds]
    base = pii.listed(F.filter("s", lambda x: x.basic))
    return found.select("doc_id", *counts, F.sha2(base, 256).alias("base_sha256"), pii.listed(F.col("s")).alias("spans"))


HARD_TURN = r"\### Assistant: </turn> ok"


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    hard = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit(HARD_TURN).alias("text"))
    chats = chat.format_chats(rows.unionByName(hard))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    loss = chat.loss_text(F.col("formatted"), F.col("loss_spans"))
    return chats.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))


QUALITY_FOLD = training.Fold(modulus=3, remainder=1)


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subword_classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "quality", QUALITY_FOLD)


TOXIC_FOLD = training.Fold(modulus=4, remainder=2)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.rate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "toxic", TOXIC_FOLD).drop("evidence")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    turned = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors.withColumn("label", turned), F.col("vec_id") % 100 == 0)


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align(table(spark, sf_dir, "documents"))


def op13_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)  # small Arrow batches: rows with whole sets are large
    return jaccard_join.similar_texts(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_toxicity": op2_toxicity,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_chat_format": op4_chat_format,
    "op5_simhash_dedup": op5_simhash_dedup,
    "op6_pii": op6_pii,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_quality_rules": op8_quality_rules,
    "op9_language_id": op9_language_id,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_token_alignment": op12_token_alignment,
    "op13_ngram_jaccard_join": op13_ngram_jaccard_join,
}

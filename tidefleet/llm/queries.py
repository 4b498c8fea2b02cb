"""The registered queries of the text operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidefleet.llm import decontaminate, filter_audit, html_blocks, importance, license_scan, line_dedup, oracles, quality_classifier, quality_rules, sentencepiece_bpe, simhash, token_files, toxicity, url_filter
from tidefleet.llm.common import new_folder, table, vocabulary


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "tokens")
    token_files.write(table(spark, sf_dir, "documents"), path, vocabulary("word_bpe_49k.json"))
    return token_files.checksums(token_files.read(spark, path))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_blocks.extract(table(spark, sf_dir, "pages"))


def sentencepiece_digest(encoded: DataFrame, *more: str) -> DataFrame:
    """Counts and digests of ids and decoded texts, and further columns of encoded."""
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"), *more)


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_digest(sentencepiece_bpe.encode_decode(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model")), "n_differing")


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.clean(table(spark, sf_dir, "documents"))
    return cleaned.select("row.doc_id", F.col("dropped").cast("long").alias("n_dropped"), "row.text")


def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    outcomes = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), F.col("quality").alias("good"))
    found = url_filter.judge(table(spark, sf_dir, "pages"), outcomes)
    return found.select("page_id", "host", "path", "rule", "verdict", F.round("posterior", 6).alias("posterior"), F.round("bound", 6).alias("bound"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents")).drop("found").withColumn("score", F.round("score", 6))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_token_files, op2_quality_rules, op3_html_blocks, op4_sentencepiece, op5_quality_classifier, op6_line_dedup, op7_simhash_dedup, op8_url_filter, op9_decontaminate, op10_toxicity, op11_license_scan, op12_importance_resampling, op13_filter_audit)}


def oracle_sql() -> dict[str, str]:
    """Tokenizers, hashes of other kinds and trained models are beyond SQL; tests hold those against brute force."""
    return {"op6_line_dedup": oracles.OP6, "op8_url_filter": oracles.OP8, "op9_decontaminate": oracles.OP9, "op11_license_scan": oracles.OP11, "op12_importance_resampling": oracles.OP12, "op13_filter_audit": oracles.OP13}

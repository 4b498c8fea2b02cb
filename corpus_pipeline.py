"""The corpus pipeline: stages over documents, each written and read again before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidefleet.llm import decontaminate, line_dedup, quality_rules, sentencepiece_bpe, simhash
from tidefleet.llm.common import delete, new_folder, table, temporary_tables, vocabulary
from tidefleet.llm.queries import sentencepiece_digest


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go.

    Null and empty texts have too few words and go, as does junk of any length;
    repeated rows fare alike; an empty table stays empty; columns stay as they
    are, whatever their names.
    """
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The boilerplate lines of each source go from its texts; all rows stay.

    n_chars is counted anew where a text changed. Null texts stay null; null
    sources are one source, with the empty one; repeated rows count as one page
    and are cleaned alike; an empty table stays empty.
    """
    return line_dedup.without_boilerplate(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that of the smallest id.

    Null and empty texts are one group; repeated rows are one document; rows
    without an id stay only where their group has no id; an empty table stays
    empty; columns stay as they are.
    """
    return simhash.drop_near_duplicates(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go.

    Null and empty texts hold none and stay; repeated rows fare alike; an empty
    table stays empty; columns stay as they are.
    """
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def sentencepiece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left (column ids), with the counts and digests that op4 gives.

    Null and empty texts have no ids; texts of any length are encoded whole;
    repeated rows and null ids get a row each; an empty table gives none.
    """
    return sentencepiece_digest(sentencepiece_bpe.encode_decode(docs, vocabulary("piece_bpe_32k.model")), "n_differing", "ids")


STAGES = [
    ("quality rules", quality_stage),
    ("line dedup", line_stage),
    ("simhash near-dedup", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("sentencepiece", sentencepiece_stage),
]

#: The forest, the fingerprints' components and the tokenizer can't be written in SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir; what a stage and its operators wrote is deleted once the next one has been written."""
    docs, before = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES:
        path = new_folder(spark, "pipeline")
        with temporary_tables(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            delete(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs

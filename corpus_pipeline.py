"""A corpus pipeline of four operators: quality rules, n-gram Jaccard join, secret scans, packing.

Every stage takes all that its predecessor kept. The first three return the columns of `documents`; the last returns the
packed pieces. Each stage's result is written as Parquet in the shared folder and read again for the next.

Defined cases, in every stage: null ids, texts and other columns stay as they are; columns may have any names, and those beside
doc_id, text and n_chars only pass through; an empty table gives an empty result; texts of any length are worked on whole.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import ngram_join, packing, quality_rules, secret_scan
from tidemark.llm.shared import table, written


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep. Null and blank texts go; repeated rows are judged alike."""
    judged = quality_rules.judge(docs.select(F.struct("*").alias("row"), F.col("text").alias("judged")), text="judged")
    return judged.where("kept").select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones, that of the smallest doc_id; of repeated rows one stays."""
    return ngram_join.deduplicated(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with secrets replaced by a mark; n_chars follows. Overlapping secrets share one mark."""
    redacted = secret_scan.redact(docs)
    return redacted.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else redacted


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 4096 tokens; repeated rows are packed each for itself."""
    return packing.pack(docs, packing.Packing(public_tokenizers.path("word_bpe_49k.json")))


STAGES = [("quality rules", keep_good), ("n-gram Jaccard join", drop_near_copies), ("secret scans", redact_secrets), ("packing", pack)]

#: Packing has no form in SQL; tests/llm/test_pipeline.py holds each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the table `documents`."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs, f"stage-{i + 1}")
    return docs

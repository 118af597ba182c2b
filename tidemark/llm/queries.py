"""The registered queries of this subpackage: each applies its operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import bpe, chat, conversation_trie, hard_negatives, html_extract, media, ngram_join, oracles, packing, piece_bpe, quality_rules, secret_scan, url_filter, warc
from tidemark.llm.shared import table


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.components(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), packing.Packing(public_tokenizers.path("word_bpe_49k.json")))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.digest(table(spark, sf_dir, "pages"))


def op4_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", *quality_rules.FIELDS, "base_failed", "kept")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    model = url_filter.fit(url_filter.labelled_by_rules(pages))
    return url_filter.judge(pages, model).select("page_id", "host", "path", "rule", "verdict")


def op8_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.round_trip(table(spark, sf_dir, "documents"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(table(spark, sf_dir, "documents"), bpe.Coding(public_tokenizers.path("byte_bpe_50k.json")))


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.render(table(spark, sf_dir, "conversations"))


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_bpe.digest(table(spark, sf_dir, "documents"), piece_bpe.Coding(public_tokenizers.path("piece_bpe_32k.model")))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    relabelled = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings").withColumn("label", relabelled), F.col("vec_id") % 50 == 0)


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.spliced_trie(table(spark, sf_dir, "conversations"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {f.__name__: f for f in (op1_ngram_jaccard_join, op2_packing, op3_html_extraction, op4_secret_scans, op5_quality_rules, op6_warc, op7_url_filters, op8_media_columns, op9_bpe, op10_chat_formatting, op11_sentencepiece, op12_hard_negatives, op13_conversation_trie)}
    return found | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return oracles.oracle_sql()

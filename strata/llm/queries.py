"""The driver queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    bpe_chunks, decontamination, html_text, imatch, importance, jaccard_join, license_scan, mixing, prefix_trie, pseudonyms, suffix_dedup,
    token_counts, toxicity)
from .common import table

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn):
    REGISTRY[fn.__name__] = fn
    return fn


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "toxic"))


@query
def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.report(table(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op8_bpe_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_chunks.report(table(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.report(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))


SQL["op9_decontamination"] = decontamination.SQL


@query
def op10_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.report(table(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op5_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms.report(table(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.report(table(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages", "page_id", "url", "html"))


@query
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.report(table(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.report(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "text"))


SQL["op11_importance"] = importance.SQL


@query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


SQL["op12_prefix_trie"] = prefix_trie.SQL


@query
def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(table(spark, sf_dir, "documents", "doc_id", "text", "source"))

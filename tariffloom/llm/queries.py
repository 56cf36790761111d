"""Registered queries of the subpackage, and SQL answers where SQL can express them."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tariffloom.llm import hidden_markov, importance, quality, suffix_dedup, toxicity, warc
from tariffloom.llm.common import fold, table
from tariffloom.llm.decontam import contaminated, contamination
from tariffloom.llm.packing import pack, word_count
from tariffloom.llm.prefix_trie import trie
from tariffloom.llm.secrets import scan
from tariffloom.llm.simhash import near_duplicates
from tariffloom.llm.token_count import token_counts
from tariffloom.llm.url_filter import apply_rules, rule_table


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_rules(table(spark, sf_dir, "pages"), rule_table(spark))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents").select("doc_id", word_count(F.col("text")).alias("length")))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = quality.judged(docs, quality.learn(docs, table(spark, sf_dir, "labels")))
    return found.select("doc_id", *quality.COUNTS, "base_failed", "kept")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def op6_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hidden_markov.scores(table(spark, sf_dir, "documents"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.deduplicated(table(spark, sf_dir, "documents")).drop("kept")


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_novel")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2("items", 256).alias("items_sha256"), contaminated().alias("contaminated"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = toxicity.scored(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))
    return found.select(
        "doc_id", (fold("doc_id", toxicity.FOLDS) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = importance.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages")).drop("record_id")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(table(spark, sf_dir, "conversations"))


OPERATORS = (
    op1_url_filter, op2_token_counts, op3_packing, op4_quality_rules, op5_simhash, op6_hidden_markov, op7_suffix_dedup, op8_secrets,
    op9_decontamination, op10_toxicity, op11_importance, op12_warc, op13_prefix_trie,
)
QUERIES = {"pipeline": corpus_pipeline.run} | {f.__name__: f for f in OPERATORS}

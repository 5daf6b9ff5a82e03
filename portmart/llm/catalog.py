"""Registered queries of this subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from portmart.llm import (
    decontamination,
    graph_search,
    html_extraction,
    language_id,
    mixing,
    ngram_join,
    periodic_runs,
    phrase_mining,
    quality_rules,
    rule_ensemble,
    sharding,
    substring_dedup,
    warc,
)
from portmart.llm.common import table
from portmart.llm.sql import SQL  # noqa: F401


def op1_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_ensemble.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "item_shingles", "shared")


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.identify(docs, language_id.fit(docs)).select("doc_id", "held_out", "lang_pred", "score")


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.components(table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = warc.archive(table(spark, sf_dir, "pages"))
    return merged.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "urlkey", "ts")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = quality_rules.apply_rules(table(spark, sf_dir, "documents"))
    return m.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract(table(spark, sf_dir, "pages"))


def op11_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_mining.mine(table(spark, sf_dir, "documents"))


def op12_graph_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph_search.search(table(spark, sf_dir, "embeddings"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find_runs(periodic_runs.plant(table(spark, sf_dir, "documents")))
    return found.select(
        "doc_id",
        "n_runs",
        "start",
        "length",
        "period",
        "exponent_milli",
        "runs_sha256",
        "collapsed_sha256",
    )


QUERIES = {
    "op1_rule_ensemble": op1_rule_ensemble,
    "op2_decontamination": op2_decontamination,
    "op3_sharding": op3_sharding,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_language_id": op5_language_id,
    "op6_ngram_join": op6_ngram_join,
    "op7_warc": op7_warc,
    "op8_mixing": op8_mixing,
    "op9_quality_rules": op9_quality_rules,
    "op10_html_extraction": op10_html_extraction,
    "op11_phrase_mining": op11_phrase_mining,
    "op12_graph_search": op12_graph_search,
    "op13_periodic_runs": op13_periodic_runs,
}

"""Registered queries of the text operators and, where SQL can say them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockflow.llm.bpe import encode_documents
from dockflow.llm.cascade import quality_rules
from dockflow.llm.common import table
from dockflow.llm.conversations import damaged, repair_report
from dockflow.llm.fingerprints import fingerprint_edits
from dockflow.llm.mixing import mix
from dockflow.llm.oracle import LLM_ORACLE
from dockflow.llm.overlap import similar_documents
from dockflow.llm.passages import quality_report
from dockflow.llm.private import private_report
from dockflow.llm.ranked import best_documents
from dockflow.llm.secrets import secret_report
from dockflow.llm.token_cache import cached_counts, new_cache
from dockflow.llm.toxicity import toxicity_report
from dockflow.llm.windows import repeated_passages


def op1_iblt_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_edits(table(spark, sf_dir, "documents"))


def op2_token_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twice over one cache: the first pass finds nothing and encodes all distinct texts, the second finds them all."""
    documents, cache = table(spark, sf_dir, "documents"), new_cache(spark)
    cached_counts(documents, cache)
    return cached_counts(documents, cache)


def op3_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


def op4_attention_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_fuzzy_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_secret_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_report(table(spark, sf_dir, "documents"))


def op7_compact_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))


def op8_overlap_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(table(spark, sf_dir, "documents"))


def op9_fair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).drop("copies")


def op10_two_tier_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = encode_documents(table(spark, sf_dir, "documents"))
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op11_disclosed_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return private_report(table(spark, sf_dir, "documents"))


def op12_branch_and_bound_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return repair_report(damaged(conversations), conversations).drop("repaired_rows")


def op13_k2_treap_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_iblt_fingerprints,
        op2_token_cache,
        op3_quality_cascade,
        op4_attention_quality,
        op5_fuzzy_toxicity,
        op6_secret_automaton,
        op7_compact_windows,
        op8_overlap_join,
        op9_fair_mix,
        op10_two_tier_bpe,
        op11_disclosed_terms,
        op12_branch_and_bound_repair,
        op13_k2_treap_search,
    )
}

__all__ = ["LLM_ORACLE", "LLM_QUERIES"]

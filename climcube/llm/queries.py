"""The registered query of each operator: its digest columns over the whole tables."""

from __future__ import annotations

from collections.abc import Callable

from public_tokenizers import path as tokenizer_path
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    decontamination,
    divergence,
    html_wrappers,
    line_dedup,
    packing,
    quality_classifier,
    quality_rules,
    secrets,
    simhash,
    token_counts,
    toxicity,
    urls,
    vector_codes,
)
from .common import table


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    findings, _ = secrets.scan(table(spark, sf_dir, "documents"))
    found = F.col("found")

    def n(kind: str):
        return F.size(F.filter(found, lambda x: x["rule"] == kind)).cast("long")

    spans = F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["rule"], x["start"], x["end"])), ",")
    return findings.select(
        F.col("path").alias("doc_id"), n("assign").alias("n_assign"), n("access").alias("n_access"),
        n("hex").alias("n_hex"), F.sha2(spans, 256).alias("base_sha256"), spans.alias("spans"),
    )


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op3_html_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_wrappers.extract(table(spark, sf_dir, "pages"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, most_bits=2)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_classifier.score(docs, quality_classifier.fit(docs, table(spark, sf_dir, "labels")))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("rejected_by")


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_shared_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_secret_scan, op2_toxicity, op3_html_wrappers, op4_token_counts, op5_url_filter, op6_packing,
        op7_simhash, op8_decontamination, op9_quality_classifier, op10_quality_rules,
        op11_source_divergence, op12_vector_codes, op13_line_dedup,
    )
    return {f.__name__: f for f in found}

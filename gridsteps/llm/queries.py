"""One query per operator over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from gridsteps.llm import (
    ann, byte_bpe, classifier, divergence, hilbert, mixing, near_dup, packing, periodic, quality_rules, secret_scan, token_files, warc)
from gridsteps.llm.common import table


def op1_token_files(spark: SparkSession, d: str) -> DataFrame:
    return token_files.read_token_files(token_files.write_token_files(table(spark, d, "documents")))


def op2_stable_projections(spark: SparkSession, d: str) -> DataFrame:
    return ann.nearest(table(spark, d, "embeddings"), F.col("vec_id") % 20 == 0)


def op3_warc_salvage(spark: SparkSession, d: str) -> DataFrame:
    return warc.read_pages(warc.write_warc(table(spark, d, "pages")))


def op4_concat_and_cut(spark: SparkSession, d: str) -> DataFrame:
    return packing.pieces(packing.pack_sequences(table(spark, d, "documents")))


def op5_rule_ledger(spark: SparkSession, d: str) -> DataFrame:
    return quality_rules.apply_policy(quality_rules.ledger(table(spark, d, "documents")), "web-2").drop("text_key")


def op6_hilbert_shards(spark: SparkSession, d: str) -> DataFrame:
    return hilbert.shard(table(spark, d, "documents"))


def op7_pivotal_mix(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(table(spark, d, "documents"))


def op8_fourier_quality(spark: SparkSession, d: str) -> DataFrame:
    return classifier.score_quality(table(spark, d, "documents"), table(spark, d, "labels"))


def op9_odd_sketches(spark: SparkSession, d: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, d, "documents"))


def op10_token_efficiency(spark: SparkSession, d: str) -> DataFrame:
    return secret_scan.scan_documents(table(spark, d, "documents"))


def op11_synchronising_runs(spark: SparkSession, d: str) -> DataFrame:
    return periodic.run_digest(periodic.periodic_runs(table(spark, d, "documents"), periodic.repeat_some))


def op12_vectorised_bpe(spark: SparkSession, d: str) -> DataFrame:
    decoded = byte_bpe.decode_documents(byte_bpe.encode_documents(table(spark, d, "documents")))
    return decoded.select(
        "doc_id", F.expr("cast(octet_length(ids) div 4 as long)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("data", 256).alias("decoded_sha256"))


def op13_divergence_audit(spark: SparkSession, d: str) -> DataFrame:
    return divergence.audit(table(spark, d, "documents"))


QUERIES = {
    "op1_token_files": op1_token_files,
    "op2_stable_projections": op2_stable_projections,
    "op3_warc_salvage": op3_warc_salvage,
    "op4_concat_and_cut": op4_concat_and_cut,
    "op5_rule_ledger": op5_rule_ledger,
    "op6_hilbert_shards": op6_hilbert_shards,
    "op7_pivotal_mix": op7_pivotal_mix,
    "op8_fourier_quality": op8_fourier_quality,
    "op9_odd_sketches": op9_odd_sketches,
    "op10_token_efficiency": op10_token_efficiency,
    "op11_synchronising_runs": op11_synchronising_runs,
    "op12_vectorised_bpe": op12_vectorised_bpe,
    "op13_divergence_audit": op13_divergence_audit,
}

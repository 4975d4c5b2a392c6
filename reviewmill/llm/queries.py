"""One registered query per operator, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from reviewmill.llm import byte_bpe, context_mixing, cuckoo_dedup, dart_minhash, divergence, grid_codes, hyper_langid, mixing, rotation_codes, secrets, sharding, toxicity, warc_revisits
from reviewmill.llm.common import read_table

RANKS = "byte_bpe_50k.tiktoken"
SHARDS = 24


def op1_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dart_minhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(read_table(spark, sf_dir, "documents"))


def op3_cuckoo_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cuckoo_dedup.dedup(read_table(spark, sf_dir, "documents"))


def op4_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(read_table(spark, sf_dir, "documents"), SHARDS)


def op5_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_revisits.resolved_pages(spark, sf_dir)


def op6_hyper_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hyper_langid.language(read_table(spark, sf_dir, "documents"))


def op7_rotation_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rotation_codes.near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    encoded = byte_bpe.encode_documents(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    return byte_bpe.token_digests(encoded)


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.span_digests(secrets.secrets(read_table(spark, sf_dir, "documents")))


def op11_grid_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid_codes.compressed(read_table(spark, sf_dir, "embeddings"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(read_table(spark, sf_dir, "documents"))


def op13_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_mixing.scores(read_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_dart_minhash": op1_dart_minhash,
        "op2_mix_sources": op2_mix_sources,
        "op3_cuckoo_dedup": op3_cuckoo_dedup,
        "op4_virtual_slots": op4_virtual_slots,
        "op5_warc_revisits": op5_warc_revisits,
        "op6_hyper_langid": op6_hyper_langid,
        "op7_rotation_codes": op7_rotation_codes,
        "op8_toxicity": op8_toxicity,
        "op9_byte_bpe": op9_byte_bpe,
        "op10_secrets": op10_secrets,
        "op11_grid_codes": op11_grid_codes,
        "op12_divergence": op12_divergence,
        "op13_context_mixing": op13_context_mixing,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_dart_minhash": dart_minhash.SQL,
        "op2_mix_sources": mixing.SQL,
        "op3_cuckoo_dedup": cuckoo_dedup.SQL,
        "op5_warc_revisits": warc_revisits.SQL,
        "op7_rotation_codes": rotation_codes.SQL,
        "op11_grid_codes": grid_codes.SQL,
        "op12_divergence": divergence.SQL,
    }

"""From raw documents to token digests, one stage after the other.

Each stage works on every row that its predecessor kept and hands on the columns it got; the
last one returns token counts and digests.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from reviewmill.llm import byte_bpe, cuckoo_dedup, dart_minhash, mixing, toxicity
from reviewmill.llm.common import read_table, stored
from reviewmill.llm.queries import RANKS

# Trained scores, sketches and a tokenizer: no SQL says the same.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go; it learns from the labels of ``sf_dir``."""
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.clean_documents(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest id stays."""
    return cuckoo_dedup.kept_documents(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the row with the smallest id stays."""
    return dart_minhash.kept_documents(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, by source and target weight."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every row."""
    encoded = byte_bpe.encode_documents(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    return byte_bpe.token_digests(encoded)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix),
    ("byte_bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

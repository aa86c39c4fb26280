"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tidemill.llm import mixing, minhash, pieces, secrets
from tidemill.llm import toxicity as toxic
from tidemill.llm.common import table
from tidemill.session import checkpoint_dir


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go."""
    return toxic.drop_toxic(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return minhash.drop_near_duplicates(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets, and weak parts of credentials beside others, are replaced by marks; all rows stay."""
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once, and half as many words again, shared among the sources by weights 5, 2, 1
    up to two epochs of a source; rows stand as often as the mix takes them."""
    weights = mixing.ranked_weights(docs, [5, 2, 1])
    return mixing.mixed_documents(docs, weights, budget_ratio=1.5, max_epochs=2.0, least_epochs=1.0)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled segmentations: piece ids, their number, and whether they spell the text again."""
    return pieces.encode(docs)


STAGES = [
    ("toxicity", toxicity),
    ("minhash_near_dedup", near_dedup),
    ("secret_scan", secret_scan),
    ("mixing", mix_sources),
    ("sentencepiece", encode_pieces),
]

#: Sampled segmentations are seeded by 64-bit mixing that SQL does not have.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; every stage but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{checkpoint_dir(spark).rstrip('/')}/corpus-pipeline/{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs.write.parquet(f"{folder}/{k}-{name}")
            docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return docs

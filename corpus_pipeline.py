"""A training corpus from raw documents: five stages, each an operator of llm/, each written before the next reads it.

Every stage takes (spark, docs, sf_dir) and all that its predecessor kept. All but the last give back docs' own columns,
whatever their names; the last gives the tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from llm import bpe, decontam, jaccard, secret_scan, toxicity
from llm.common import table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go. The model learns from the labelled documents outside of the test fold."""
    return toxicity.keep_clean(docs, toxicity.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of linked documents the one of least doc_id stays."""
    return jaccard.keep_one(docs)


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; a document that is one for the most goes."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked."""
    return secret_scan.redact(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id and the token ids of each document."""
    import public_tokenizers

    return bpe.encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("near copies", drop_near_copies),
    ("benchmark decontamination", cut_benchmark),
    ("secret scans", mask_secrets),
    ("byte-level BPE", encode),
]

#: A learned score decides in the first stage, which SQL can't express; tests/llm compares run() with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs

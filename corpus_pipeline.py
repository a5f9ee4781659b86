"""A training-data pipeline over ``documents``: five stages, each written as Parquet
and read again by the next.

1. quality   documents that the classifier rejects go (texts without words are scored
             by the share of good labels)
2. neardup   of each group of near copies (five-word shingles, a similarity of 0.8 or
             more) the smallest doc_id stays
3. decontam  documents that hold a benchmark passage go
4. secrets   secrets in the texts are replaced by a mark; no document goes
5. bpe       token ids of the texts, and a digest of what they decode to (the last
             stage: its own columns)
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.llm import bpe, decontam, neardup, quality, secrets
from driftline.llm.common import checkpointed, in_text_batches, small, table
from driftline.session import scratch_path


def stage_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Train on the table's labels; keep documents scored 0.5 or more."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return docs.where(quality.score(F.col("text"), model) >= 0.5)


def stage_neardup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the rows marked as kept; a row without doc_id always is."""
    gone = checkpointed(neardup.group_near_duplicates(docs, percent=80).where(~F.col("kept")).select("doc_id"))
    return docs.join(small(gone), "doc_id", "left_anti").select(docs.columns)


def stage_decontam(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.without_leaks(spark, docs, table(spark, sf_dir, "benchmark"))


def stage_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Redact; ``n_chars`` follows the new text."""
    return secrets.redact(docs).withColumn("n_chars", F.length("text").cast("bigint"))


def stage_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    return docs.withColumn("_coded", bpe.round_trip(F.col("text"), path, pattern)).select(
        "doc_id", "lang", "source", "n_chars", F.size("_coded.ids").cast("bigint").alias("n_tokens"), "_coded.ids",
        F.col("_coded.sha256").alias("decoded_sha256"))


STAGES = [(name, in_text_batches(stage)) for name, stage in (
    ("quality", stage_quality), ("neardup", stage_neardup), ("decontam", stage_decontam),
    ("secrets", stage_secrets), ("bpe", stage_bpe))]

#: SQL cannot express the classifier or the byte-pair merges; the tests hold each
#: stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

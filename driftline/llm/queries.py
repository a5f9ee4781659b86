"""One query per operator over the driver tables, and DuckDB SQL where it can say
the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.llm import arc, bpe, collocations, decontam, html_text, lexical, neardup, omh, quality, secrets, sharding, substring, token_counts
from driftline.llm.common import in_text_batches, table
from driftline.llm.oracle import ORACLE_SQL
from driftline.session import scratch_path

SHARDS = 8
TOKEN_LIMIT = 2048


def _hex(value: Column) -> Column:
    return F.sha2(value, 256)


def _span_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.scan_documents(docs, out_col="found")
    base_kinds = [r.kind for r in secrets.BASE_RULES]
    base = F.filter("found", lambda s: s["kind"].isin(base_kinds))

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("bigint")

    return found.select(
        "doc_id", *(count(k).alias(f"n_{k}") for k in base_kinds),
        _hex(_span_text(base).cast("binary")).alias("base_sha256"),
        _span_text(F.col("found")).alias("spans"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score_documents(docs, model).select(
        "doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.group_near_duplicates(table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = docs.select("doc_id", bpe.round_trip(F.col("text"), path, pattern).alias("coded"))
    return coded.select("doc_id", F.size("coded.ids").cast("bigint").alias("n_tokens"), "coded.ids_sha256",
                        F.col("coded.sha256").alias("decoded_sha256"))


def op6_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    arcs, warcs = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    arc.write_arc(table(spark, sf_dir, "pages"), arcs, "page_id", "url", "html")
    arc.arc_to_warc(spark, arcs, warcs, min_bytes=0, key_type="bigint")
    return arc.read_warc(spark, warcs).select(
        F.col("key").cast("bigint").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to_key").cast("bigint").alias("refers_to"))


def op7_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return omh.compare_with_next(table(spark, sf_dir, "documents"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.count_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
    return counted.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"),
                          "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", _hex(F.col("kept_text").cast("binary")).alias("kept_sha256"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"))
    placed = sharding.assign(docs, SHARDS, ties=[F.col("text_crc32"), F.col("size")])
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot",
                         sharding.shard_of(F.col("doc_id"), SHARDS + 1).alias("grown_shard"))


def op11_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract_pages(pages).select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: in_text_batches(f) for f in (op1_secret_scan, op2_quality_classifier, op3_minhash_neardup,
                                   op4_decontamination, op5_byte_bpe, op6_arc_to_warc, op7_order_minhash, op8_token_counts, op9_substring_dedup,
                                   op10_sharding, op11_html_text, op12_lexical_search, op13_collocations)}

__all__ = ["QUERIES", "ORACLE_SQL"]

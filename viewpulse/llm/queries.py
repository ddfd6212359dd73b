"""Registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewpulse.llm import (
    audit, infill, line_dedup, mixing, neighbours, packing, pii, quality, simhash, substring, topk, toxicity, warc,
)
from viewpulse.llm.common import WORD

#: Tokenizer file of the packing query.
TOKENIZER = "word_bpe_49k.json"

#: Key of the surrogates of the query; jobs on real data pass their own.
SURROGATE_KEY = "sample tables"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_classes(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), simhash.fingerprint_text(F.col("fp")).alias("fingerprint"),
        F.col("class_id").alias("component_id"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedupe_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text"), 256).alias("kept_sha256"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest(packing.pack(table(spark, sf_dir, "documents"), tokenizer_path()))


def op6_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace_pii(table(spark, sf_dir, "documents"), SURROGATE_KEY).select("doc_id", "text", "n_found", "kinds")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(*mixing.mix(table(spark, sf_dir, "documents"))).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = F.array_join(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(WORD), F.lit(0)), " ")
    return substring.dedupe_passages(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2(kept, 256).alias("kept_sha256"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    # a row without an id is never learnt from
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(True))
    return toxicity.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "toxic")


def op10_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op11_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return infill.fill_in_middle(table(spark, sf_dir, "documents")).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(text, 256).alias("output_sha256"),
        F.sha2(infill.restored(text, F.col("form")), 256).alias("restored_sha256"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_quality_rules, op2_simhash, op3_warc, op4_line_dedup, op5_packing, op6_pii_surrogates, op7_mixing,
        op8_substring_dedup, op9_toxicity, op10_exact_top_k, op11_nearest_neighbours, op12_fill_in_middle,
        op13_filter_audit)}

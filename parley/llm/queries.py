"""Registered queries of the operators: production parameters, whole tables, full results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers as tokenizers
from parley.llm import bpe, chunks, filteraudit, linededup, lineblock, merkle, orderminhash, phrases, quality, sharding, simhash, tokenfiles, winnow
from parley.llm.common import stored, table
from parley.session import scratch_path


def op1_merkle_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages as WARC records against a replica that is damaged by a rule."""
    records = merkle.warc_records(table(spark, sf_dir, "pages"))
    index = stored(merkle.indexed(records), "warc-index")
    return merkle.audit(index, stored(merkle.damaged(records, index), "warc-replica"))


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = winnow.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assess(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(table(spark, sf_dir, "documents"), tokenizers.path("byte_bpe_50k.tiktoken"), tokenizers.PATTERN, with_ids=False)


def op5_line_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineblock.extract(table(spark, sf_dir, "pages"))


def op6_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orderminhash.near_duplicates(table(spark, sf_dir, "documents")).drop("__t", "__u")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.line_report(table(spark, sf_dir, "documents"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = tokenfiles.write_tokens(
        table(spark, sf_dir, "documents"), tokenizers.path("byte_bpe_50k.json"), scratch_path(spark, "llm-tokens"), end_id=2)
    return tokenfiles.read_tokens(manifest).select("doc_id", "start", "n_tokens", "ids_crc32")


def op9_minimax_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(table(spark, sf_dir, "documents"), shards=40)


def op10_content_defined_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.dedup_substrings(table(spark, sf_dir, "documents"))


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = filteraudit.base_rows(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return filteraudit.audit(rows, filteraudit.failing_ids(rows))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_merkle_fixity": op1_merkle_fixity,
    "op2_benchmark_decontamination": op2_benchmark_decontamination,
    "op3_quality_rules": op3_quality_rules,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_line_block": op5_line_block,
    "op6_order_minhash": op6_order_minhash,
    "op7_line_dedup": op7_line_dedup,
    "op8_token_files": op8_token_files,
    "op9_minimax_sharding": op9_minimax_sharding,
    "op10_content_defined_chunks": op10_content_defined_chunks,
    "op11_phrase_collocations": op11_phrase_collocations,
    "op12_simhash": op12_simhash,
    "op13_filter_audit": op13_filter_audit,
}

"""The training-data pipeline: quality rules, line dedup, near-dedup, benchmark
decontamination, byte-level BPE.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame, which is written as Parquet and read back as the next stage's docs.  All but
the last return the columns of ``documents``; the last returns a row per document that is
left, with its ids.  Each stage handles nulls, empty and long texts, equal rows, empty
tables and further columns as its operator's docstring says.
"""

from __future__ import annotations

import public_tokenizers as tokenizers
from pyspark.sql import DataFrame, SparkSession

from parley.llm import bpe, linededup, orderminhash, quality, winnow
from parley.llm.common import stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rule nor the learned list rejects.  The list is
    learned from the labels of the documents at hand."""
    return quality.good_documents(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the later copies of runs of lines; n_chars follows."""
    return linededup.dedup_lines(docs, length="n_chars" if "n_chars" in docs.columns else None)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, that of the least id."""
    return orderminhash.dedup(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    return winnow.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and ids of every document."""
    return bpe.encode_decode(docs, tokenizers.path("byte_bpe_50k.tiktoken"), tokenizers.PATTERN)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("byte_bpe", byte_bpe),
]

#: The learned list, the sketches and the merges are beyond SQL; tests/llm holds run()
#: against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each stored for the next."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, f"stage-{name}")
    return docs

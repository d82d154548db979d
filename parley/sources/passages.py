"""Passage and paragraph collections -> ``collection(doc_id, text, source, batch_id)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

COLLECTION_SCHEMA = "doc_id string, text string, source string, batch_id bigint"

PARAGRAPH_SCHEMA = T.StructType(
    [
        T.StructField("para_id", T.StringType()),
        T.StructField("bodies", T.ArrayType(T.StructType([T.StructField("text", T.StringType())]))),
    ]
)


def _fields(value: str = "value"):
    # limit -1 keeps a trailing empty field: "2\t" -> ["2", ""] (kept, empty text)
    return F.split(F.col(value), "\t", -1)


def parse_passage_lines(lines: DataFrame, prefix: str = "MARCO_", source: str = "MARCO", batch_id: int = 1) -> DataFrame:
    """One text line = one passage ``id<TAB>text[<TAB>...]``; key = prefix + id, text = column 2.

    Quotes are ordinary characters.  Lines with fewer than two columns are not passages;
    see :func:`rejected_passage_lines`.
    """
    f = _fields()
    return lines.where(F.size(f) >= 2).select(
        F.concat(F.lit(prefix), f[0]).alias("doc_id"),
        f[1].alias("text"),
        F.lit(source).alias("source"),
        F.lit(batch_id).cast("bigint").alias("batch_id"),
    )


def checked_passage_lines(lines: DataFrame, prefix: str = "MARCO_", source: str = "MARCO", batch_id: int = 1) -> tuple[DataFrame, Column]:
    """Every line as a passage row, and the condition that it is one (for counts at ingest)."""
    f = _fields()
    rows = lines.select(F.concat(F.lit(prefix), F.get(f, 0)).alias("doc_id"), F.get(f, 1).alias("text"), F.lit(source).alias("source"),
                        F.lit(batch_id).cast("bigint").alias("batch_id"))
    return rows, F.col("text").isNotNull()


def rejected_passage_lines(lines: DataFrame) -> DataFrame:
    """Lines that are not passages (fewer than two tab-separated columns)."""
    return lines.where(F.size(_fields()) < 2).select("value")


def load_passages(spark: SparkSession, path: str, prefix: str = "MARCO_", source: str = "MARCO", batch_id: int = 1) -> DataFrame:
    """Read a tab-separated passage file (UTF-8, no header)."""
    return parse_passage_lines(spark.read.text(path), prefix, source, batch_id)


def load_paragraphs(paragraphs: DataFrame, prefix: str = "CAR_", source: str = "CAR", batch_id: int = 1) -> DataFrame:
    """A paragraph's text is its bodies' texts concatenated in order, no separator."""
    return paragraphs.select(
        F.concat(F.lit(prefix), F.col("para_id")).alias("doc_id"),
        F.array_join(F.transform("bodies", lambda b: b["text"]), "").alias("text"),
        F.lit(source).alias("source"),
        F.lit(batch_id).cast("bigint").alias("batch_id"),
    )


def read_paragraphs(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Nested paragraph rows from Parquet or JSON lines (explicit schema, no inference)."""
    return spark.read.format(fmt).schema(PARAGRAPH_SCHEMA).load(path)

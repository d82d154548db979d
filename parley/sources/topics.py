"""Conversation topics -> one row per turn."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TURN_STRUCT = T.StructType(
    [
        T.StructField("number", T.LongType()),
        T.StructField("manual_rewritten_utterance", T.StringType()),
        T.StructField("automatic_rewritten_utterance", T.StringType()),
    ]
)
TOPIC_SCHEMA = T.StructType(
    [T.StructField("number", T.LongType()), T.StructField("turn", T.ArrayType(TURN_STRUCT))]
)


def flatten_topics(topics: DataFrame) -> DataFrame:
    """Topics x turns -> ``(topic, turn, manual, automatic, pos_topic, pos_turn)``.

    ``pos_topic``/``pos_turn`` record input order; a repeated ``topic_turn`` id keeps the
    last one (see :func:`parley.operators.retrieval.make_qid`).
    """
    t = topics.withColumn("pos_topic", F.monotonically_increasing_id())
    return t.select(
        F.col("number").alias("topic"),
        "pos_topic",
        F.posexplode("turn").alias("pos_turn", "t"),
    ).select(
        "topic",
        F.col("t.number").alias("turn"),
        F.col("t.manual_rewritten_utterance").alias("manual"),
        F.col("t.automatic_rewritten_utterance").alias("automatic"),
        "pos_topic",
        F.col("pos_turn").cast("bigint").alias("pos_turn"),
    )


def load_topics(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """Read topic JSON with a fixed schema.

    ``multiline=True`` reads files holding one JSON array of topics (the published
    format); ``False`` reads JSON lines, one topic per line (what Spark writes).
    """
    raw = spark.read.schema(TOPIC_SCHEMA).option("multiLine", multiline).json(path)
    return flatten_topics(raw)


def write_topics(topics: DataFrame, path: str) -> None:
    """Write nested topics as JSON lines, one topic per line."""
    topics.select("number", "turn").write.mode("overwrite").json(path)

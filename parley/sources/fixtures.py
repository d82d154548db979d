"""Adapters from the driver's tables to the reference's input shapes.

documents      -> passage lines (first half of the sources), paragraphs (second half)
benchmark      -> the main query set (topics of 12 turns, manual and automatic utterances)
conversations  -> topics (user turns of each conversation)
labels         -> an update batch for the collection (documents that received labels)
queries x documents -> graded judgements (qrels) by raw-token coverage

Everything is derived by Spark from the whole tables.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parley.functions.text import raw_terms
from parley.operators.blocks import Tokens, by_blocks, ddl
from parley.plans.sizing import bounded_broadcast, fits_broadcast, materialize
from parley.sources.collection import union_collections
from parley.sources.passages import load_paragraphs, parse_passage_lines

# --- fixed values -----------------------------------------------------------------------
MARCO_SOURCES_BELOW = 10  # src0..src9 form the passage file, src10.. the paragraph file
TURNS_PER_TOPIC = 12  # benchmark items per synthetic topic
# coverage thresholds for the graded labels: rel 2 >= 0.6, rel 1 >= 0.4, rel 0 >= 0.3
# -----------------------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _src_no() -> F.Column:
    return F.substring(F.col("source"), 4, 100).cast("int")


def passage_half(documents: DataFrame) -> DataFrame:
    """The documents that the collection takes from its passage file."""
    return documents.where(_src_no() < MARCO_SOURCES_BELOW)


def paragraph_half(documents: DataFrame) -> DataFrame:
    """The documents that the collection takes from its paragraph file."""
    return documents.where(_src_no() >= MARCO_SOURCES_BELOW)


def passage_lines(documents: DataFrame) -> DataFrame:
    """Documents as TSV lines ``id<TAB>text`` (tabs/line breaks in text -> space)."""
    return documents.select(
        F.concat_ws("\t", F.col("doc_id").cast("string"), F.regexp_replace("text", r"[\t\n\r]", " ")).alias("value")
    )


def paragraphs(documents: DataFrame) -> DataFrame:
    """Documents as nested rows: one body per text line."""
    return documents.select(
        F.col("doc_id").cast("string").alias("para_id"),
        F.transform(F.split("text", "\n", -1), lambda x: F.struct(x.alias("text"))).alias("bodies"),
    )


def collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``collection(doc_id, text, source, batch_id)`` through the S1/S2/S3 operators."""
    docs = table(spark, sf_dir, "documents")
    return union_collections(
        parse_passage_lines(passage_lines(passage_half(docs))), load_paragraphs(paragraphs(paragraph_half(docs))))


def upsert_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch 2: labelled documents re-indexed with new text, plus benchmark items as new passages."""
    coll = collection(spark, sf_dir)
    labels = table(spark, sf_dir, "labels")
    lab_ids = labels.select(F.col("doc_id").cast("string").alias("raw_id")).distinct()
    updated = (
        coll.withColumn("raw_id", F.regexp_replace("doc_id", "^(MARCO|CAR)_", ""))
        .join(lab_ids, "raw_id", "left_semi")
        .select("doc_id", F.concat(F.lit("updated "), F.col("text")).alias("text"), "source", F.lit(2).cast("bigint").alias("batch_id"))
    )
    new = table(spark, sf_dir, "benchmark").select(
        F.concat(F.lit("MARCO_B"), F.col("item_id").cast("string")).alias("doc_id"),
        F.col("text"),
        F.lit("MARCO").alias("source"),
        F.lit(2).cast("bigint").alias("batch_id"),
    )
    return updated.unionByName(new)


def _with_automatic(turns: DataFrame) -> DataFrame:
    w = Window.partitionBy("topic").orderBy("turn")
    prev = F.lag("manual").over(w)
    return turns.withColumn("automatic", F.when(prev.isNull(), F.col("manual")).otherwise(F.concat_ws(" ", prev, F.col("manual"))))


def queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main query set from ``benchmark``: ``(topic, turn, manual, automatic)``.

    topic = item_id div 12, turn = item_id mod 12 + 1 (turns 11 and 12 exist, so the
    turn <= 10 report has something to leave out); the automatic utterance prepends the
    previous turn's text, as a context-carrying rewrite would.
    """
    b = table(spark, sf_dir, "benchmark")
    t = b.select(
        F.floor(F.col("item_id") / TURNS_PER_TOPIC).cast("bigint").alias("topic"),
        (F.col("item_id") % TURNS_PER_TOPIC + 1).cast("bigint").alias("turn"),
        F.col("text").alias("manual"),
    )
    return _with_automatic(t).select(
        "topic", "turn", "manual", "automatic", F.col("topic").alias("pos_topic"), F.col("turn").alias("pos_turn")
    )


def topics_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topics from ``conversations``: user turns, previous user turn prepended for 'automatic'."""
    c = table(spark, sf_dir, "conversations").where(F.col("role") == "user")
    t = c.select(F.col("conv_id").alias("topic"), F.col("turn").cast("bigint").alias("turn"), F.col("text").alias("manual"))
    return _with_automatic(t).select(
        "topic", "turn", "manual", "automatic", F.col("topic").alias("pos_topic"), F.col("turn").alias("pos_turn")
    )


def line_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A query set with turns that hold no term: the first line of every document."""
    d = table(spark, sf_dir, "documents")
    line = F.split("text", "\n").getItem(0)
    return d.select(F.col("doc_id").alias("topic"), F.lit(1).cast("bigint").alias("turn"), line.alias("manual"), line.alias("automatic"),
                    F.col("doc_id").alias("pos_topic"), F.lit(1).cast("bigint").alias("pos_turn"))


def topics_nested(turns: DataFrame) -> DataFrame:
    """Turns -> the published nested topic shape ``(number, turn: array<struct>)``."""
    return turns.groupBy(F.col("topic").alias("number")).agg(
        F.array_sort(
            F.collect_list(
                F.struct(
                    F.col("turn").alias("number"),
                    F.col("manual").alias("manual_rewritten_utterance"),
                    F.col("automatic").alias("automatic_rewritten_utterance"),
                )
            )
        ).alias("turn")
    )


def qrels(spark: SparkSession, sf_dir: str, turns: DataFrame | None = None) -> DataFrame:
    """Graded judgements: raw distinct tokens shared by query (manual) and document.

    coverage = shared / distinct query tokens; rel 2 if >= 0.6, 1 if >= 0.4, 0 if >= 0.3,
    otherwise the pair is not judged.  Integer arithmetic, no float threshold.
    The query side is broadcast when its measured size allows; documents are scanned once.
    """
    from parley.plans.corpus import bucket_count, input_files

    turns = turns if turns is not None else queries(spark, sf_dir)
    qtok = materialize(
        turns.select(F.concat_ws("_", "topic", "turn").alias("qid"), F.explode(raw_terms("manual")).alias("term"))
        .distinct()
    )
    terms = qtok.select("term").distinct()
    sent = spark.sparkContext.broadcast(frozenset(r["term"] for r in terms.collect())) if fits_broadcast(terms) else None
    nq = qtok.groupBy("qid").agg(F.count(F.lit(1)).alias("nq"))
    # distinct raw tokens per document, of those that a query has, dealt out by document in as
    # many parts as the corpus has buckets: a part's sums per (query, document) fit a task and
    # need no exchange
    def distinct(rows: pa.RecordBatch, texts: pa.Array) -> list[pa.Array]:
        tokens = Tokens.split(texts, raw=True)
        return [rows.column("doc_id"), (tokens if sent is None else tokens.only(sent.value)).distinct().joined()]

    docs = collection(spark, sf_dir).select("doc_id", "text")
    dstr = by_blocks(docs, "text", ", ".join([*ddl(docs, "doc_id"), "toks string"]), distinct)
    dstr = dstr.repartition(bucket_count(spark, sum(n for _, n, _ in input_files(spark, sf_dir))), "doc_id")
    dtok = dstr.select("doc_id", F.explode(F.split("toks", " ")).alias("term")).where(F.col("term") != "")
    shared = dtok.join(bounded_broadcast(qtok), "term").groupBy("qid", "doc_id").agg(F.count(F.lit(1)).alias("shared"))
    s = shared.join(bounded_broadcast(nq), "qid")
    rel = (
        F.when(F.col("shared") * 10 >= F.col("nq") * 6, 2)
        .when(F.col("shared") * 10 >= F.col("nq") * 4, 1)
        .when(F.col("shared") * 10 >= F.col("nq") * 3, 0)
    )
    out = s.select("qid", F.lit("0").alias("iter"), "doc_id", rel.cast("int").alias("rel")).where(F.col("rel").isNotNull())
    # judgements are an input table (a file in the reference); evaluation reads it several times
    return materialize(out)

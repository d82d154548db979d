"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each builds on the whole driver tables of ``sf_dir``; depths are the reference's own
(BM25 500 per turn, deep rank 500 of 2,500, same-depth re-rank 500 of 500, query
likelihood over 500).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from parley.operators import retrieval as Q
from parley.plans.corpus import corpus_for
from parley.plans.sizing import materialize
from parley.sources import fixtures

BM25_DEPTH = 500
DEEP_DEPTH = 2500

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, QueryFn] = {}


def register(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = fn
        return fn

    return deco


def bench_turns(spark: SparkSession, sf_dir: str, kind: str = "Manual") -> DataFrame:
    return Q.turns_for(fixtures.queries(spark, sf_dir), kind)


@register("bm25_retrieve")
def bm25_retrieve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q8, the flagship: all benchmark turns (manual utterances), top 500 each."""
    c = corpus_for(spark, sf_dir)
    return Q.bm25_retrieve(bench_turns(spark, sf_dir), c, BM25_DEPTH)


# ----------------------------------------------------------------------------- sources
def _scratch(spark: SparkSession, name: str) -> str:
    from parley.session import scratch_path

    return scratch_path(spark, name)


def _buckets(spark: SparkSession, sf_dir: str) -> int:
    """Buckets of a table stored from ``documents``, by its bytes."""
    from parley.plans.corpus import bucket_count, input_files

    return bucket_count(spark, sum(b for _, b, _ in input_files(spark, sf_dir)))


@register("load_passages")
def load_passages_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document written to a TSV file, read back with the passage reader."""
    from parley.sources.passages import load_passages

    path = _scratch(spark, "passages-tsv")
    fixtures.passage_lines(fixtures.table(spark, sf_dir, "documents")).write.mode("overwrite").text(path)
    return load_passages(spark, path)


@register("load_paragraphs")
def load_paragraphs_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a nested paragraph row stored as Parquet, bodies concatenated on read."""
    from parley.sources.passages import load_paragraphs, read_paragraphs

    path = _scratch(spark, "paragraphs")
    fixtures.paragraphs(fixtures.table(spark, sf_dir, "documents")).write.mode("overwrite").parquet(path)
    return load_paragraphs(read_paragraphs(spark, path))


@register("union_collections")
def union_collections_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.collection(spark, sf_dir)


@register("upsert_collection")
def upsert_collection_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from parley.sources.collection import upsert_collection

    return upsert_collection(fixtures.collection(spark, sf_dir), fixtures.upsert_batch(spark, sf_dir))


@register("replace_collection")
def replace_collection_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored collection, replaced at its path by the rows of the update batch."""
    from parley.sources.collection import replace_collection

    path = _scratch(spark, "collection")
    replace_collection(fixtures.collection(spark, sf_dir), path)
    return replace_collection(fixtures.upsert_batch(spark, sf_dir), path)


@register("upsert_stored")
def upsert_stored_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4 in place: the collection stored in buckets, the update batch applied to the buckets
    it touches, read back."""
    from parley.sources.store import read_stored, replace_stored, upsert_stored

    path = _scratch(spark, "store")
    replace_stored(fixtures.collection(spark, sf_dir), path, _buckets(spark, sf_dir))
    upsert_stored(spark, path, fixtures.upsert_batch(spark, sf_dir))
    return read_stored(spark, path)


@register("ingest_counts")
def ingest_counts_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a passage line and as a paragraph, stored together and counted
    by the write itself."""
    from pyspark.sql import functions as F

    from parley.sources.passages import checked_passage_lines, load_paragraphs, read_paragraphs
    from parley.sources.store import store_counted

    docs = fixtures.table(spark, sf_dir, "documents")
    tsv, nested = _scratch(spark, "passages-tsv"), _scratch(spark, "paragraphs")
    fixtures.passage_lines(docs).write.mode("overwrite").text(tsv)
    fixtures.paragraphs(docs).write.mode("overwrite").parquet(nested)
    paragraphs = load_paragraphs(read_paragraphs(spark, nested))
    sources = {"MARCO": checked_passage_lines(spark.read.text(tsv)), "CAR": (paragraphs, F.col("doc_id").isNotNull())}
    return store_counted(sources, _scratch(spark, "store"), _buckets(spark, sf_dir))


@register("collection_counts")
def collection_counts_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from parley.sources.collection import collection_counts

    return collection_counts(fixtures.collection(spark, sf_dir))


@register("load_topics")
def load_topics_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topics written in the nested shape (JSON lines), read back and flattened."""
    from parley.sources.topics import load_topics, write_topics

    path = _scratch(spark, "topics-json")
    write_topics(fixtures.topics_nested(fixtures.topics_turns(spark, sf_dir)), path)
    return load_topics(spark, path, multiline=False).select("topic", "turn", "manual", "automatic")


@register("load_qrels")
def load_qrels_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from parley.sources.trec import load_qrels, write_qrels

    path = _scratch(spark, "qrels")
    write_qrels(fixtures.qrels(spark, sf_dir), path)
    return load_qrels(spark, path)


@register("write_run")
def write_run_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S9 lines of the flagship run (tag ``Manual``)."""
    from parley.sources.trec import format_run

    return format_run(bm25_retrieve(spark, sf_dir), "Manual").select("line")


@register("load_run")
def load_run_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from parley.sources.trec import load_run, write_run

    path = _scratch(spark, "run")
    write_run(bm25_retrieve(spark, sf_dir), path, "Manual")
    return load_run(spark, path)


# ----------------------------------------------------------------------------- text
def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.collection(spark, sf_dir)


@register("normalize")
def normalize_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from parley.functions.text import normalize

    return _raw(spark, sf_dir).select("doc_id", normalize("text").alias("norm"))


@register("tokenize")
def tokenize_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from parley.functions.text import normalize, tokenize

    t = tokenize(normalize("text"))
    return _raw(spark, sf_dir).select("doc_id", F.size(t).cast("bigint").alias("n_tokens"), F.array_join(t, " ").alias("tokens"))


@register("remove_stopwords")
def remove_stopwords_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from parley.functions.text import normalize, remove_stopwords, tokenize

    t = remove_stopwords(tokenize(normalize("text")))
    return _raw(spark, sf_dir).select("doc_id", F.size(t).cast("bigint").alias("n_tokens"), F.array_join(t, " ").alias("tokens"))


@register("build_conflation")
def build_conflation_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from parley.operators.conflation import build_conflation
    from parley.plans.corpus import vocabulary

    return build_conflation(vocabulary(_raw(spark, sf_dir)))


@register("conflate")
def conflate_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4 applied to the query side: each benchmark turn's stop-filtered tokens, conflated."""
    c = corpus_for(spark, sf_dir)
    return Q.query_text(bench_turns(spark, sf_dir), c.stem_map, ["qid"])


@register("preprocess")
def preprocess_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from parley.operators.analysis import preprocess

    c = corpus_for(spark, sf_dir)
    return preprocess(_raw(spark, sf_dir).select("doc_id", "text"), ["doc_id"], "text", c.stem_map)


@register("analyze")
def analyze_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from parley.operators.analysis import analyze

    c = corpus_for(spark, sf_dir)
    return analyze(c.collection, ["doc_id"], "data", c.stem_map)


# ----------------------------------------------------------------------------- index
@register("postings")
def postings_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_for(spark, sf_dir).postings.select("doc_id", "term", "tf", "dl")


@register("term_vectors")
def term_vectors_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from parley.operators.index import term_vectors

    return term_vectors(corpus_for(spark, sf_dir).postings)


@register("doc_lengths")
def doc_lengths_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from parley.operators.index import doc_lengths

    return doc_lengths(corpus_for(spark, sf_dir).postings)


@register("term_stats")
def term_stats_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    ts = corpus_for(spark, sf_dir).term_stats
    return ts.select("term", "df", "cf", F.round("idf", 6).alias("idf"))


@register("coll_stats")
def coll_stats_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from parley.operators.index import coll_stats

    s = coll_stats(corpus_for(spark, sf_dir).postings)
    return s.select("n_docs", "sum_dl", F.round("avgdl", 6).alias("avgdl"), "n_terms")


# ----------------------------------------------------------------------------- retrieval
def topic_turns(spark: SparkSession, sf_dir: str, kind: str = "Manual") -> DataFrame:
    return Q.turns_for(fixtures.topics_turns(spark, sf_dir), kind)


@register("select_utterance")
def select_utterance_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Q.select_utterance(fixtures.topics_turns(spark, sf_dir), "Automatic")
    return t.select("topic", "turn", "utterance")


@register("make_qid")
def make_qid_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.make_qid(fixtures.topics_turns(spark, sf_dir)).select("qid", "topic", "turn")


@register("query_terms")
def query_terms_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = corpus_for(spark, sf_dir)
    return Q.query_terms(bench_turns(spark, sf_dir), c.stem_map, ["qid"])


@register("match_any")
def match_any_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q4 summarised per matching (turn, document): number of query terms matched."""
    from pyspark.sql import functions as F

    c = corpus_for(spark, sf_dir)
    qw = Q.query_weights(Q.query_terms(bench_turns(spark, sf_dir), c.stem_map, ["qid"]), c.term_stats)
    m = Q.match_any(qw, c.postings)
    return m.groupBy("qid", "doc_id").agg(F.count(F.lit(1)).alias("n_terms"))


@register("bm25_score")
def bm25_score_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    c = corpus_for(spark, sf_dir)
    qw = Q.query_weights(Q.query_terms(bench_turns(spark, sf_dir), c.stem_map, ["qid"]), c.term_stats)
    s = Q.bm25_score(Q.match_any(qw, c.postings), ["qid"], c.avgdl)
    return s.select("qid", "doc_id", F.round("score", 4).alias("score"))


@register("top_k")
def top_k_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q6 on its own: top 500 of every turn's BM25 scores (no empty-query rows)."""
    c = corpus_for(spark, sf_dir)
    qw = Q.query_weights(Q.query_terms(bench_turns(spark, sf_dir), c.stem_map, ["qid"]), c.term_stats)
    s = Q.bm25_score(Q.match_any(qw, c.postings), ["qid"], c.avgdl)
    return Q.top_k(s, ["qid"], BM25_DEPTH).select("qid", "doc_id", "score", "rank")


@register("empty_query_fallback")
def empty_query_fallback_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q7 over the first line of every document, of which some hold stop words only."""
    from parley.operators.analysis import stem_rows

    c = corpus_for(spark, sf_dir)
    t = Q.turns_for(fixtures.line_turns(spark, sf_dir), "Manual")
    rows = stem_rows(t, ["qid"], "utterance", c.stem_map)
    return Q.empty_query_fallback(t, rows, c.collection, ["qid"], BM25_DEPTH)


@register("bm25_topics")
def bm25_topics_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q8 over every user turn of every conversation (manual utterances), top 500."""
    return Q.bm25_retrieve(topic_turns(spark, sf_dir), corpus_for(spark, sf_dir), BM25_DEPTH)


_INDEXES: dict[tuple[str, str], object] = {}


def _upserted_index(spark: SparkSession, sf_dir: str):
    """The collection's stored index after its update batch; built once per application."""
    from parley.plans.segments import create_index, upsert

    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _INDEXES:
        index = create_index(fixtures.collection(spark, sf_dir), buckets=_buckets(spark, sf_dir))
        _INDEXES[key] = upsert(index, fixtures.upsert_batch(spark, sf_dir))
    return _INDEXES[key]


@register("bm25_upserted")
def bm25_upserted_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q8 over the stored index of the collection, to which the update batch is applied as a
    further segment: of an id that occurs in both, the later row is found."""
    return Q.bm25_retrieve(bench_turns(spark, sf_dir), _upserted_index(spark, sf_dir), BM25_DEPTH)


@register("bm25_compacted")
def bm25_compacted_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q8 over the same index after its segments are merged into one."""
    from parley.plans.segments import compact

    return Q.bm25_retrieve(bench_turns(spark, sf_dir), compact(_upserted_index(spark, sf_dir)), BM25_DEPTH)


@register("upserted_term_stats")
def upserted_term_stats_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I4 of the stored index after the upsert: sums of what segments add and take away."""
    from pyspark.sql import functions as F

    s = _upserted_index(spark, sf_dir).term_stats
    return s.select("term", "df", "cf", F.round("idf", 6).alias("idf"))


@register("bm25_automatic")
def bm25_automatic_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q8 for the automatic utterances."""
    return Q.bm25_retrieve(bench_turns(spark, sf_dir, "Automatic"), corpus_for(spark, sf_dir), BM25_DEPTH)


@register("fetch_documents")
def fetch_documents_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = corpus_for(spark, sf_dir)
    f = Q.fetch_documents(materialize(bm25_retrieve(spark, sf_dir)), c.collection, ("data", "n_tokens"))
    return f.select("qid", "doc_id", "rank", "n_tokens", "data")


# ----------------------------------------------------------------------------- evaluation
def _eval_inputs(spark: SparkSession, sf_dir: str):
    return bm25_retrieve(spark, sf_dir), fixtures.qrels(spark, sf_dir)


@register("eval_recall")
def eval_recall_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from parley.operators import evaluation as E

    return E.recall(*_eval_inputs(spark, sf_dir))


@register("eval_map")
def eval_map_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from parley.operators import evaluation as E

    return E.average_precision(*_eval_inputs(spark, sf_dir))


@register("eval_mrr")
def eval_mrr_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from parley.operators import evaluation as E

    return E.reciprocal_rank(*_eval_inputs(spark, sf_dir))


@register("eval_ndcg_1000")
def eval_ndcg_1000_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from parley.operators import evaluation as E

    return E.ndcg(*_eval_inputs(spark, sf_dir), k=1000)


@register("eval_ndcg_3")
def eval_ndcg_3_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from parley.operators import evaluation as E

    return E.ndcg(*_eval_inputs(spark, sf_dir), k=3)


@register("evaluate")
def evaluate_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from parley.operators import evaluation as E

    return E.evaluate(*_eval_inputs(spark, sf_dir))


@register("evaluate_by_turn")
def evaluate_by_turn_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from parley.operators import evaluation as E

    return E.evaluate_by_turn(*_eval_inputs(spark, sf_dir))


@register("evaluate_by_topic")
def evaluate_by_topic_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from parley.operators import evaluation as E

    return E.evaluate_by_topic(*_eval_inputs(spark, sf_dir))


# ----------------------------------------------------------------------------- re-ranking
def _pairs(spark: SparkSession, sf_dir: str, depth: int):
    from parley.operators import rerank as R

    c = corpus_for(spark, sf_dir)
    turns = bench_turns(spark, sf_dir)
    from parley.plans.sizing import materialize

    bm = bm25_retrieve(spark, sf_dir) if depth == BM25_DEPTH else Q.bm25_retrieve(turns, c, depth)
    return c, turns, materialize(R.candidates(bm, ["qid"])), materialize(Q.query_text(turns, c.stem_map, ["qid"]))


@register("rerank_policy")
def rerank_policy_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both branches of the depth policy, labelled with the model each picks."""
    from pyspark.sql import functions as F

    from parley.operators.rerank import rerank_model
    from parley.plans.pipelines import rerank

    c, turns = corpus_for(spark, sf_dir), bench_turns(spark, sf_dir)
    out = None
    for k, kb in ((500, 500), (500, 2500)):
        r = rerank(turns, c, k, kb).withColumn("model", F.lit(rerank_model(k, kb)))
        out = r if out is None else out.unionByName(r)
    return out


@register("build_pairs")
def build_pairs_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from parley.operators import rerank as R

    c, _, pairs, qtext = _pairs(spark, sf_dir, BM25_DEPTH)
    return R.build_pairs(pairs, qtext, c.collection, ["qid"]).select("qid", "doc_id", "base_rank", "query_text", "data")


@register("embed")
def embed_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R3 built-in encoder over every stored passage, as non-zero (slot, weight) entries."""
    from pyspark.sql import functions as F

    from parley.operators import rerank as R

    c = corpus_for(spark, sf_dir)
    e = c.doc_vectors.select("doc_id", F.explode(F.arrays_zip("slots", "weights")).alias("e"))
    return e.select("doc_id", F.col("e.slots").cast("bigint").alias("slot"), F.round("e.weights", 6).alias("weight")).where(
        F.col("weight") != 0)


@register("dot_rerank")
def dot_rerank_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from parley.operators import rerank as R

    c, _, pairs, qtext = _pairs(spark, sf_dir, BM25_DEPTH)
    return R.bi_encoder_scores(pairs, qtext, c, ["qid"]).select("qid", "doc_id", "score")


@register("rank_by_score")
def rank_by_score_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dot scores re-ordered (ties keep the BM25 order), best 500 kept."""
    from parley.operators import rerank as R

    c, _, pairs, qtext = _pairs(spark, sf_dir, BM25_DEPTH)
    r = R.rank_by_score(R.bi_encoder_scores(pairs, qtext, c, ["qid"]), ["qid"], BM25_DEPTH)
    return r.select("qid", "doc_id", "score", "rank")


@register("pair_features")
def pair_features_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from parley.operators import rerank as R

    c, _, pairs, qtext = _pairs(spark, sf_dir, DEEP_DEPTH)
    f = R.pair_features(pairs, qtext, c, ["qid"])
    return f.select("qid", "doc_id", *[F.round(x, 6).alias(x) if x != "bigrams" else F.col(x) for x in R.FEATURES])


@register("pair_rerank")
def pair_rerank_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from parley.operators import rerank as R

    c, _, pairs, qtext = _pairs(spark, sf_dir, DEEP_DEPTH)
    return R.pair_rerank(R.pair_features(pairs, qtext, c, ["qid"])).select("qid", "doc_id", "score")


@register("query_likelihood")
def query_likelihood_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from parley.operators import rerank as R

    c, turns, pairs, _ = _pairs(spark, sf_dir, BM25_DEPTH)
    return R.query_likelihood(pairs, turns, c, ["qid"]).select("qid", "doc_id", "score")


@register("deep_rank")
def deep_rank_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """500 of 2,500 by the pair scorer (manual utterances)."""
    from parley.plans.pipelines import rerank

    return rerank(bench_turns(spark, sf_dir), corpus_for(spark, sf_dir), 500, DEEP_DEPTH)


@register("rerank_same_depth")
def rerank_same_depth_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """500 of 500 by the bi-encoder dot product (manual utterances)."""
    from parley.plans.pipelines import rerank

    return rerank(bench_turns(spark, sf_dir), corpus_for(spark, sf_dir), 500, 500)


@register("ql_rerank")
def ql_rerank_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query likelihood over BM25's 500 (manual utterances), all kept."""
    from parley.plans.pipelines import ql_rerank

    return ql_rerank(bench_turns(spark, sf_dir), corpus_for(spark, sf_dir), BM25_DEPTH)


@register("deep_rank_automatic")
def deep_rank_automatic_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from parley.plans.pipelines import rerank

    return rerank(bench_turns(spark, sf_dir, "Automatic"), corpus_for(spark, sf_dir), 500, DEEP_DEPTH)


@register("rerank_same_depth_automatic")
def rerank_same_depth_automatic_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from parley.plans.pipelines import rerank

    return rerank(bench_turns(spark, sf_dir, "Automatic"), corpus_for(spark, sf_dir), 500, 500)


@register("ql_rerank_automatic")
def ql_rerank_automatic_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from parley.plans.pipelines import ql_rerank

    return ql_rerank(bench_turns(spark, sf_dir, "Automatic"), corpus_for(spark, sf_dir), BM25_DEPTH)


@register("compare_systems")
def compare_systems_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """{bm25, bert_rerank, bert_deep, t5} x {Manual, Automatic}, overall / per turn / per topic."""
    from parley.operators.evaluation import evaluate_scoped
    from parley.plans.pipelines import system_runs

    runs = system_runs(fixtures.queries(spark, sf_dir), corpus_for(spark, sf_dir))
    return evaluate_scoped(runs, fixtures.qrels(spark, sf_dir), ["system", "kind"])


# ----------------------------------------------------------------------------- dense vectors
EMBEDDING_TOP_K = 10


@register("embedding_topk")
def embedding_topk_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R4 on ``embeddings``: per label, the 10 vectors with the largest dot product with the label centroid."""
    from parley.operators.dense import group_topk

    return group_topk(fixtures.table(spark, sf_dir, "embeddings"), EMBEDDING_TOP_K)


# ----------------------------------------------------------------------------- streaming ingest
@register("stream_ingest")
def stream_ingest_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages arrive as two files (every document; then updates of the labelled ones and
    new passages from ``benchmark``), each ingested by its own streaming run."""
    from pyspark.sql import functions as F

    from parley.streaming.ingest import read_ingested, start_ingest

    docs = fixtures.table(spark, sf_dir, "documents")
    src, table, ckpt = _scratch(spark, "stream-src"), _scratch(spark, "stream-table"), _scratch(spark, "stream-ckpt")
    first = fixtures.passage_lines(docs)
    labelled = fixtures.table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("id")).distinct()
    updates = first.select(F.split("value", "\t").getItem(0).alias("id"), F.split("value", "\t").getItem(1).alias("t")).join(
        labelled, "id", "left_semi").select(F.concat_ws("\t", "id", F.concat(F.lit("updated "), F.col("t"))).alias("value"))
    new = fixtures.table(spark, sf_dir, "benchmark").select(
        F.concat_ws("\t", F.concat(F.lit("B"), F.col("item_id").cast("string")),
                    F.regexp_replace("text", r"[\t\n\r]", " ")).alias("value"))
    for part in (first, updates.unionByName(new)):
        # a new file lands in the watched folder; one streaming run picks up what is new
        part.write.mode("append").text(src)
        start_ingest(spark, src, table, ckpt).awaitTermination()
    return read_ingested(spark, table)

import math

import numpy as np
import pytest

from parley.operators import rerank as R
from parley.operators import retrieval as Q


def test_depth_policy():
    assert R.rerank_model(500, 500) == "bi_encoder"
    assert R.rerank_model(500, 2500) == "cross_encoder"
    with pytest.raises(ValueError):
        R.rerank_model(10, 5)


def test_ties_keep_baseline_order(spark):
    s = spark.createDataFrame([("q", "a", 3, 1.0), ("q", "b", 1, 1.0), ("q", "c", 2, 1.0)],
                              "qid string, doc_id string, base_rank long, score double")
    order = [r["doc_id"] for r in R.rank_by_score(s, ["qid"]).orderBy("rank").collect()]
    assert order == ["b", "c", "a"]


def _pairs(spark, small_corpus, text):
    turns = Q.turns_for(spark.createDataFrame([(1, 1, text, text)], "topic long, turn long, manual string, automatic string"), "Manual")
    bm = Q.bm25_retrieve(turns, small_corpus, 10)
    return turns, R.candidates(bm, ["qid"]), Q.query_text(turns, small_corpus.stem_map, ["qid"])


def test_query_likelihood_finite_for_docs_without_terms(spark, small_corpus):
    turns = Q.turns_for(spark.createDataFrame([(1, 1, "zebra throat", "")], "topic long, turn long, manual string, automatic string"), "Manual")
    pairs = spark.createDataFrame([("1_1", "MARCO_3", 1.0, 1), ("1_1", "MARCO_1", 2.0, 2)],
                                  "qid string, doc_id string, base_score double, base_rank long")
    got = {r["doc_id"]: r["score"] for r in R.query_likelihood(pairs, turns, small_corpus, ["qid"]).collect()}
    assert all(math.isfinite(v) for v in got.values())
    assert got["MARCO_1"] > got["MARCO_3"]


def test_dot_and_pair_scores(spark, small_corpus):
    turns, pairs, qtext = _pairs(spark, small_corpus, "throat cancer treatment")
    d = {r["doc_id"]: r["score"] for r in R.bi_encoder_scores(pairs, qtext, small_corpus, ["qid"]).collect()}
    assert all(-1.0001 <= v <= 1.0001 for v in d.values())
    f = {r["doc_id"]: r for r in R.pair_features(pairs, qtext, small_corpus, ["qid"]).collect()}
    assert f["MARCO_1"]["coverage"] == pytest.approx(2 / 3)
    assert f["MARCO_1"]["bigrams"] == 1  # "throat cancer" adjacent
    s = R.pair_rerank(R.pair_features(pairs, qtext, small_corpus, ["qid"]))
    assert s.count() == pairs.count()  # same-depth re-rank keeps the candidate set


def test_embedding_hook(spark):
    df = spark.createDataFrame([("a b",), ("c",)], "t string")

    def enc(texts):
        return np.array([[len(t), 1.0] for t in texts])

    got = [r["vec"] for r in R.embed_with(df, "t", enc).collect()]
    assert sorted(got) == [[1.0, 1.0], [3.0, 1.0]]


def test_pair_score_hook(spark):
    pairs = spark.createDataFrame([("q", "d1", "x y", "x"), ("q", "d2", "x y", "z")],
                                  "qid string, doc_id string, query_text string, data string")

    def score(qs, ps):
        return [len(set(q.split()) & set(p.split())) for q, p in zip(qs, ps)]

    got = {r["doc_id"]: r["score"] for r in R.pair_scores_with(pairs, score).collect()}
    assert got == {"d1": 1.0, "d2": 0.0}


def test_models_in_the_pipeline_are_built_once_per_worker(spark, small_corpus, tmp_path):
    from parley.plans.pipelines import rerank

    log = str(tmp_path / "built")

    def scorer():
        with open(log, "a") as f:
            f.write("x")
        return lambda queries, passages: [float(len(p)) for p in passages]

    def encoder():
        return lambda texts: [[1.0, float(len(t))] for t in texts]

    turns = Q.turns_for(spark.createDataFrame([(1, 1, "throat cancer", "x"), (2, 1, "growing gardens", "y")], "topic long, turn long, manual string, automatic string"), "Manual")
    data = {r["doc_id"]: r["data"] for r in small_corpus.collection.collect()}
    got = rerank(turns, small_corpus, 3, 5, scorer=scorer).collect()
    assert got and all(r["score"] == len(data[r["doc_id"]]) for r in got)
    workers = spark.sparkContext.defaultParallelism
    rerank(turns, small_corpus, 3, 5, scorer=scorer).collect()
    assert 1 <= len(open(log).read()) <= 2 * workers
    text = {r["qid"]: r["query_text"] for r in Q.query_text(turns, small_corpus.stem_map, ["qid"]).collect()}
    got = rerank(turns, small_corpus, 5, 5, encoder=encoder).collect()
    assert got and all(r["score"] == 1.0 + len(data[r["doc_id"]]) * len(text[r["qid"]]) for r in got)
    with pytest.raises(ValueError):
        R.embed_with(small_corpus.collection, "data")


def test_query_likelihood_of_analyzed_tokens(spark, small_corpus):
    turns, pairs, qtext = _pairs(spark, small_corpus, "the throat")
    raw = {r["doc_id"]: r["score"] for r in R.query_likelihood(pairs, turns, small_corpus, ["qid"]).collect()}
    own = {r["doc_id"]: r["score"] for r in R.query_likelihood(pairs, qtext, small_corpus, ["qid"], text_col="query_text", query_tokens="analyzed").collect()}
    assert set(raw) == set(own) and all(own[d] > raw[d] for d in raw)  # one token less
    with pytest.raises(ValueError):
        R.query_likelihood(pairs, turns, small_corpus, ["qid"], query_tokens="other")

import pytest
from pyspark.sql import functions as F

from parley.operators import retrieval as Q


def _turns(spark, rows):
    return spark.createDataFrame(rows, "topic long, turn long, manual string, automatic string")


def test_bad_utterance_kind(spark):
    with pytest.raises(ValueError):
        Q.select_utterance(_turns(spark, [(1, 1, "a", "b")]), "Other")


def test_make_qid_keeps_last(spark):
    t = spark.createDataFrame([(1, 1, "first", "x", 0, 0), (1, 1, "second", "x", 1, 0)],
                              "topic long, turn long, manual string, automatic string, pos_topic long, pos_turn long")
    r = Q.make_qid(t).collect()
    assert len(r) == 1 and r[0]["qid"] == "1_1" and r[0]["manual"] == "second"


def test_repeated_query_term_counts_twice(spark, small_corpus):
    t = Q.turns_for(_turns(spark, [(1, 1, "throat throat cancer", "")]), "Manual")
    got = {r["term"]: r["qtf"] for r in Q.query_terms(t, small_corpus.stem_map, ["qid"]).collect()}
    assert got["throat"] == 2 and got["cancer"] == 1


def test_bm25_ranks_and_fallback(spark, small_corpus):
    t = Q.turns_for(_turns(spark, [(1, 1, "throat cancer", ""), (1, 2, "What is it about?", "")]), "Manual")
    r = Q.bm25_retrieve(t, small_corpus, 3).orderBy("qid", "rank").collect()
    q1 = [x["doc_id"] for x in r if x["qid"] == "1_1"]
    assert q1[0] == "MARCO_1"  # both terms, twice each
    assert set(q1) <= {"MARCO_1", "MARCO_2", "CAR_4"}
    q2 = [(x["doc_id"], x["score"], x["rank"]) for x in r if x["qid"] == "1_2"]
    # no terms at all: match-all, first ids in order, score 1.0
    assert q2 == [("CAR_4", 1.0, 1), ("CAR_5", 1.0, 2), ("CAR_6", 1.0, 3)]


def test_bm25_independent_of_partitioning(spark, small_corpus):
    t = Q.turns_for(_turns(spark, [(1, 1, "throat cancer", ""), (2, 1, "growing gardens", "")]), "Manual")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        res = []
        for n in ("1", "16"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            res.append(sorted(tuple(x) for x in Q.bm25_retrieve(t, small_corpus, 10).collect()))
        assert res[0] == res[1]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_fetch_documents(spark, small_corpus):
    ranking = spark.createDataFrame([("1_1", "MARCO_1", 1.0, 1)], "qid string, doc_id string, score double, rank long")
    r = Q.fetch_documents(ranking, small_corpus.collection).first()
    assert r["data"].startswith("throat cancer")


def test_corpus_reused_from_manifest(spark):
    from parley.plans import corpus as C

    sf = "/root/testdata/sf0.001"
    first = C.corpus_for(spark, sf)
    C._CACHE.clear()  # as a new application would start
    again = C.corpus_for(spark, sf)
    assert again is not first
    assert (again.n_docs, again.sum_dl, again.text_vocab) == (first.n_docs, first.sum_dl, first.text_vocab)
    assert sorted(tuple(r) for r in again.postings.collect()) == sorted(tuple(r) for r in first.postings.collect())


def test_bucket_count_follows_the_bytes(spark):
    from parley.plans.corpus import BUCKET_BYTES, bucket_count

    small = min(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    assert bucket_count(spark, 0) == bucket_count(spark, BUCKET_BYTES) == small
    assert bucket_count(spark, 10**15) == -(-(10**15) // BUCKET_BYTES)  # no setting caps it


def test_repeated_id_keeps_the_last_row(spark):
    from parley.plans.corpus import build_corpus

    rows = [("A1", "throat cancer treatment", "X", 1), ("A1", "growing tomatoes", "X", 2), ("A2", "cancer research", "X", 1)]
    c = build_corpus(spark.createDataFrame(rows, "doc_id string, text string, source string, batch_id bigint"))
    got = {r["doc_id"]: r["data"] for r in c.collection.collect()}
    assert set(got) == {"A1", "A2"} and "tomato" in got["A1"] and "cancer" not in got["A1"]
    assert c.n_docs == 2
    t = Q.turns_for(_turns(spark, [(1, 1, "cancer", "")]), "Manual")
    assert [r["doc_id"] for r in Q.bm25_retrieve(t, c, 5).collect()] == ["A2"]


def test_preprocess_with_a_repeated_key(spark, small_corpus):
    from parley.operators.analysis import preprocess

    docs = spark.createDataFrame([("d", "growing gardens"), ("d", "cancer treatments"), ("e", "growing gardens")], "doc_id string, text string")
    got = sorted((r["doc_id"], r["data"]) for r in preprocess(docs, ["doc_id"], "text", small_corpus.stem_map).collect())
    assert len(got) == 3 and got[2][1] in {got[0][1], got[1][1]}


def test_repeated_qid_is_deterministic(spark):
    turns = spark.createDataFrame([(1, 1, "a", "x"), (1, 1, "c", "y"), (1, 1, "b", "z")], "topic long, turn long, manual string, automatic string")
    for n in (1, 3):
        assert [r["manual"] for r in Q.make_qid(turns.repartition(n)).collect()] == ["c"]


def test_large_query_batches_never_shuffle_the_index(spark, small_corpus, monkeypatch):
    from parley.plans import sizing

    t = Q.turns_for(_turns(spark, [(k, 1, x, "") for k, x in enumerate(["throat cancer", "growing gardens", "sore throats", "research"])]), "Manual")
    whole = sorted(tuple(r) for r in Q.bm25_retrieve(t, small_corpus, 5).collect())
    monkeypatch.setattr(sizing, "MAX_BROADCAST_ROWS", 4)
    parts = Q.bm25_retrieve(t, small_corpus, 5)
    assert sorted(tuple(r) for r in parts.collect()) == whole
    plan = parts._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(term" not in plan


def test_nothing_stays_cached(spark, small_corpus):
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    t = Q.turns_for(_turns(spark, [(1, 1, "throat cancer", "")]), "Manual")
    Q.bm25_retrieve(t, small_corpus, 5).collect()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before

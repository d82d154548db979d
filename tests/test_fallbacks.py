"""Every size-checked broadcast has a shuffle-join path beyond its bound; it must give the
same answers.  Here the bound is 0 and automatic broadcasting is off, so every join shuffles."""

from parley.operators import rerank as R
from parley.operators import retrieval as Q
from parley.plans import sizing


def _all(spark, corpus):
    turns = Q.turns_for(spark.createDataFrame(
        [(1, 1, "throat cancer treatment", "x"), (1, 2, "growing gardens", "y"), (2, 1, "What is it?", "z")],
        "topic long, turn long, manual string, automatic string"), "Manual")
    bm = Q.bm25_retrieve(turns, corpus, 5)
    pairs = R.candidates(bm, ["qid"])
    qtext = Q.query_text(turns, corpus.stem_map, ["qid"])
    out = {
        "bm25": bm,
        "dot": R.bi_encoder_scores(pairs, qtext, corpus, ["qid"]),
        "pair": R.pair_rerank(R.pair_features(pairs, qtext, corpus, ["qid"])),
        "ql": R.query_likelihood(pairs, turns, corpus, ["qid"]),
    }
    return {k: sorted(tuple(r) for r in v.collect()) for k, v in out.items()}


def test_shuffle_paths_match_broadcast_paths(spark, small_corpus, monkeypatch):
    expected = _all(spark, small_corpus)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    import weakref

    from parley.operators import conflation

    monkeypatch.setattr(sizing, "MAX_BROADCAST_ROWS", 0)
    monkeypatch.setattr(conflation, "_FITS", weakref.WeakKeyDictionary())  # re-measure maps under the new bound
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = _all(spark, small_corpus)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert got == expected
    assert len(expected["bm25"]) > 0 and len(expected["pair"]) == len(expected["bm25"])

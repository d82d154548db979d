"""Plan-shape guards: the properties the scale design relies on."""

import re

from parley.operators import retrieval as Q


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_bm25_scoring_is_bucket_local(spark, small_corpus):
    turns = Q.turns_for(spark.createDataFrame([(1, 1, "throat cancer", "")],
                                              "topic long, turn long, manual string, automatic string"), "Manual")
    qw = Q.query_weights(Q.query_terms(turns, small_corpus.stem_map, ["qid"]), small_corpus.term_stats)
    scores = Q.bm25_score(Q.match_any(qw, small_corpus.postings), ["qid"], small_corpus.avgdl)
    plan = _plan(scores)
    assert "Bucketed: true" in plan  # postings read with their doc_id bucketing
    assert not re.search(r"Exchange hashpartitioning\([^)]*doc_id", plan)  # no shuffle of postings/matches
    assert "BroadcastHashJoin" in plan


def test_top_k_has_partial_limit_before_shuffle(spark, small_corpus):
    turns = Q.turns_for(spark.createDataFrame([(1, 1, "throat cancer", "")],
                                              "topic long, turn long, manual string, automatic string"), "Manual")
    plan = _plan(Q.bm25_retrieve(turns, small_corpus, 2500))
    assert "WindowGroupLimit" in plan


def test_postings_of_reads_only_ranges_of_terms(spark, small_corpus):
    from pyspark.sql import functions as F

    all_terms = sorted(r["term"] for r in small_corpus.term_stats.collect())
    for terms in ([all_terms[0]], all_terms[2:7], all_terms, ["zzz not there"]):
        qw = spark.createDataFrame([("q", t, 1) for t in terms], "qid string, term string, qtf long")
        pruned = Q.postings_of(small_corpus.postings, qw)
        assert "PushedFilters: [" in _plan(pruned) and "term" in re.search(r"PushedFilters: \[([^]]*)", _plan(pruned))[1]
        if len(terms) <= Q.KEY_RANGES:  # each term its own range: nothing else passes
            assert {r["term"] for r in pruned.collect()} == set(terms) & set(all_terms)
        want = small_corpus.postings.where(F.col("term").isin(terms)).count()
        assert pruned.join(qw, "term").count() == want
    empty = spark.createDataFrame([], "qid string, term string, qtf long")
    assert Q.postings_of(small_corpus.postings, empty).count() == 0


def test_key_ranges_hold_every_key_of_a_large_set(spark):
    keys = spark.range(5000).selectExpr("concat('k', cast(id * 7 as string)) AS k")
    assert keys.where(Q.key_ranges(keys, "k")).count() == 5000
    few = spark.createDataFrame([("k14",), ("k70",), (None,)], "k string")
    assert {r["k"] for r in keys.where(Q.key_ranges(few, "k")).collect()} == {"k14", "k70"}


def test_passage_vectors_shuffle_only_rare_terms(spark):
    from pyspark.sql import functions as F

    from parley.operators.index import doc_vectors, text_stats

    rows = [(f"d{i}", t, 1 + i % 3) for i in range(60) for t in ("the", "of", f"w{i}", f"p{i // 2}")]
    postings = spark.createDataFrame(rows, "doc_id string, term string, tf long")
    stats = text_stats(postings.withColumn("first_pos", F.lit(0)), 60)
    near = lambda df: {r["doc_id"]: (r["slots"], [round(w, 9) for w in r["weights"]]) for r in df.collect()}
    split = doc_vectors(postings, stats, len(rows), frequent=10)  # "the" and "of" are frequent
    assert near(split) == near(doc_vectors(postings, stats, len(rows), frequent=10**6)) == near(doc_vectors(postings, stats, len(rows), frequent=1))
    plan = _plan(split)
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan and "SortMergeJoin" in plan


def test_passage_vectors_are_summed_in_blocks_of_documents(spark, monkeypatch):
    import math

    from pyspark.sql import functions as F

    from parley.operators import index

    monkeypatch.setattr(index, "VECTORS", 7, raising=False)
    rows = [(f"d{i}", t, 1 + i % 3) for i in range(60) for t in (*(("the", "of") if i % 5 else ()), f"w{i}", f"p{i // 2}")]
    postings = spark.createDataFrame(rows, "doc_id string, term string, tf long")
    stats = index.text_stats(postings.withColumn("first_pos", F.lit(0)), 60)
    of = {r["term"]: r for r in stats.collect()}
    want = {}
    for d, t, tf in rows:
        v = want.setdefault(d, {})
        v[of[t]["slot"]] = v.get(of[t]["slot"], 0.0) + (1 + math.log(tf)) * of[t]["idf"] * of[t]["sign"]
    made = index.doc_vectors(postings, stats, len(rows), frequent=10)
    got = {r["doc_id"]: dict(zip(r["slots"], r["weights"])) for r in made.collect()}
    assert got.keys() == want.keys()
    for d, v in want.items():
        norm = math.sqrt(sum(w * w for w in v.values()))
        assert got[d].keys() == v.keys() and all(abs(got[d][s] - (w / norm if norm else 0.0)) < 1e-12 for s, w in v.items())
    assert _plan(made).count("Generate") == 0  # no row per slot of a document


def test_postings_come_in_term_order(small_corpus):
    """Each block's rows are in the order of the stored table, whose sort then merges runs."""
    import pyarrow as pa

    from parley.operators.blocks import Tokens
    from parley.operators.index import build_postings

    assert Tokens(["b", "é", "a", "Z"], [], [], 0).ranks().tolist() == [2, 3, 1, 0]
    rows = build_postings(small_corpus.collection.coalesce(1), small_corpus.stem_map).select("term").toArrow()
    terms = rows.column(0).combine_chunks().cast(pa.string()).to_pylist()
    assert len(terms) > 10 and terms == sorted(terms)

"""The corpus build: blocks of texts against per-token rows, and what a query builds at all."""

import os
import re

import pyarrow as pa

from parley.operators import blocks
from parley.operators.analysis import clean_tokens, cleaned, preprocess_clean
from parley.operators.index import build_postings, text_bigrams, text_postings


def _texts(spark):
    odd = ["Throat cancers,  THROAT-cancer’s “growing”", "", None, "the of", "a1 é b2 a1\tÄb2\n a1", " x " * 300, "ganz ñandú año 1_2"]
    return spark.createDataFrame([(f"d{i}", t) for i, t in enumerate(odd)], "doc_id string, text string")


def test_blocks_match_expressions(spark, monkeypatch):
    from pyspark.sql import functions as F

    df = _texts(spark).coalesce(1)
    want = {r["doc_id"]: r["c"] or "" for r in df.select("doc_id", F.array_join(clean_tokens("text"), " ").alias("c")).collect()}
    got = {r["doc_id"]: r["clean"] for r in cleaned(df, "text").collect()}
    assert got == want
    assert got["d4"] == "a1 b2 a1 b2 a1"


def test_texts_longer_than_a_block_and_sliced_columns(monkeypatch):
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 8)
    column = pa.array(["zz", "aaa bbb ccc ddd", None, "", "B-b", "c"]).slice(1)
    parts = [column.slice(i, n) for i, n in blocks.blocks(column)]
    assert sum(len(p) for p in parts) == 5 and len(parts) > 1
    assert [t for p in parts for t in blocks.Tokens.split(p, raw=True).joined().to_pylist()] == ["aaa bbb ccc ddd", "", "", "b b", "c"]


def test_counts_and_pairs_by_hand(spark):
    docs = spark.createDataFrame([("d", "a b a b c"), ("e", ""), ("f", "c")], "doc_id string, data string").coalesce(1)
    assert {tuple(r) for r in text_postings(docs).collect()} == {("d", "a", 2, 0), ("d", "b", 2, 1), ("d", "c", 1, 4), ("f", "c", 1, 0)}
    assert {tuple(r) for r in text_bigrams(docs).collect()} == {("d", "a", "b", 0), ("d", "b", "a", 1), ("d", "b", "c", 3)}


def test_analysis_of_a_collection_moves_no_row(spark, small_corpus):
    """Per-token rows, their aggregates and sorts over a whole bucket were what grew faster than the input."""
    raw = spark.createDataFrame([("d", "growing gardens")], "doc_id string, clean string")
    for df in (preprocess_clean(raw, ["doc_id"], "clean", small_corpus.stem_map), build_postings(small_corpus.collection, small_corpus.stem_map)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "MapInArrow" in plan and not re.search("Exchange|Aggregate|Sort|Window|Generate", plan)


def test_maps_too_large_to_send_give_the_same_rows(spark, small_corpus, monkeypatch):
    import weakref

    from parley.operators import conflation
    from parley.plans import sizing

    raw = spark.createDataFrame([("d", "growing gardens treatments"), ("e", "cancer")], "doc_id string, clean string")
    rows = lambda: (sorted(map(tuple, preprocess_clean(raw, ["doc_id"], "clean", small_corpus.stem_map).collect())),
                    sorted(map(tuple, build_postings(small_corpus.collection, small_corpus.stem_map).collect())))
    want = rows()
    monkeypatch.setattr(sizing, "MAX_BROADCAST_ROWS", 0)
    monkeypatch.setattr(conflation, "_FITS", weakref.WeakKeyDictionary())
    assert rows() == want


def test_a_bucket_holds_little_and_retrieval_writes_no_reranker_tables(spark):
    from parley.plans.corpus import bucket_count, build_corpus

    assert bucket_count(spark, 1 << 30) >= 64
    c = build_corpus(spark.createDataFrame([("A", "throat cancer", "X", 1)], "doc_id string, text string, source string, batch_id bigint"))
    root = re.sub("^file:/*", "/", c.root)
    written = lambda: {n.split("-")[0] for n in os.listdir(root)}
    assert "postings" in written() and not written() & {"text_postings", "text_bigrams", "text_stats", "doc_vectors"}
    assert c.text_vocab == 2 and "text_stats" in written()


def test_judgements_are_counted_within_parts_of_documents(spark, monkeypatch):
    """The sums per (query, document) are as many as queries x documents; they are not exchanged."""
    from parley.sources import fixtures

    plans = []
    kept = fixtures.materialize
    monkeypatch.setattr(fixtures, "materialize", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or kept(df))
    rows = fixtures.qrels(spark, "/root/testdata/sf0.001").collect()
    assert rows and {r["rel"] for r in rows} <= {0, 1, 2}
    assert not re.search(r"hashpartitioning\(qid[^)]*doc_id", plans[-1])


def test_bigrams_are_found_in_texts_as_in_the_table(spark):
    from parley.operators.index import bigrams_found

    docs = spark.createDataFrame([("d", "a b a b c"), ("e", "b c a"), ("f", ""), ("g", "a"), ("h", "c b x a b")], "doc_id string, data string").coalesce(1)
    wanted = [("a", "b"), ("c", "a"), ("b", "nowhere"), ("x", "b")]
    want = {tuple(r) for r in text_bigrams(docs).collect() if (r["a"], r["b"]) in wanted}
    got = [tuple(r) for r in bigrams_found(docs, spark.sparkContext.broadcast(wanted)).collect()]
    assert set(got) == want and len(got) == len(want) == 3
    assert not bigrams_found(docs, spark.sparkContext.broadcast([])).count()


def test_the_pair_scorer_writes_no_table_of_all_bigrams(spark, small_corpus):
    from parley.operators import rerank as R
    from parley.operators import retrieval as Q

    turns = spark.createDataFrame([("q", "throat cancer treatments")], "qid string, utterance string")
    pairs = R.candidates(Q.bm25_retrieve(turns, small_corpus, 5), ["qid"])
    f = R.pair_features(pairs, Q.query_text(turns, small_corpus.stem_map, ["qid"]), small_corpus, ["qid"])
    assert {r["doc_id"]: r["bigrams"] for r in f.collect()}["MARCO_1"] == 1
    assert "text_bigrams" not in vars(small_corpus)

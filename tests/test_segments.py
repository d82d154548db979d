"""The stored index after upserts against an index built anew from the rows that are left."""

import random

import pytest

from parley.operators import retrieval as Q
from parley.plans import segments as S
from parley.session import scratch_path

SCHEMA = "doc_id string, text string, source string, batch_id bigint"
STEMS = ["walk", "garden", "cancer", "tomato", "treat", "grow", "sing", "quick"]
ENDS = ["", "s", "ing", "ed", "ly", "ment"]


def _texts(rnd, n):
    return " ".join(rnd.choice(STEMS) + rnd.choice(ENDS) for _ in range(n))


def _state(index):
    posts = sorted(tuple(r) for r in index.postings.select("doc_id", "term", "tf", "dl").collect())
    stats = sorted((r["term"], r["df"], r["cf"], round(r["idf"], 9)) for r in index.term_stats.collect())
    stems = sorted(tuple(r) for r in index.stem_map.select("surface", "stem").collect())
    data = sorted(tuple(r) for r in index.collection.select("doc_id", "data", "batch_id").collect())
    return posts, stats, stems, data, index.n_docs, index.sum_dl


def test_upserts_and_compaction_equal_a_rebuild(spark):
    rnd = random.Random(1)
    current = {f"d{i}": (_texts(rnd, rnd.randint(0, 6)), 1) for i in range(40)}
    frame = lambda rows: spark.createDataFrame([(i, t, "S", b) for i, (t, b) in rows.items()], SCHEMA)
    index = S.create_index(frame(current), buckets=3)
    batches = [
        {**{f"d{i}": (_texts(rnd, 5), 2) for i in range(0, 40, 9)}, "n1": ("zebras zebra tomatoes", 2)},
        {"d0": ("", 3), "n1": ("the of", 3), "n2": ("zebra walkment", 3), "d9": ("of an older batch", 0)},
    ]
    for batch in batches:
        index = S.upsert(index, frame(batch))
        current.update({i: r for i, r in batch.items() if i not in current or r[1] >= current[i][1]})
        assert _state(index) == _state(S.create_index(frame(current), buckets=3))
    assert len(index.names) == 3
    turns = spark.createDataFrame([("q", "gardens walking zebra"), ("e", "the")], "qid string, utterance string")
    before = sorted(tuple(r) for r in Q.bm25_retrieve(turns, index, 10).collect())
    merged = S.compact(index)
    assert merged.names == ["segment-3"] and _state(merged) == _state(index)
    assert sorted(tuple(r) for r in Q.bm25_retrieve(turns, merged, 10).collect()) == before and len(before) > 10
    # found again by its folder; the older version's tables are still there
    assert S.open_index(spark, index.root).names == merged.names and index.postings.count() > 0


def test_upsert_writes_its_documents_only_and_appears_at_once(spark, monkeypatch):
    rows = [(f"d{i}", f"alone{i} alone{i}", "S", 1) for i in range(30)]
    index = S.create_index(spark.createDataFrame(rows, SCHEMA), buckets=2)
    first = S.upsert(index, spark.createDataFrame([("d3", "changed", "S", 2)], SCHEMA))
    assert first.table("segment-1", "raw").count() == 1  # no other document is affected
    assert {r["doc_id"] for r in first.table("segment-1", "tombstones").collect()} == {"d3"}
    with monkeypatch.context() as m:
        m.setattr(S, "publish", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            S.upsert(first, spark.createDataFrame([("d4", "changed", "S", 3)], SCHEMA))
    assert S.open_index(spark, index.root).names == first.names
    with pytest.raises(ValueError):
        S.open_index(spark, scratch_path(spark, "nothing"))


def test_scoring_of_segments_is_bucket_local(spark):
    rows = [(f"d{i}", "walks walked tomatoes tomato walk", "S", 1) for i in range(4)]
    index = S.upsert(S.create_index(spark.createDataFrame(rows, SCHEMA), buckets=2), spark.createDataFrame([("d1", "walk", "S", 2)], SCHEMA))
    turns = spark.createDataFrame([("q", "walking")], "qid string, utterance string")
    plan = Q.bm25_retrieve(turns, index, 10)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(doc_id" not in plan and "ShuffledHashJoin" in plan and plan.count("Bucketed: true") >= 3


def test_postings_of_segments_count_as_bucketed(spark, monkeypatch):
    from parley.operators import scoring

    rows = [(f"d{i}", "walks walked tomatoes tomato walk " + "garden " * i, "S", 1) for i in range(6)]
    index = S.upsert(S.create_index(spark.createDataFrame(rows, SCHEMA), buckets=2), spark.createDataFrame([("d1", "walk zebra", "S", 2)], SCHEMA))
    assert len(index.segments) == 2 and all(map(scoring.in_buckets, index.segments))
    assert not scoring.in_buckets(index.postings.repartition(2, "term"))
    turns = spark.createDataFrame([("q", "walk garden zebra")], "qid string, utterance string")
    got = sorted(map(tuple, Q.bm25_retrieve(turns, index, 10).collect()))
    monkeypatch.setattr(Q, "in_buckets", lambda t: False)
    assert got == sorted(map(tuple, Q.bm25_retrieve(turns, index, 10).collect())) and len(got) == 6


def test_surfaces_hold_the_words_of_each_block_in_order(spark):
    rows = [("d1", "Walks walked WALKS", "S", 1), ("d2", "walks", "S", 1), ("d3", "", "S", 1)]
    index = S.create_index(spark.createDataFrame(rows, SCHEMA), buckets=1)
    held = [(r["term"], r["df"], sorted(r["docs"])) for r in index.surfaces("segment-0").collect()]
    assert held == [("walked", 1, ["d1"]), ("walks", 2, ["d1", "d2"])]
    terms = S._write(spark.createDataFrame([("walks",), ("none",)], "term string"), scratch_path(spark, "terms"))
    assert sorted(r["doc_id"] for r in S._documents_with(index, terms).collect()) == ["d1", "d2"]
    later = S.upsert(index, spark.createDataFrame([("d2", "other", "S", 2)], SCHEMA))
    assert sorted(r["doc_id"] for r in S._documents_with(later, terms).collect()) == ["d1"]
    assert sorted(r["doc_id"] for r in S._documents_with(S.compact(later), terms).collect()) == ["d1"]

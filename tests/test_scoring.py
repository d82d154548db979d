"""BM25 in tiles against joins and sums, and what a large batch moves."""

from pyspark.sql import functions as F

from parley.operators import retrieval as Q
from parley.operators import scoring


def _turns(spark):
    texts = ["throat cancer treatment", "growing gardens", "growing cancer throat tomatoes", "nowhere", "sore sore throats"]
    return spark.createDataFrame([(f"q{i}", t) for i, t in enumerate(texts * 3)], "q string, utterance string").select(
        F.concat("q", F.lit("_"), F.monotonically_increasing_id().cast("string")).alias("qid"), "utterance")


def _both(spark, corpus, monkeypatch, k):
    turns = spark.createDataFrame(_turns(spark).collect())
    got = sorted(map(tuple, Q.bm25_retrieve(turns, corpus, k).collect()))
    with monkeypatch.context() as m:
        m.setattr(Q, "in_buckets", lambda t: False)
        want = sorted(map(tuple, Q.bm25_retrieve(turns, corpus, k).collect()))
    return got, want


def test_tiles_equal_joins(spark, small_corpus, monkeypatch):
    for tile, free in ((1, 0), (7, 0), (4 << 20, 4 << 20)):
        monkeypatch.setattr(scoring, "TILE", tile)
        monkeypatch.setattr(scoring, "FREE_ROWS", free)
        for k in (1, 2, 5):
            got, want = _both(spark, small_corpus, monkeypatch, k)
            assert got == want and got


def test_copies_tie_by_id_and_few_rows_move(spark, monkeypatch):
    from parley.plans.corpus import build_corpus

    rows = [(f"D{i:04}", "throat cancer " + "filler " * (i // 100), "X", 1) for i in range(800)]
    rows += [(f"E{i:04}", "garden " * 5, "X", 1) for i in range(2400)]  # so that four digits tell the lengths apart
    c = build_corpus(spark.createDataFrame(rows, "doc_id string, text string, source string, batch_id bigint"), buckets=8)
    turns = spark.createDataFrame([("a", "throat"), ("b", "cancer throat")], "qid string, utterance string")
    moved = []
    top_k = Q.top_k
    monkeypatch.setattr(Q, "top_k", lambda s, keys, k: moved.append(s.count()) or top_k(s, keys, k))
    monkeypatch.setattr(scoring, "FREE_ROWS", 0)
    got = {(r["qid"], r["rank"]): r["doc_id"] for r in Q.bm25_retrieve(turns, c, 80).collect()}
    assert [got["a", i] for i in range(1, 81)] == [f"D{i:04}" for i in range(80)] == [got["b", i] for i in range(1, 81)]
    assert moved[0] <= 2 * 100  # not 80 from each bucket, nor all 800


def test_only_postings_of_the_batch_reach_python(spark, small_corpus, monkeypatch):
    terms = [r["term"] for r in small_corpus.postings.select("term").distinct().orderBy("term").collect()]
    turns = spark.createDataFrame([("a", f"{terms[0]} {terms[-1]}")], "qid string, utterance string")
    monkeypatch.setattr(Q, "KEY_RANGES", 1)  # one range, from the first term to the last
    read = []
    best_rows = scoring.best_rows
    monkeypatch.setattr(scoring, "best_rows", lambda postings, *rest: read.append(postings) or best_rows(postings, *rest))
    assert Q.bm25_retrieve(turns, small_corpus, 5).count()
    assert {r["term"] for r in read[0].select("term").collect()} <= {terms[0], terms[-1]}


def _bucket(docs=400, turns=60, seed=3):
    import numpy as np
    import pyarrow as pa

    rnd = np.random.default_rng(seed)
    rows = [(f"d{i:04}", f"t{t}", int(rnd.integers(1, 9)), int(rnd.integers(20, 90))) for t in range(50) for i in rnd.choice(docs, 1 + docs // (t + 2), replace=False)]
    pairs = [(f"q{q}", f"t{t}", int(rnd.integers(1, 3)), 8.0 / (60 - t)) for q in range(turns) for t in rnd.choice(55, 12, replace=False)]
    pairs += [("long", f"t{t}", 3000, 8.0 / (60 - t)) for t in range(55)]  # its sums need more than 16 bits
    columns = lambda rows, names: pa.table({c: [r[i] for r in rows] for i, c in enumerate(names)})
    return columns(rows, ["doc_id", "term", "tf", "dl"]), columns(pairs, ["qid", "term", "qtf", "idf"]), rows, pairs


def test_bounds_hold_and_leave_few_documents_to_score(monkeypatch):
    import numpy as np

    postings, weights, rows, pairs = _bucket()
    want = {}
    for q, term, qtf, idf in pairs:
        for d, t, tf, dl in rows:
            if t == term:
                want[q, d] = want.get((q, d), 0.0) + qtf * 2.2 * idf * tf / (tf + 1.2 * (0.25 + 0.75 * dl / 50.0))
    batch = scoring.Batch(weights, ["qid"], 1.2, 0.75, 50.0)
    names = batch.keys[0].to_pylist()
    for share, cells in ((1 / 40, 1 << 18), (2.0, 1), (0.0, 1000)):  # columns for some, no and all terms
        monkeypatch.setattr(scoring, "SHARE", share)
        monkeypatch.setattr(scoring, "CELLS", cells)
        bucket, seen = scoring.Bucket(batch, iter(postings.to_batches(max_chunksize=100))), set()
        for turns, sums in bucket.bounds():
            assert not sums[:, bucket.n :].any()
            seen.add(sums.dtype.name)
            for q, row in zip(turns, sums):
                exact = np.array([want.get((names[q], d), 0.0) for d in bucket.ids])
                assert ((row[: bucket.n] > 0) == (exact > 0)).all()
                over = row[: bucket.n] - exact * batch.scale
                assert over.min() >= -1e-3 and over.max() <= batch.slack[q] + 1e-3
                assert np.allclose(bucket.scores(np.full(bucket.n, q), np.arange(bucket.n)), exact, rtol=1e-12)
        assert seen == {"uint16", "uint32"}
    # the best five of 400 documents: few more are scored
    class Frame:
        select = lambda self, *a: self
        mapInArrow = lambda self, f, schema: f

    scored, scores = [], scoring.Bucket.scores
    monkeypatch.setattr(scoring.Bucket, "scores", lambda self, turn, doc: scored.append(len(turn)) or scores(self, turn, doc))
    monkeypatch.setattr(scoring, "ddl", lambda *a: [])
    sent = type("Sent", (), {"value": vars(batch)})
    got = [r for b in scoring.best_rows(Frame(), sent, Frame(), ["qid"], 5)(iter(postings.to_batches())) for r in b.to_pylist()]
    best = {q: sorted((-scoring.units(np.array(s)).item(), d) for (p, d), s in want.items() if p == q)[:5] for q in names}
    assert {q: [(-round(r["score"] * 10_000), r["doc_id"]) for r in got if r["qid"] == q] for q in names} == best
    assert sum(scored) < 3 * 5 * len(names)

"""The pipeline against a brute-force version of each stage on its own input."""

import hashlib
import random
import re

import public_tokenizers as tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from parley.llm import bpe, quality
from test_dedup import brute_lines, shingles
from test_rules_and_layout import brute_statistics
from test_text_ops import contaminated

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def make_tables(spark, path):
    rnd = random.Random(12)
    vocab = [f"wort{i}" for i in range(600)]
    make = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    items = [(i, make(25)) for i in range(12)]
    docs, labels = [], []
    for i in range(240):
        lines = [make(rnd.randint(8, 20)) for _ in range(rnd.randint(4, 8))]
        if i % 12 == 1:
            lines[1:1] = ["boiler one here", "boiler two here", "boiler three here"]
        if i % 20 == 2:
            lines[2] = make(4) + " " + items[i % 12][1].upper() + ", " + make(3)
        text = "\n".join(lines)
        if i % 6 == 5:
            text = re.sub(r"(\w+)", r"\1***", text)
        docs.append((i, text))
        labels.append((i, int(i % 6 != 5), 0))
    for i in range(240, 280):  # edited copies
        w = docs[i - 240][1].replace("\n", " ").split(" ")
        w[rnd.randrange(len(w))] = "edited"
        docs.append((i, " ".join(w)))
    docs += [(300, None), (301, ""), (302, "short"), (303, docs[3][1]), (None, docs[4][1] + " tail"), (3, docs[3][1]), (304, make(30_000))]
    spark.createDataFrame([(i, t, None if i == 7 else "en", "src1", None if t is None else len(t)) for i, t in docs], SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return items


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("pipeline"))
    items = make_tables(spark, path)
    docs = spark.read.parquet(f"{path}/documents.parquet")
    out = [docs.withColumn("row", F.lit("clash")).withColumn("__t", F.lit(1))]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, out[-1], path).write.parquet(f"{path}/step-{k}")
        out.append(spark.read.parquet(f"{path}/step-{k}"))
    return path, items, [x.collect() for x in out], [x.columns for x in out]


def texts(rows):
    return sorted([(r.doc_id, r.text) for r in rows], key=repr)


def test_stages_keep_the_columns(steps):
    *_, columns = steps
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "benchmark_decontamination", "byte_bpe"]
    assert all(c == columns[0] for c in columns[:5]) and columns[5] != columns[0]


def test_quality_stage(steps):
    _, _, rows, _ = steps
    kept = []
    for r in rows[0]:
        n, chars, symbols, _, repeats = brute_statistics(r.text)
        if n >= 10 and 100 * repeats <= 20 * n and symbols < 0.05 * chars:
            kept.append(r)
    assert texts(rows[1]) == texts(kept)


def test_line_stage(steps):
    _, _, rows, _ = steps
    want = brute_lines([(r.doc_id, r.text) for r in rows[1]])
    assert texts(rows[2]) == sorted([(r.doc_id, want[r.doc_id, r.text]) for r in rows[1]], key=repr)
    assert all(r.n_chars == len(r.text) for r in rows[2])


def test_near_stage(steps):
    _, _, rows, _ = steps
    own = rows[2]
    sets, label = [shingles(r.text) for r in own], list(range(len(own)))
    for a in range(len(own)):
        for b in range(a):
            if label[a] != label[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                low, high = sorted((label[a], label[b]))
                label = [low if x == high else x for x in label]
    keep = {}
    for r, x in zip(own, label):
        if x not in keep or (r.doc_id is None, r.doc_id or 0) < (keep[x].doc_id is None, keep[x].doc_id or 0):
            keep[x] = r
    assert sorted([r.doc_id for r in rows[3]], key=repr) == sorted([r.doc_id for r in keep.values()], key=repr)
    assert {(r.doc_id, r.text) for r in rows[3]} <= {(r.doc_id, r.text) for r in own}


def test_decontamination_stage(steps):
    _, items, rows, _ = steps
    clean = [r for r in rows[3] if not contaminated(r.text, items)[0]]
    assert len(clean) < len(rows[3]) and texts(rows[4]) == texts(clean)


def test_bpe_stage(steps):
    _, _, rows, _ = steps
    encoding = tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(tokenizers.path("byte_bpe_50k.tiktoken")), special_tokens={})
    want = []
    for r in rows[4]:
        ids = encoding.encode_ordinary(r.text or "")
        want.append((r.doc_id, len(ids), hashlib.sha256((r.text or "").encode()).hexdigest(), tuple(ids)))
    assert sorted([(r.doc_id, r.n_tokens, r.decoded_sha256, tuple(r.ids)) for r in rows[5]], key=repr) == sorted(want, key=repr)


def test_run_equals_the_stages(spark, steps):
    path, _, rows, _ = steps
    assert sorted([tuple(r) for r in corpus_pipeline.run(spark, path).collect()], key=repr) == sorted([tuple(r) for r in rows[5]], key=repr)


def test_stages_on_an_empty_table(spark, steps):
    path, *_ = steps
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, path).count() == 0
    assert quality.FEATURES


def test_near_stage_keeps_one_of_many_edited_copies(spark):
    """Copies with one to three of 150 words changed, many of them no duplicates of the hub of
    their bucket: all are linked through others, so one document stays."""
    rnd = random.Random(0)
    new = lambda: f"u{rnd.randrange(10**9)}"
    base, rows = [new() for _ in range(150)], []
    for i in range(300):
        words = list(base)
        for k in rnd.sample(range(150), rnd.randint(1, 3)):
            words[k] = new()
        rows.append((i, " ".join(words), "en", "src1", 1))
    got = corpus_pipeline.near_dedup(spark, spark.createDataFrame(rows, SCHEMA), "").collect()
    assert [r.doc_id for r in got] == [0]

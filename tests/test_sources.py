import json

import pytest

from parley.sources.collection import upsert_collection
from parley.sources.passages import load_paragraphs, parse_passage_lines, rejected_passage_lines
from parley.sources.topics import load_topics
from parley.sources.trec import format_run, load_run, write_run


def _lines(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")


def test_passage_lines(spark):
    lines = _lines(spark, ['1\t"Hello" world', '5\t"open', "6\tnext", "2\t", "3\ta\tb", "dummy"])
    got = {r["doc_id"]: r["text"] for r in parse_passage_lines(lines).collect()}
    assert got == {"MARCO_1": '"Hello" world', "MARCO_5": '"open', "MARCO_6": "next", "MARCO_2": "", "MARCO_3": "a"}
    assert rejected_passage_lines(lines).count() == 1


def test_paragraph_bodies_concatenate(spark):
    df = spark.createDataFrame([("p1", [("ab",), ("cd",)])], "para_id string, bodies array<struct<text:string>>")
    r = load_paragraphs(df).first()
    assert (r["doc_id"], r["text"]) == ("CAR_p1", "abcd")


def test_upsert_latest_batch_wins(spark):
    cur = spark.createDataFrame([("d1", "x", "MARCO", 1), ("d2", "keep", "MARCO", 1)], "doc_id string, text string, source string, batch_id bigint")
    new = spark.createDataFrame([("d1", "y", "MARCO", 2)], "doc_id string, text string, source string, batch_id bigint")
    got = {r["doc_id"]: r["text"] for r in upsert_collection(cur, new).collect()}
    assert got == {"d1": "y", "d2": "keep"}
    # idempotent: applying the same batch again changes nothing
    again = {r["doc_id"]: r["text"] for r in upsert_collection(upsert_collection(cur, new), new).collect()}
    assert again == got


def test_topics_json_array(spark, tmp_path):
    topics = [{"number": 81, "turn": [
        {"number": 1, "manual_rewritten_utterance": "a b", "automatic_rewritten_utterance": "a"},
        {"number": 2, "manual_rewritten_utterance": "c", "automatic_rewritten_utterance": "c d"}]}]
    p = tmp_path / "topics.json"
    p.write_text(json.dumps(topics))
    rows = sorted((r["topic"], r["turn"], r["manual"], r["automatic"]) for r in load_topics(spark, str(p)).collect())
    assert rows == [(81, 1, "a b", "a"), (81, 2, "c", "c d")]


def test_run_round_trip(spark, tmp_path):
    ranking = spark.createDataFrame(
        [("10_2", "MARCO_1", 3.25, 1), ("10_2", "CAR_9", 1.5, 2), ("2_1", "MARCO_7", 0.5, 1)],
        "qid string, doc_id string, score double, rank long")
    path = str(tmp_path / "run")
    write_run(ranking, path, "Manual")
    lines = [r["value"] for r in spark.read.text(path).collect()]
    assert lines == ["2_1 Q0 MARCO_7 1 0.5000 Manual", "10_2 Q0 MARCO_1 1 3.2500 Manual", "10_2 Q0 CAR_9 2 1.5000 Manual"]
    back = sorted((r["qid"], r["doc_id"], r["rank"], r["score"], r["tag"]) for r in load_run(spark, path).collect())
    assert back == sorted([("10_2", "MARCO_1", 1, 3.25, "Manual"), ("10_2", "CAR_9", 2, 1.5, "Manual"), ("2_1", "MARCO_7", 1, 0.5, "Manual")])
    assert format_run(ranking, "X").count() == 3


def test_replace_collection_replaces(spark, tmp_path):
    import pytest

    from parley.sources.collection import collection_counts, replace_collection

    make = lambda rows: spark.createDataFrame(rows, "doc_id string, text string, source string, batch_id bigint")
    path = str(tmp_path / "collection")
    old = replace_collection(make([("a", "x", "S", 1), ("b", "y", "T", 1)]), path, buckets=2)
    assert sorted(tuple(r) for r in collection_counts(old).collect()) == [("S", 1), ("T", 1)]
    with pytest.raises(ValueError):
        replace_collection(old, path, buckets=2)
    new = replace_collection(make([("c", "z", "S", 2)]), path, buckets=2)
    assert [r["doc_id"] for r in new.collect()] == ["c"]
    assert spark.read.parquet(path).count() == 1


def test_short_judgement_and_run_lines_are_reported(spark):
    from parley.sources.trec import parse_qrels, parse_run, rejected_lines

    lines = spark.createDataFrame([("1_1 0 d1 2",), ("1_1 0 d1",), ("",), ("1_1 Q0 d1 1 0.5 tag",)], "value string")
    assert parse_qrels(lines).count() == 2 and [r["value"] for r in rejected_lines(lines, 4).collect()] == ["1_1 0 d1"]
    assert parse_run(lines).count() == 1 and rejected_lines(lines, 6).count() == 2


def test_checkpoint_folder_must_be_named_on_a_cluster():
    from types import SimpleNamespace

    import pytest

    from parley.session import checkpoint_root

    session = SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=SimpleNamespace(master="spark://x:7077", getCheckpointDir=lambda: None))
    with pytest.raises(ValueError):
        checkpoint_root(session)

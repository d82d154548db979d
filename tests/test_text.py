from pyspark.sql import functions as F

from parley.functions.text import STOPWORDS, normalize, remove_stopwords, tokenize


def _one(spark, text, col):
    return spark.createDataFrame([(text,)], "t string").select(col.alias("x")).first()["x"]


def test_separators_and_case(spark):
    assert _one(spark, "Don't STOP-it! Étude 3.5", F.array_join(tokenize(normalize("t")), " ")) == "don t stop it tude 3 5"


def test_stop_words_only(spark):
    assert _one(spark, "What is it about?", remove_stopwords(tokenize(normalize("t")))) == []


def test_stop_list_is_fixed():
    assert len(STOPWORDS) == 153 and len(set(STOPWORDS)) == 153
    assert "don" in STOPWORDS and "would" not in STOPWORDS


def test_conflation_is_dictionary_checked(spark):
    from parley.operators.conflation import build_conflation

    vocab = spark.createDataFrame(
        [("horses", 2), ("horse", 3), ("running", 2), ("runn", 2), ("nation", 2), ("nationality", 2), ("abcs", 1)],
        "term string, df long",
    )
    m = {r["surface"]: r["stem"] for r in build_conflation(vocab).collect()}
    assert m["horses"] == "horse"  # es->e attested
    assert m["running"] == "runn"  # ing->'' attested (first rule that is attested wins)
    assert m["nationality"] == "national" or m["nationality"] == "nationality"  # national not attested -> unchanged
    assert m["nationality"] == "nationality"
    assert "abcs" not in m  # df < 2: not in V, maps to itself

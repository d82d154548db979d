import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from parley.session import apply_plan_settings

    s = (
        SparkSession.builder.master("local[4]")
        .appName("parley-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="parley-test-ckpt-"))
    apply_plan_settings(s)
    yield s


@pytest.fixture(scope="session")
def small_corpus(spark):
    """A hand-made collection: every retrieval/re-rank test can reason about it by hand."""
    from parley.plans.corpus import build_corpus

    rows = [
        ("MARCO_1", "Throat cancer symptoms and treatments of throat cancer", "MARCO", 1),
        ("MARCO_2", "Cancer research funding grows", "MARCO", 1),
        ("MARCO_3", "Growing tomatoes in the garden", "MARCO", 1),
        ("CAR_4", "Treatment options for sore throats", "CAR", 1),
        ("CAR_5", "Gardens and gardening: growing vegetables", "CAR", 1),
        ("CAR_6", "", "CAR", 1),
    ]
    raw = spark.createDataFrame(rows, "doc_id string, text string, source string, batch_id bigint")
    return build_corpus(raw)

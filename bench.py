"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is executed in full with the no-op sink (``write.format("noop")``), so no
column or row is skipped the way ``count()`` could.  ``index_build`` is the one-time
corpus materialisation (collection, conflation, postings, statistics), always built
fresh; the other keys reuse it, as retrieval reuses a built index.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = (
    "bm25_retrieve",
    "bm25_topics",
    "rerank_same_depth",
    "deep_rank",
    "ql_rerank",
    "evaluate",
    "compare_systems",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from parley.session import local_session

    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "8")))
    from parley.plans import corpus as C
    from parley.plans.catalog import REGISTRY
    from parley.session import scratch_path, shuffle_partitions
    from parley.sources import fixtures

    times: dict[str, float] = {}
    t = time.time()
    # always a fresh build (never a reload from the corpus cache), then shared by the queries
    c = C.build_corpus(fixtures.collection(spark, sf_dir), scratch_path(spark, "bench-corpus"), shuffle_partitions(spark))
    C._CACHE[(spark.sparkContext.applicationId, sf_dir.rstrip("/"))] = c
    times["index_build"] = round(time.time() - t, 3)
    keys = [k for k in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if k]
    for k in keys:
        t = time.time()
        REGISTRY[k](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[k] = round(time.time() - t, 3)
    sf = Path(sf_dir).name.replace("sf", "")
    out = {
        "metric": "total_wall_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()

"""Session helpers: local session for tests/bench, shared scratch folder, plan settings."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Deep re-ranking keeps 2,500 candidates per turn; Catalyst only inserts the partial
# per-partition top-k (WindowGroupLimit) below this threshold (default 1000).
WINDOW_GROUP_LIMIT = 10_000


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "parley") -> SparkSession:
    """A local session with the settings the tests and the bench use."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.optimizer.windowGroupLimitThreshold", str(WINDOW_GROUP_LIMIT))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    apply_plan_settings(spark)
    return spark


def apply_plan_settings(spark: SparkSession) -> None:
    """Runtime SQL settings the plans rely on: the partial top-k limit, only raised, and
    scans of bucketed tables by bucket also where no join or aggregate asks for it, so that
    a task holds one bucket and what it writes needs no exchange."""
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    cur = int(spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if cur < WINDOW_GROUP_LIMIT:
        spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", str(WINDOW_GROUP_LIMIT))


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the session names a shared (distributed) folder and we use it as is.
    Only a local master (tests) gets a folder of our own where it is unset; on a cluster a
    folder of one machine would not reach the executors, so an unset folder is an error.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        # local runs and tests only: a fixed folder, so a rebuilt session finds its corpus
        d = os.path.join(tempfile.gettempdir(), "parley-checkpoints")
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir() or d
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/parley/{name}-{uuid.uuid4().hex[:12]}"


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def env_int(name: str, default: int) -> int:
    try:
        return int(os.environ.get(name, default))
    except ValueError:
        return default

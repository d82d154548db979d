"""Collection maintenance.

Collections are stored bucketed by ``doc_id`` so that everything keyed by document
(upserts, analysis, postings, per-document scoring) runs without a shuffle of the stored
side.
"""

from __future__ import annotations

import re
import uuid
import warnings

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parley.session import scratch_path, shuffle_partitions


def union_collections(*collections: DataFrame) -> DataFrame:
    """S3: collections live together; key prefixes keep them disjoint."""
    out = collections[0]
    for c in collections[1:]:
        out = out.unionByName(c)
    return out


def latest(rows: DataFrame) -> DataFrame:
    """The row of the latest batch per ``doc_id`` (of the larger text within a batch)."""
    w = Window.partitionBy("doc_id").orderBy(F.col("batch_id").desc(), F.col("text").desc())
    return rows.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def upsert_collection(current: DataFrame, batch: DataFrame) -> DataFrame:
    """A document indexed again under the same id replaces the older one.

    Latest ``batch_id`` wins; within one batch the larger text wins, so the result does
    not depend on arrival order.  A stored collection holds an id once, so its untouched
    documents pass an anti-join as they are; only the touched ids are resolved.  When the
    batch's ids fit a broadcast (size-checked) the untouched texts are not shuffled.
    """
    from parley.plans.sizing import fits_broadcast

    batch = batch.select(*current.columns)
    ids = batch.select("doc_id").distinct()
    if fits_broadcast(ids):
        ids = F.broadcast(ids)
    untouched = current.join(ids, "doc_id", "left_anti")
    touched = latest(current.join(ids, "doc_id", "left_semi").unionByName(batch))
    return untouched.unionByName(touched)


#: Rows of a Parquet page in tables that are looked up by their sort column: what a point
#: look-up reads at least of each file.
PAGE_ROWS = 2000


def write_bucketed(df: DataFrame, path: str, key: str = "doc_id", buckets: int | None = None, name: str | None = None,
                   prepartitioned: bool = False, sort: str | None = None) -> DataFrame:
    """Write ``df`` bucketed by ``key`` under ``path``, its files sorted by ``sort`` (the key
    unless given, with short pages, so that a filter on it reads few of them); return the table.

    The returned DataFrame scans with ``HashPartitioning(key)``, so joins and aggregates
    on ``key`` need no exchange of this side.  Falls back to plain Parquet (no bucket
    metadata, and a warning) when the session catalog cannot hold tables; any other error
    is raised.  ``prepartitioned`` means ``df``
    is already ``repartition(buckets, key)``-ed (so work placed after that shuffle runs in
    ``buckets`` tasks).
    """
    spark = df.sparkSession
    n = buckets or shuffle_partitions(spark)
    part = df if prepartitioned else df.repartition(n, key)
    name = name or "parley_" + re.sub(r"[^0-9a-zA-Z_]", "_", uuid.uuid4().hex[:16])
    pages = {"parquet.page.row.count.limit": str(PAGE_ROWS)} if sort else {}
    try:
        (
            part.write.mode("overwrite")
            .bucketBy(n, key)
            .sortBy(sort or key)
            .options(**pages)
            .option("path", path)
            .saveAsTable(name)
        )
        return spark.table(name)
    except AnalysisException as e:  # catalog without table support: keep the data, lose the bucket map
        warnings.warn(f"stored without buckets, later steps will shuffle: {e}", stacklevel=2)
        part.sortWithinPartitions(sort or key).write.mode("overwrite").options(**pages).parquet(path)
        return spark.read.parquet(path)


def register_bucketed(spark: SparkSession, path: str, key: str, buckets: int, name: str | None = None, sort: str | None = None,
                      cols: str | None = None) -> DataFrame:
    """Re-attach a table written by :func:`write_bucketed` (e.g. from another session); ``cols``
    is its DDL, read from its files where not given."""
    name = name or "parley_" + uuid.uuid4().hex[:16]
    try:
        cols = cols or ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema.fields)
        spark.sql(
            f"CREATE TABLE {name} ({cols}) USING parquet CLUSTERED BY ({key}) SORTED BY ({sort or key}) "
            f"INTO {buckets} BUCKETS LOCATION '{path}'"
        )
        return spark.table(name)
    except AnalysisException as e:  # catalog without table support
        warnings.warn(f"read without buckets, later steps will shuffle: {e}", stacklevel=2)
        return spark.read.parquet(path)


def replace_collection(df: DataFrame, path: str | None = None, buckets: int | None = None) -> DataFrame:
    """Drop whatever is stored at ``path`` and store ``df`` anew (bucketed by doc_id).

    ``df`` must not read from ``path``: overwriting would destroy its own input.
    """
    path = path or scratch_path(df.sparkSession, "collection")
    own = re.sub("^file:/*", "/", path).rstrip("/") + "/"
    if any(re.sub("^file:/*", "/", f).startswith(own) for f in df.inputFiles()):
        raise ValueError(f"the new collection reads from {path}, which it would overwrite")
    return write_bucketed(df, path, "doc_id", buckets)


def collection_counts(df: DataFrame) -> DataFrame:
    """Documents per collection (source)."""
    return df.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"))

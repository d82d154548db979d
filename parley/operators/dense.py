"""Dense-vector ranking on stored embeddings (R4 over the ``embeddings`` table).

The bi-encoder re-rank of the reference scores a query vector against the vectors of its
candidate list and sorts.  Here a group of stored vectors (one label) is the candidate
list and the group's mean vector is the query: ``group_topk`` returns, per group, the k
members with the largest dot product with the centroid.

Plan: centroid = per-(group, dimension) average (partial aggregation, skew-safe) ->
small table of one vector per group (size-checked broadcast) -> one equi-join on the
group key -> dot product in the JVM -> per-group top-k with a partial limit before the
shuffle, so a group holding a third of the rows still moves only k rows per partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parley.operators.rerank import SCORE_DIGITS, dot
from parley.plans.sizing import bounded_broadcast


def as_double(vec: str = "embedding"):
    return F.transform(F.col(vec), lambda x: x.cast("double"))


def centroids(vectors: DataFrame, group: str = "label", vec: str = "embedding") -> DataFrame:
    """``(group, centroid array<double>)``: the mean vector of each group."""
    ex = vectors.select(group, F.posexplode(as_double(vec)).alias("i", "x"))
    per_dim = ex.groupBy(group, "i").agg(F.avg("x").alias("c"))
    return per_dim.groupBy(group).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("i", "c"))), lambda s: s["c"]).alias("centroid"))


def group_topk(vectors: DataFrame, k: int, key: str = "vec_id", group: str = "label", vec: str = "embedding") -> DataFrame:
    """Per group, the k vectors closest (dot product) to the group centroid: ``(group, key, score, rank)``."""
    c = bounded_broadcast(centroids(vectors, group, vec))
    j = vectors.select(group, key, as_double(vec).alias("v")).join(c, group)
    s = j.select(group, key, F.round(dot("v", "centroid"), SCORE_DIGITS).alias("score"))
    w = Window.partitionBy(group).orderBy(F.col("score").desc(), F.col(key).asc())
    return s.withColumn("rank", F.row_number().over(w).cast("bigint")).where(F.col("rank") <= k)

"""Connected components of a link table, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b): label is the least node reachable.

    Each round gives a node the least label among its own and its neighbours', then the
    label of that label, so that chains shrink by halves.  A round is stored; the links
    stay distributed, and only whether a label changed comes to the driver.
    """
    both = stored(links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).distinct(), "links")
    labels = None
    while True:
        if labels is None:  # every node is its own label at first
            sent = both.select(F.col("a").alias("node"), F.least("a", "b").alias("label"), F.col("a").alias("old"))
        else:
            near = both.join(labels.select(F.col("node").alias("b"), "label").hint("merge"), "b")
            sent = near.select(F.col("a").alias("node"), "label", F.lit(None).cast("string").alias("old")).union(labels.select("node", "label", F.col("label").alias("old")))
        labels = stored(sent.groupBy("node").agg(F.min("label").alias("label"), F.max("old").alias("old")), "labels")
        if labels.filter("label <> old").limit(1).count() == 0:
            return labels.select("node", "label")
        far = labels.select(F.col("node").alias("label"), F.col("label").alias("far")).hint("merge")
        labels = stored(labels.select("node", "label").join(far, "label", "left").select("node", F.least("label", "far").alias("label")), "labels")

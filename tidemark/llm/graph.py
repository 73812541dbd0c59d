"""Connected components of a distributed set of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """The smallest node reachable from each linked node: columns ``node``, ``component``.

    ``links``: columns ``a`` and ``b`` (long, not null), in either direction, repeats allowed.
    Each round gives every node the smallest label among its neighbours and then the label of
    that label, so chains shorten by more than half; minima are combined before the shuffle,
    so a hub is no hot spot. Each round is written to the shared folder.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = stored(both.where("a <> b").distinct())
    labels = stored(edges.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label")).withColumnRenamed("a", "node"))
    while True:
        near = edges.join(labels.select(F.col("node").alias("b"), "label"), "b")
        least = near.groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        hopped = labels.join(least, "node").select("node", "label", F.least("label", "near").alias("next"))
        target = labels.select(F.col("node").alias("next"), F.col("label").alias("further"))
        jumped = hopped.join(target, "next", "left")
        after = stored(jumped.select("node", F.col("label").alias("before"), F.least("next", "further").alias("label")))
        if after.where("before <> label").isEmpty():
            return after.select("node", F.col("label").alias("component"))
        labels = after.select("node", "label")

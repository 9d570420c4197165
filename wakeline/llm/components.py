"""Connected components of a table of links, as repeated joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.session import materialise


def components(links: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``links(a, b)``; the label is the smallest node of its component.

    Each round takes the smallest label among the neighbours and then follows the label of that label, so the number
    of rounds grows with the logarithm of the longest path. Every round is written to the shared folder: its lineage
    is one read, whatever happens to executors. A hot node's links are reduced on the map side before they travel.
    """
    both = materialise(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = materialise(both.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("label")), "labels")
    while True:
        near = labels.select(F.col("node").alias("b"), F.col("label").alias("near"))
        best = both.join(near, "b").groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near"))
        hooked = labels.join(best, "node").select("node", "label", F.least("label", "near").alias("via"))
        jump = hooked.select(F.col("node").alias("via"), F.col("via").alias("jump"))
        after = materialise(hooked.join(jump, "via").select("node", "label", "jump"), "labels")
        labels = after.select("node", F.col("jump").alias("label"))
        if after.filter("label <> jump").isEmpty():
            return labels

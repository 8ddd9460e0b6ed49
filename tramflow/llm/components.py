"""Connected components of a link table, by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, label`` for every node of a link; the label is the component's smallest node.

    Each round takes the smallest label among neighbours (a partial aggregate, so a hub's
    links are combined before the shuffle) and then the label's own label. Every round is
    written to the checkpoint folder; the driver only learns how many labels changed.
    """
    both = links.select(F.col(a).alias("node"), F.col(b).alias("other")).union(links.select(F.col(b), F.col(a))).distinct().checkpoint()
    labels = both.groupBy("node").agg(F.min("other").alias("other")).select("node", F.least("node", "other").alias("label")).checkpoint()
    while True:
        near = both.join(labels.select(F.col("node").alias("other"), "label"), "other").groupBy("node").agg(F.min("label").alias("near"))
        low = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("up"))
        moved = low.join(up, "label").select("node", "old", F.least("label", "up").alias("label")).checkpoint()
        labels = moved.select("node", "label")
        if not moved.where("label <> old").take(1):
            return labels

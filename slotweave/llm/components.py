"""Connected components of a table of links, by joins alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotweave.llm.shared import written


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b); the label is the smallest node of the component.

    Labels go to the neighbours and then on to the label of the label, which halves the ways that are left. Each
    round is written, so a lost executor does not undo earlier ones. No links give no rows.
    """
    both = written(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = written(both.groupBy("a").agg(F.least("a", F.min("b")).alias("label"))
                     .select(F.col("a").alias("node"), "label"), "labels")
    while True:
        near = (both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("label").alias("near"))
                .withColumnRenamed("a", "owner"))
        lower = labels.join(near, labels.node == near.owner).select("node", F.least("label", "near").alias("next"), "label")
        lower = written(lower, "labels")
        beyond = lower.select(F.col("node").alias("owner"), F.col("next").alias("beyond"))
        fresh = written(
            lower.join(beyond, lower.next == beyond.owner)
            .select("node", F.least("next", "beyond").alias("label"), (F.col("label") != F.least("next", "beyond")).alias("moved")),
            "labels")
        labels = fresh.select("node", "label")
        if fresh.where("moved").isEmpty():
            return labels

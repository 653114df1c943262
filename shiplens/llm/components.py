"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiplens.sources.scratch import materialise


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of links (a, b), the component named by its smallest node.

    Each round a node takes the smallest label of itself, its neighbours and its label's own label,
    so labels travel along links and jump along earlier labels. Sums per node are combined before
    the shuffle; every round is written to the shared folder, so none is worked out twice.
    """
    both = materialise(
        links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).distinct(), "links"
    )
    labels = materialise(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b"))
        .select("node", F.least("node", "b").alias("label")), "labels"
    )
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(
            F.col("a").alias("node")
        ).agg(F.min("label").alias("near"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("jump"))
        moved = labels.join(near, "node").join(jump, "label").select(
            "node", F.least("label", "near", "jump").alias("new"), F.col("label").alias("old")
        )
        moved = materialise(moved, "labels")
        changed = moved.where("new <> old").limit(1).count()
        labels = moved.select("node", F.col("new").alias("label"))
        if not changed:
            return labels.withColumnRenamed("label", "component")

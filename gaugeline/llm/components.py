"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import stored

# Links a file of the rounds' tables holds, so that a few links aren't spread over as many files as the session has partitions.
LINKS_A_FILE = 100_000


def components(links: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) for every node of links (a, b), longs.

    Each round gives every node the smallest label among its neighbours and then the label of its
    label, until none changes; the tables of each round are written, so lineage stays short and a
    lost executor costs one round at most. A hub's labels are minima, combined before the shuffle.
    """
    files = 1 + links.count() // LINKS_A_FILE
    both = stored(links.select("a", "b").union(links.select("b", "a")).distinct().coalesce(files), "cc-links")
    labels = stored(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label")).coalesce(files), "cc-labels")
    while True:
        near = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("label").alias("m"))
        lower = labels.join(near, labels.node == near.a).select("node", F.col("label").alias("old"), F.least("label", "m").alias("label"))
        jump = labels.select(F.col("node").alias("via"), F.col("label").alias("far"))
        moved = stored(
            lower.join(jump, lower.label == jump.via, "left").select("node", "old", F.least("label", F.coalesce("far", "label")).alias("label")).coalesce(files),
            "cc-labels",
        )
        labels = moved.select("node", "label")
        if moved.where("old <> label").isEmpty():
            return labels.withColumnRenamed("label", "component")

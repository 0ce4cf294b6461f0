"""Connected components of a graph of links, as DataFrame joins; nothing is gathered anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import written


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """node, label: the smallest node reachable. nodes: column node; links: columns a, b (nodes, any order).

    Each round hands every node the smallest label of its neighbours and then the label's own label, so a
    chain's length halves; each round's labels are written to the shared folder.
    """
    spark = nodes.sparkSession
    both = written(
        links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links"
    )
    linked = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near"))
    labels = written(linked.select("node", F.least("node", "near").alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node"))
        near = near.agg(F.min("label").alias("near"))
        stepped = labels.join(near, "node").select("node", F.least("label", "near").alias("next"), "label")
        jump = labels.select(F.col("node").alias("next"), F.col("label").alias("further"))
        stepped = stepped.join(jump, "next").select("node", F.least("next", "further").alias("label"), F.col("label").alias("was"))
        stepped = written(stepped, "labels")
        labels = stepped.select("node", "label")
        if stepped.filter("label <> was").isEmpty():
            break
    out = nodes.join(labels, "node", "left")
    return out.select("node", F.coalesce("label", "node").alias("label"))

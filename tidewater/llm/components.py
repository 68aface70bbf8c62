"""Connected components of an edge table by least labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import materialize


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the least node reachable over links, for every node that has one.

    Each round takes the least label among the neighbours (map-side combined, so a hub is no bottleneck) and then jumps to
    the label of that label. Rounds grow with the logarithm of the longest path; tables between rounds are files.
    """
    pairs = links.select(F.col(a).alias("x"), F.col(b).alias("y")).filter("x != y")
    edges = materialize(pairs.union(pairs.select("y", "x")).distinct(), "component-edges")
    labels = materialize(edges.groupBy(F.col("x").alias("node")).agg(F.min(F.least("x", "y")).alias("component")), "component-labels")
    while True:
        near = edges.join(labels.withColumnRenamed("node", "y"), "y").groupBy(F.col("x").alias("node")).agg(F.min("component").alias("_near"))
        lower = labels.join(near, "node").select("node", F.least("component", "_near").alias("_low"), F.col("component").alias("_old"))
        over = labels.select(F.col("node").alias("_low"), F.col("component").alias("_jump"))
        new = materialize(
            lower.join(over, "_low", "left").select("node", F.coalesce("_jump", "_low").alias("component"), (F.coalesce("_jump", "_low") != F.col("_old")).alias("moved")),
            "component-labels",
        )
        labels = new.select("node", "component")
        if new.filter("moved").isEmpty():
            return labels

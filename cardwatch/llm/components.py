"""Connected components of an edge list, in jobs of bounded tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch.llm.work import discard, staged


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b); a component is named by its smallest node.

    Each round takes the smallest label among neighbours and then the label of that label, so long chains halve. Labels
    and edges stay in written tables; only the number of changed labels reaches the driver.
    """
    both = staged(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
                  "edges")
    labels = staged(both.groupBy("a").agg(F.min("b").alias("_least")).select(
        F.col("a").alias("node"), F.least("a", "_least").alias("component")), "labels")
    while True:
        offered = (both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("component").alias("_offer")))
        offered = staged(labels.join(offered, F.col("node") == F.col("a")).select(
            "node", F.col("component").alias("_was"), F.least("component", "_offer").alias("_next")), "offers")
        ahead = offered.select(F.col("node").alias("_key"), F.col("_next").alias("_jump"))
        after = staged(offered.join(ahead, F.col("_next") == F.col("_key"), "left").select(
            "node", "_was", F.least("_next", F.coalesce("_jump", "_next")).alias("component")), "labels")
        discard(labels, offered)
        labels = after.select("node", "component")
        if not after.where("component <> _was").limit(1).count():
            discard(both)
            return labels

"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for edges ``a, b`` (bigint): the smallest node each node is connected with.

    Every round takes the smallest label of a node, its neighbours and its label's own label, until
    none changes, so paths are halved. Each round is a table in the shared folder. Joins are on
    nodes, and Spark splits the partition of a node with many edges.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    links = stored(both.distinct(), "links")
    labels = links.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("component"))
    labels = stored(labels, "labels")
    while True:
        near = links.join(labels.select(F.col("node").alias("b"), "component"), "b")
        near = near.groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        own = labels.select(F.col("node").alias("component"), F.col("component").alias("up"))
        now = labels.join(near, "node").join(own, "component").select(
            "node", F.least("near", "up").alias("component"), (F.least("near", "up") < F.col("component")).alias("moved")
        )
        now = stored(now, "labels")
        labels = now.drop("moved")
        if now.where("moved").isEmpty():
            return labels

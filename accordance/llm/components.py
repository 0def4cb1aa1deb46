"""Connected components of a graph that no machine holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accordance.llm.tables import keep


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """node and root (the least node of its component) for the ends of all edges (a, b).

    Each round a node takes the least label of its neighbours, then the label of that label.  Rounds
    start from written tables, and both sides of each join are such tables, so that Spark can
    split a node with very many neighbours.
    """
    both = keep(
        edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        "edges",
    )
    labels = keep(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")).select(
            "node", F.least("node", "least").alias("root")
        ),
        "labels",
    )
    for _ in range(rounds):
        near = (
            both.join(labels.select(F.col("node").alias("b"), "root"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("root").alias("near"))
        )
        next_ = keep(
            labels.join(near, "node").select(
                "node", F.least("root", "near").alias("root"), F.col("root").alias("before")
            ),
            "nearer",
        )
        jump = next_.select(F.col("node").alias("root"), F.col("root").alias("far"))
        labels = keep(
            next_.join(jump, "root", "left").select(
                "node", F.coalesce("far", "root").alias("root"), "before"
            ),
            "labels",
        )
        if labels.where("root <> before").isEmpty():
            return labels.select("node", "root")
    raise RuntimeError(f"the components aren't found after {rounds} rounds")

"""Connected components by minimum-label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut, discard


def minimum_labels(nodes: DataFrame, edges: DataFrame, most_rounds: int = 200) -> DataFrame:
    """``(node, label)``: the smallest node of each node's component.

    ``nodes`` has distinct ``node``, ``edges`` has ``u, v`` (either direction, repeats allowed). A round takes the
    smallest label among a node's neighbours and then the label of that label, so that paths halve;
    rounds end when no label changes. Labels that still change after ``most_rounds`` are an error, never a result.
    Labels are cut to the shared folder each round and those of earlier rounds deleted.
    """
    both = cut(edges.select("u", "v").where("u <> v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")).where("u <> v")).distinct())
    labels = nodes.select("node", F.col("node").alias("label"))
    if both.isEmpty():
        return labels
    labels = cut(labels)
    for _ in range(most_rounds):
        near = both.join(labels.withColumnRenamed("node", "v"), "v").groupBy("u").agg(F.min("label").alias("low"))
        hop = labels.join(near.withColumnRenamed("u", "node"), "node", "left").select("node", F.col("label").alias("old"), F.least("label", "low").alias("label"))
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("up"))
        step = cut(hop.join(up, "label", "left").select("node", "old", F.least("label", "up").alias("label")))
        discard(labels)
        labels = step
        if step.where("label <> old").isEmpty():
            discard(both)
            return step.select("node", "label")
    raise RuntimeError(f"labels still change after {most_rounds} rounds")

"""Connected components of a link table by minimum labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aislewise.llm.scratch import Scratch


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, label): the smallest node reachable, for nodes of ``links`` (a, b), a != b.

    Every round takes the smallest label among neighbours and jumps to that label's label,
    so chains shrink by halves. Rounds are written tables; the driver sees counts only.
    """
    edges = scratch.save(
        links.select(F.col("a").alias("src"), F.col("b").alias("dst"))
        .unionByName(links.select(F.col("b").alias("src"), F.col("a").alias("dst"))).distinct()
    )
    labels = scratch.save(
        edges.groupBy("src").agg(F.min("dst").alias("dst"))
        .select(F.col("src").alias("node"), F.least("src", "dst").alias("label"))
    )
    while True:
        near = (
            edges.join(labels.select(F.col("node").alias("dst"), "label"), "dst")
            .groupBy("src").agg(F.min("label").alias("near"))
        )
        step = labels.join(near.withColumnRenamed("src", "node"), "node").select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("far"))
        after = scratch.save(step.join(jump, "label", "left").select(
            "node", "old", F.least("label", F.coalesce("far", "label")).alias("label")))
        scratch.drop(labels)
        labels = after
        if labels.where("label < old").limit(1).count() == 0:
            scratch.drop(edges)
            return labels.select("node", "label")

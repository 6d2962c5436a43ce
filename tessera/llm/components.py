"""Connected components by smallest-label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import attach_group, materialise


def connected_components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b: long): label is the smallest node
    of its component.

    Each round takes the smallest label among the neighbours, then the label of that
    label, so labels travel a distance that doubles. Labels are one row per node and
    written to the shared folder each round. A label that very many nodes already
    share is a hot key of the jump: ``attach_group`` handles it."""
    both = materialise(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
                       .distinct(), "links")
    labels = materialise(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
                         .select("node", F.least("node", "low").alias("label")), "labels")
    total = labels.count()
    while total:
        near = (both.join(labels.select(F.col("node").alias("b"), "label"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("low")))
        step = materialise(labels.join(near, "node")
                           .select("node", F.col("label").alias("was"), F.least("label", "low").alias("key")), "step")
        sizes = step.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
        parents = materialise(step.select(F.col("node").alias("key"), F.col("key").alias("label"))
                              .join(sizes, "key"), "parents")
        labels = materialise(attach_group(step, parents, "key", "n", total).select("node", "was", "label"), "labels")
        moved = labels.filter("was <> label").limit(1).count()
        labels = labels.select("node", "label")
        if not moved:
            break
    return labels

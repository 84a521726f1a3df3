"""Connected components of an edge table by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapse.llm.common import staged


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b); label is the smallest node reachable.

    Each round takes the least label among a node's neighbours (a partial aggregate, so a node of any
    degree is spread out) and then the label of that label. Rounds run until no label changes; the
    driver sees only whether one did.
    """
    both = staged(edges.select("a", "b").union(edges.select("b", "a")).where("a != b").distinct(), "cc-edges")
    labels = staged(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select(
        "node", F.least("node", "m").alias("label")), "cc-labels")
    while True:
        seen = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("label").alias("m"))
        hooked = labels.join(seen, labels.node == seen.a).select("node", F.col("label").alias("old"), F.least("label", "m").alias("near"))
        jump = labels.select(F.col("node").alias("j"), F.col("label").alias("far"))
        labels = staged(hooked.join(jump, hooked.near == jump.j).select(
            "node", F.least("near", "far").alias("label"), "old"), "cc-labels")
        changed = labels.where("label != old").isEmpty()
        labels = labels.drop("old")
        if changed:
            return labels

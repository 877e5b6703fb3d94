"""Connected components by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeledger.llm.checkpoints import cut


def connected_components(edges: DataFrame) -> DataFrame:
    """The smallest vertex that each vertex of ``edges`` (a, b) can reach.

    Returns (vertex, component); vertices are longs. Each round takes the
    smallest label among a vertex and its neighbours, then the label of that
    label, so paths shorten by half or more. Both joins are plain equi-joins
    whose hot keys adaptive execution splits, and the minimum is combined before
    it is shuffled. Rounds end when no label changes; an empty graph gives an
    empty result, and repeated edges or loops change nothing.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = cut(both.distinct())
    labels = cut(
        both.groupBy(F.col("a").alias("vertex"))
        .agg(F.min("b").alias("component"))
        .select("vertex", F.least("vertex", "component").alias("component"))
    )
    while True:
        offered = both.join(labels.withColumnRenamed("vertex", "b"), "b").select(
            F.col("a").alias("vertex"), "component"
        )
        lowest = labels.union(offered).groupBy("vertex").agg(F.min("component").alias("near"))
        jump = labels.select(F.col("vertex").alias("near"), F.col("component").alias("far"))
        new = cut(
            lowest.join(jump, "near")
            .join(labels, "vertex")
            .select("vertex", F.least("near", "far").alias("component"), F.col("component").alias("old"))
        )
        changed = new.filter(F.col("component") != F.col("old")).limit(1).count()
        labels = new.select("vertex", "component")
        if not changed:
            return labels

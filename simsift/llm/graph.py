"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simsift.llm.common import cut


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every node of ``edges`` (a, b); a component is named by its smallest id.

    Smallest labels spread over the edges and jump along their own labels, so
    the rounds grow with the logarithm of the longest path. Each round is a
    join and a pre-aggregated minimum; a round's result is checkpointed. The
    driver sees one number per round.
    """
    edges = edges.where(F.col("a") != F.col("b"))
    both = cut(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut(both.groupBy(F.col("a").alias("id")).agg(F.min(F.least("a", "b")).alias("component")))
    while True:
        near = (both.join(labels.select(F.col("id").alias("b"), "component"), "b")
                .groupBy(F.col("a").alias("id")).agg(F.min("component").alias("near")))
        lower = labels.join(near, "id").select("id", F.least("component", "near").alias("component"),
                                               F.col("component").alias("old"))
        names = lower.select(F.col("id").alias("component"), F.col("component").alias("further"))
        after = cut(lower.join(names, "component", "left")
                    .select("id", F.least("component", F.coalesce("further", "component")).alias("component"), "old"))
        changed = after.where(F.col("component") != F.col("old")).count()
        labels = after.select("id", "component")
        if not changed:
            return labels

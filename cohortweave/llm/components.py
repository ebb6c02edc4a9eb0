"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortweave.sources.workspace import stored

# Rows of two or three longs that are broadcast at most; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000


def small(df: DataFrame, rows: int) -> DataFrame:
    """The table, to be broadcast if it has few rows."""
    return F.broadcast(df) if rows <= BROADCAST_IDS else df


def components(links: DataFrame, a: str = "a", b: str = "b", known: DataFrame | None = None) -> DataFrame:
    """(node, component): the smallest node reachable from each node that has a link.

    Each round takes the smallest label among a node's neighbours, then the label of that label, so
    stars settle at once and chains in few rounds. Rounds are written to the shared folder. `known` are
    components of some of the links, to begin with.
    """
    there = links.select(F.col(a).alias("node"), F.col(b).alias("other"))
    there = there.unionByName(there.select(F.col("other").alias("node"), F.col("node").alias("other")))
    n = there.count()
    both = stored(there, "links", n)
    own = both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("component"))
    if known is not None:
        before = known.select("node", F.col("component").alias("_known"))
        own = own.join(small(before, n), "node", "left").select("node", F.least("component", "_known").alias("component"))
    labels = stored(own, "labels", n)
    while True:
        near = small(labels.select(F.col("node").alias("other"), "component"), n)
        jump = small(labels.select(F.col("node").alias("_label"), F.col("component").alias("_jump")), n)
        seen = both.join(near, "other").select("node", "component", F.lit(None).cast(labels.schema["component"].dataType).alias("_own"))
        lower = seen.unionByName(labels.withColumn("_own", F.col("component"))).groupBy("node").agg(
            F.min("component").alias("_label"), F.max("_own").alias("_old")
        )
        new = stored(
            lower.join(jump, "_label", "left").select("node", "_old", F.least("_label", "_jump").alias("component")), "labels", n
        )
        labels = new.select("node", "component")
        if new.filter(F.col("_old") != F.col("component")).isEmpty():
            return labels

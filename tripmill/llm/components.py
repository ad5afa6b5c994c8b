"""Connected components of a graph that lies in tables, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import stored


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component`` (its smallest node) for every node of an edge between two nodes.

    Each round sends every node to its smallest neighbour, follows those links twice more, and keeps
    the edges between different nodes that are left. Rounds are written to the shared folder; only the
    number of edges left reaches the driver. Null ends and loops are no edges; repeats do no harm.
    """
    left = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    left = stored(left.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    found = None
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = stored(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("component")), "parents")
        for _ in range(2):
            up = parent.select(F.col("node").alias("component"), F.col("component").alias("above"))
            parent = parent.join(up, "component").select("node", F.col("above").alias("component"))
        parent = stored(parent, "parents")
        if found is None:
            found = parent
        else:
            found = found.join(parent.select(F.col("node").alias("component"), F.col("component").alias("above")), "component", "left")
            found = stored(found.select("node", F.coalesce("above", "component").alias("component")), "components")
        for end in ("a", "b"):
            left = left.join(parent.select(F.col("node").alias(end), F.col("component").alias("to")), end).withColumn(end, F.col("to")).drop("to")
        left = left.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        left = stored(left, "edges")
    if found is None:
        return left.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return found

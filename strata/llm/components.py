"""Connected components of an edge table, by alternating large and small stars.

Every step is a grouped minimum (partially aggregated) and a shuffle join whose
both sides are written tables, so AQE can split a hub's rows. No edge, label
or component passes through the driver; a round only returns two numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from strata.session import materialize


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, component)`` for every node of ``edges`` that isn't the smallest
    of its component; ``component`` is that smallest node.

    Null ends and self-loops link nothing. An empty edge table gives no rows.
    """
    e = (edges.where(F.col(a) != F.col(b))
         .select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct())
    e = materialize(e, "edges")
    seen = _signature(e)
    while True:
        # Large star: what lies above a node links to the node's smallest neighbour.
        low = materialize(e.groupBy("hi").agg(F.min("lo").alias("m")), "lows").withColumnRenamed("hi", "node")
        large = materialize(
            e.join(low, e["lo"] == low["node"], "left").select("hi", F.coalesce("m", "lo").alias("lo")).distinct(),
            "large")
        # Small star: a node and what lies below it link to the smallest below.
        low = materialize(large.groupBy("hi").agg(F.min("lo").alias("m")), "lows")
        below = large.join(low, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        e = materialize(below.unionByName(low.withColumnRenamed("m", "lo")).distinct(), "small")
        now = _signature(e)
        if now == seen:
            return e.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
        seen = now

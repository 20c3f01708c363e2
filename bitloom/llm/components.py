"""Connected components as DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .spill import delete, stored


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Columns ``node`` and ``component`` (the component's smallest node).

    Nodes are of any ordered type.  Edges with a null end, loops and repeated
    edges are ignored; nodes without an edge are not in the result; no edges
    give an empty result.

    Each round points every node at its smallest neighbour, jumps one pointer
    further, and hands its other smaller neighbours on to that pointer's
    target.  Edges never get more, pointers halve the depth, so a round count
    logarithmic in the diameter is usual.  Hot nodes: the minimum is
    pre-aggregated, and joins keep their large side splittable (AQE).
    """
    spark = edges.sparkSession
    pairs = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
    pairs, old = stored(pairs.distinct(), "edges")
    while True:
        tops, tops_at = stored(pairs.groupBy("hi").agg(F.min("lo").alias("top"), F.count("*").alias("n")), "tops")
        above = tops.select(F.col("hi").alias("top"), F.col("top").alias("above"))
        jumped = tops.join(above, "top", "left").select(
            "hi", F.coalesce("above", "top").alias("to"), ((F.col("n") > 1) | F.col("above").isNotNull()).alias("moved")
        )
        jumped, jumped_at = stored(jumped, "jumped")
        delete(spark, tops_at)
        if jumped.where("moved").isEmpty():
            delete(spark, old)
            break
        handed = pairs.join(jumped, "hi").where(F.col("lo") != F.col("to")).select(F.greatest("lo", "to").alias("hi"), F.least("lo", "to").alias("lo"))
        pairs, new = stored(handed.union(jumped.select("hi", F.col("to").alias("lo"))).distinct(), "edges")
        delete(spark, old)
        delete(spark, jumped_at)
        old = new
    inner = jumped.select(F.col("hi").alias("node"), F.col("to").alias("component"))
    return inner.union(inner.select(F.col("component").alias("node"), "component").distinct())

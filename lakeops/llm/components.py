"""Connected components of a graph held as a frame of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.durable import materialize


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``root``, the smallest node it is connected with, for all but the roots.

    Edges are moved in alternating steps until all point at their component's smallest
    node: the large-star step gives a node's larger neighbours its smallest neighbour,
    the small-star step its smaller ones. Edges never grow in number, a node's
    neighbours are only aggregated and joined, and each round is written to the shared
    folder. Loops and repeated edges add nothing.
    """
    at = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    at = materialize(at, "edges")
    before = None
    while True:
        # large star: every edge seen from both ends
        both = at.unionByName(at.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: every edge seen from its larger end
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        at = materialize(moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        now = tuple(at.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            return at.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now

"""Connected components of an edge table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang the neighbours of each node on the least of them and itself.

    The least neighbour is an aggregate combined in each task; a hub's neighbours never meet in one row.
    """
    flipped = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    both = edges.unionByName(flipped) if large else edges
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    joined = both.join(least, "u")
    if large:
        return joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    own = least.select("u", F.col("m").alias("v"))
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(own).filter("u != v").distinct()


def components(edges: DataFrame, name: str = "component-edges") -> DataFrame:
    """``u`` and ``v`` with the least node ``v`` of each ``u``'s component; nodes without an edge are left out.

    Every round's edges (directed from the greater node to the smaller) are written to the shared folder, which
    cuts the lineage. The loop ends when a round leaves the edges as they were.
    """
    edges = materialize(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                        .filter("u != v").distinct(), name)
    before = None
    while True:
        edges = materialize(_star(_star(edges, large=True), large=False), name)
        state = edges.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 31)))).first()
        if tuple(state) == before:
            return edges
        before = tuple(state)

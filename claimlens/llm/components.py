"""Connected components of an edge table by repeated minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); the root is the least node of its component.

    Rounds alternate between two star operations: every node hands its larger, then
    its smaller neighbours the least node it knows. The number of rounds grows with
    the logarithm of the longest path; edges never outnumber those given. Nodes with
    very many neighbours are combined map-side, never collected. Loops and repeated
    edges are ignored; an empty table gives no rows.
    """
    both = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    current = materialize(both)
    seen = None
    while True:
        # large star: the larger neighbours of a node, and no others, move to its least neighbour
        ways = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = ways.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = ways.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: the smaller neighbours of a node and the node itself move to the least of them
        floor = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(floor, "u")
        small = (
            joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(joined.select("u", F.col("m").alias("v")))
            .where("u <> v")
            .distinct()
        )
        current = materialize(small)
        # a fixed point has the same edges twice in a row
        mark = tuple(current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if mark == seen:
            break
        seen = mark
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        current.select(F.col("v").alias("node"), F.col("v").alias("root"))
    ).distinct()

"""Connected components of an edge table by alternating stars.

Each round sends every larger neighbour of a node to the smallest one (large
star), then every smaller neighbour (small star); it ends when the edges are
stars around the smallest node of each component. Grouped minima combine on
the map side and the joins on a hub are split by AQE, so a component that
holds a third of all nodes needs no large task. Rounds grow with the logarithm
of the component's diameter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldcraft.session import drop_scratch, materialize


def _large(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    return (both.filter("b > a").join(least, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())


def _small(e: DataFrame) -> DataFrame:
    least = e.groupBy("a").agg(F.min("b").alias("m"))
    moved = (e.join(least, "a").filter("b <> m")
             .select(F.col("b").alias("a"), F.col("m").alias("b")))
    return moved.unionByName(least.withColumnRenamed("m", "b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` long ids, any order, loops and repeats allowed ->
    ``(node, component)`` for every node of an edge between two nodes;
    ``component`` is the smallest node reachable. Nulls link nothing."""
    e = materialize(
        edges.filter("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    while True:
        mark = e.agg(F.count("*").alias("n"),
                     F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if mark["n"] == 0 or (mark["n"], mark["s"]) == seen:
            break
        seen = (mark["n"], mark["s"])
        after = materialize(_small(_large(e)), "edges")
        drop_scratch(e)
        e = after
    roots = e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)

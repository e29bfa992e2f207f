"""Connected components by alternating large-star and small-star steps.

Links are (a, b) pairs of ids; every node ends up with the smallest id of its
component. The number of rounds grows with the logarithm of the graph, whatever
its diameter, and no component is gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorewright.session import cut


def _large_star(e: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is hung on the node's smallest neighbour (or itself)."""
    both = e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return (
        both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
    )


def _small_star(e: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are hung on the smallest of them."""
    down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(low.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node, component`` for every node that has a link to another.

    Null ends and self-links are ignored; repeated links count once.
    """
    e = cut(
        edges.select(F.col(edges.columns[0]).alias("a"), F.col(edges.columns[1]).alias("b"))
        .where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .distinct()
    )
    last = None
    for _ in range(max_rounds):
        e = cut(_small_star(_large_star(e)))
        mark = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).collect()[0]
        if (mark["n"], mark["h"]) == last:
            break
        last = (mark["n"], mark["h"])
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )

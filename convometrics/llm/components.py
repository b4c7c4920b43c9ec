"""Connected components of a graph given as edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convometrics.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every node of ``edges`` (a, b); the component is its smallest id.

    Each step regroups the edges around smaller neighbours and is written, so
    that a lost executor does not undo the steps before; it ends when a step
    changes nothing.  Only counts and checksums reach the driver.
    """
    now = stored(
        edges.filter(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    mark = _checksum(now)
    while True:
        now = stored(_small_star(_large_star(now)), "edges")
        last, mark = mark, _checksum(now)
        if mark == last:
            break
    # every node now hangs on the smallest of its component
    roots = now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(roots)


def _checksum(edges: DataFrame) -> tuple:
    mixed = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), mixed).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the smallest of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # written, so that the join shuffles both sides and a hub can be split
    least = stored(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
    hung = both.filter(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hung.filter(F.col("a") != F.col("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the smallest of them (edges go from larger to smaller)."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    hung = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = least.select("a", F.col("m").alias("b"))
    return hung.unionByName(own).filter(F.col("a") != F.col("b")).distinct()

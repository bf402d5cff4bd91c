"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import forget, written


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, component): component is the smallest node that node can reach.

    Only nodes with a link to another node are returned. Each round is two aggregations
    and two equi-joins on the current links, written to the shared folder in place of the
    round before; the number of rounds grows with the logarithm of a component's size, and
    links that are stars around their least node already need none. Nothing is collected.
    Null ends are ignored.
    """
    a, b = F.col(src), F.col(dst)
    e = written(edges.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct())
    while not _stars(e):
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(e.select("b", "a"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        before, e = e, written(small.unionAll(low.select("a", F.col("m").alias("b"))).distinct())
        forget(before)
    own = e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(own)


def _stars(e: DataFrame) -> bool:
    """Whether every a has one b and no b is an a: then each b is its component's least node."""
    twice = e.groupBy("a").agg(F.count("*").alias("n")).where("n > 1").select("a")
    inner = e.select("b").distinct().join(e.select(F.col("a").alias("b")), "b", "left_semi")
    return twice.unionAll(inner).isEmpty()

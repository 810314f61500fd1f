"""Connected components by large-star and small-star steps, all of it in written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlens.workspace import snapshot


def _star(edges: DataFrame, only_larger: bool) -> DataFrame:
    """Join every neighbour of ``a`` (the larger ones, or the smaller ones and itself) to the least of them."""
    least = snapshot(edges.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("least")))
    joined = edges.join(least, "a")
    if only_larger:
        moved = joined.filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        moved = joined.filter("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b")).union(least.filter("a <> least"))
    return moved.distinct()


def components(edges: DataFrame) -> DataFrame:
    """The least node of each node's component: ``node, component``, for nodes other than that least one.

    ``edges`` has two columns of ids, in any direction, repeated or not.  Every step is written, so a lost executor
    costs one step; only two numbers per step reach the driver.
    """
    a, b = edges.columns
    current = snapshot(
        edges.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()
    )
    before = None
    while True:
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _star(both, only_larger=True)
        large = snapshot(large)
        current = snapshot(_star(large, only_larger=False))
        state = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return current.select(F.col("a").alias("node"), F.col("b").alias("component"))
        before = state

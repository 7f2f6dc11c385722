"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbook.llm.common import stored


def _nearest(edges: DataFrame) -> DataFrame:
    """Each edge seen from both ends (u, v) with ``low``, the smallest of u and all its neighbours."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
    low = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
    return both.join(low, "u")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of the edges (a, b), root the smallest node it is connected to.

    Alternates large-star and small-star steps until the edges are stars: each step hangs neighbours on the smallest
    node around, so the number of edges never grows and the number of rounds is about the logarithm of the longest
    path. Each round is written to the shared folder. A hub is one row per task in the minimum, and the join back is an
    inner join that adaptive execution may split.
    """
    now = stored(edges.filter(F.col("a") != F.col("b")).select("a", "b").distinct(), "edges")
    state = None
    while True:
        large = _nearest(now).filter(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("low").alias("b"))
        down = large.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
        low = down.groupBy("u").agg(F.min("v").alias("low"))
        small = down.join(low, "u").select(F.col("v").alias("a"), F.col("low").alias("b"))
        small = small.union(low.select("u", "low")).filter(F.col("a") != F.col("b")).distinct()
        now = stored(small, "edges")
        found = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if found == state:
            break
        state = found
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )

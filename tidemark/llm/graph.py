"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import settled


def _with_least(pairs: DataFrame) -> DataFrame:
    """Each (u, v) with ``m``, the least of u and all its v.

    The minima are combined before the shuffle and settled, so both sides of
    the join are plain exchanges and a hub's rows can be split.
    """
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
    least = settled(least, "least")
    return pairs.join(least, pairs["u"] == least["k"]).drop("k")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_least(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    linked = _with_least(down)
    moved = F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v"))))
    return linked.select(moved.alias("e")).select("e.u", "e.v").filter("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (u, v: bigint, u <> v) to (node, root): root is the least node.

    Nodes without an edge do not appear. An empty table gives an empty table.
    The rounds end when the set of edges stays the same, by count and hash.
    """
    now, mark = settled(edges.select("u", "v").distinct(), "edges"), None
    while True:
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == mark or seen[0] == 0:
            break
        mark = seen
        now = settled(_small_star(settled(_large_star(now), "large")), "small")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots).distinct()

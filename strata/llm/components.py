"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.store import saved


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links(a, b)``: the smallest node that it reaches.

    Alternates the two star steps: each node hands its larger neighbours, then its smaller ones, to the smallest
    node that it knows. Rounds grow with the logarithm of the longest chain. A node with very many links costs a
    partial minimum before the shuffle and a join whose hot key adaptive execution splits; no group is collected.
    An empty table gives an empty one; links of a node with itself and null ends count for nothing.
    """
    links = links.select(F.col("a").cast("bigint").alias("a"), F.col("b").cast("bigint").alias("b"))
    edges = saved(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        edges = saved(
            large.join(small, "a")
            .select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
            .select("e.*")
            .filter("a <> b")
            .distinct(),
            "links",
        )
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    stars = edges.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node")
    roots = edges.select(F.col("b").alias("node")).distinct().join(stars.select("node"), "node", "left_anti")
    return stars.unionByName(roots.select("node", F.col("node").alias("component")))

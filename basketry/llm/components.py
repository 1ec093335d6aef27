"""Connected components of an edge table by alternating star contraction.

Each round lets every node send its larger neighbours, then its smaller ones,
to the least node it sees; rounds repeat until the edges no longer change.
Edges live in the shared folder between rounds, nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import materialise


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    inner = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return inner.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v: long), roots included.

    The root is the least node of the component.  Self-loops and repeated edges
    do no harm; an empty table gives an empty table.
    """
    now = materialise(edges.where("u <> v").select("u", "v"), "edges")
    mark = None
    while True:
        now = materialise(_small_star(_large_star(now)), "edges")
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == mark:
            break
        mark = seen
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.union(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())

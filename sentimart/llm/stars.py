"""Connected components by alternating large-star and small-star steps.

An edge table (a, b) is rewritten until every component is a star around its smallest node:

* large-star: each node sends the neighbours that are larger than itself to the smallest of its neighbours and itself;
* small-star: each node sends its smaller neighbours and itself to the smallest of these.

Both keep components and never add edges beyond one for each old one. Per round an edge table is stored in the shared
folder; the driver sees two numbers (count and a hash sum), which stop changing when the stars are done.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentimart.llm.scratch import release, stored


def large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def small_star(edges: DataFrame) -> DataFrame:
    """edges point from the larger to the smaller node."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).filter("a <> b")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node on an edge; root: the smallest node connected with it."""
    now = stored(edges.select("a", "b").filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "star")
    mark = None
    while True:
        old, now = now, stored(small_star(large_star(now).distinct()).distinct(), "star")
        release(old)
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark:
            break
        mark = tuple(seen)
    roots = now.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)

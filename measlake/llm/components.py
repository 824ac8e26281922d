"""Connected components of a table of edges, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from measlake.llm.common import kept


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the smallest node reachable.

    Rounds of large-star and small-star: every node first links its larger
    neighbours to its smallest one, then itself and its smaller neighbours to
    the smallest. Minima are aggregated before they are joined to the edges, so
    that a hub's edges may be split. Every round is written to the shared
    folder. Null nodes and loops are ignored; no edges, no rows.
    """
    now = kept(edges.where("a <> b").select("a", "b").distinct(), name)
    seen = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
        both = now.union(now.select("b", "a"))
        least = both.groupBy(F.col("a").alias("n")).agg(F.least("n", F.min("b")).alias("m"))
        large = (
            both.where("b > a").join(least, F.col("a") == F.col("n")).select(F.col("b"), F.col("m"))
        )
        # Each row leads from a larger node to a smaller one.
        down = large.toDF("a", "b").distinct()
        least = down.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"))
        joined = down.join(least, F.col("a") == F.col("n"))
        small = joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        own = least.select(F.col("n").alias("a"), F.col("m").alias("b"))
        now = kept(small.union(own).distinct(), name)
    roots = now.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())

"""Connected components of a link table, by alternating large and small stars.

Every round is two min-aggregations with joins; nothing is collected, and each
round's links are written to the shared folder (lost executors re-read them).
Links shrink to stars (node, smallest node of its component) in O(log^2 n)
rounds, so long chains need no more rounds than their logarithm.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select("a", "b").unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b")
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    rest = down.join(low, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return rest.unionAll(low.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``links(a, b)`` to ``(node, root)``: root is the smallest node reachable.
    Roots themselves and nodes without a link are absent.  Self links and repeated links are ignored."""
    spark = links.sparkSession
    e = common.materialize(links.select("a", "b").filter("a <> b"), "links")
    mark = None
    for _ in range(max_rounds):
        new = common.materialize(_small_star(_large_star(e)), "links")
        common.remove(e, spark)
        e = new
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == mark:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")

"""Connected components by alternating large-star and small-star steps (joins and aggregates only)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

#: Steps after which something must be wrong; the number needed grows with the logarithm of a component's size.
MOST_STEPS = 60


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """(u, root) for every node ``u`` that is not itself the smallest node of its component.

    ``edges`` has long columns u and v, in any direction.  No neighbour list is
    collected: a hub's edges stay rows, aggregated by ``min`` before the shuffle and
    joined by a join that Spark can split.
    """
    e = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = _state(e)
    for _ in range(MOST_STEPS):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # the minima are a table of their own, so that Spark can split a hub's rows in the join
        low = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = written(large)
        low = written(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(low, "u")
        e = written(small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
                    .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        now = _state(e)
        if now == before:
            return e.select("u", F.col("v").alias("root"))
        before = now
    raise RuntimeError(f"components did not settle in {MOST_STEPS} steps")

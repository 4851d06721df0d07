"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tipoff.llm import _common


def components(edges: DataFrame, scratch: _common.Scratch, rounds: int = 60) -> DataFrame:
    """node and component (its smallest node) of every node that has an edge; edges: u, v (long).

    Minima are combined before each shuffle and written, so that the joins of edges with them have two plain sides: Spark can split the
    edges of a busy node, and no node's neighbours meet in a task.
    """
    e = scratch.keep(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    for _ in range(rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        near = scratch.keep(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "minima")
        e2 = both.hint("merge").join(near.hint("merge"), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        e2 = scratch.keep(e2, "edges")
        least = scratch.keep(e2.groupBy("u").agg(F.min("v").alias("m")), "minima")
        small = e2.hint("merge").join(least.hint("merge"), "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        new = scratch.keep(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        scratch.drop(e, near, e2, least)
        e = new
        now = tuple(e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).collect()[0])
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())

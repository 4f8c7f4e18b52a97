"""Connected components by alternating large-star and small-star steps.

Every step is a minimum per node (partially aggregated before the shuffle) joined back to the
edges; adaptive execution splits the join partitions of a node with very many edges. No task and
no driver ever holds a component. Each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise

MAX_ROUNDS = 60


def _to_minimum(edges: DataFrame, keep) -> DataFrame:
    low = edges.groupBy("u").agg(F.min("v").alias("_low"))
    met = edges.join(low, "u").withColumn("_m", F.least("u", "_low"))
    return met.filter(keep(met)).select(F.col("v").alias("u"), F.col("_m").alias("v"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (_to_minimum(both, lambda d: d["v"] > d["u"])
            .filter("u <> v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("_m"))
    moved = down.join(low, "u").filter("v <> _m").select(F.col("v").alias("u"),
                                                         F.col("_m").alias("v"))
    kept = low.select("u", F.col("_m").alias("v"))
    return moved.unionByName(kept).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node with an edge; ``root`` is the smallest node reachable.

    ``edges``: ``u`` and ``v`` (long). Self-loops, repeated and reversed edges do no harm; no
    edges give no rows.
    """
    current = materialise(edges.filter("u <> v").select("u", "v").distinct(), "cc")
    seen = None
    for _ in range(MAX_ROUNDS):
        mark = current.agg(F.count(F.lit(1)).alias("n"),
                           F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if mark["n"] == 0 or (mark["n"], mark["x"]) == seen:
            break
        seen = (mark["n"], mark["x"])
        current = materialise(_small_star(_large_star(current)), "cc")
    else:
        raise RuntimeError("components did not settle")
    # Every edge is now (node, root).
    roots = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())

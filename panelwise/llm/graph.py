"""Connected components of a link table, by rounds of joins.

Large-star / small-star: every node links itself to the smallest node of its
neighbourhood, in turn over larger and smaller neighbours, until nothing
changes. Each round is one grouping by node of (node, neighbour) rows. A hot
node keeps only its links to larger or smaller neighbours and is handled with
a minimum (combined before the shuffle) and a join, never as a collected group.
Each round's links are written to the scratch folder, which cuts lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import written

ROUNDS = 60


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One star round over links (u, v) with u > v."""
    both = links if not large else links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("__u"), F.least("u", "m").alias("m"))
    moved = both.join(least, F.col("u") == F.col("__u"))
    if large:  # larger neighbours, and the node itself, to the least
        out = moved.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        out = out.unionByName(least.select(F.col("__u").alias("u"), F.col("m").alias("v")))
    else:      # smaller neighbours and the node itself to the least
        out = moved.select(F.col("v").alias("u"), F.col("m").alias("v"))
        out = out.unionByName(least.select(F.col("__u").alias("u"), F.col("m").alias("v")))
    return out.where(F.col("u") != F.col("v")).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): for every node that has a link to another node, the
    smallest node it can reach. Nodes: any ordered type."""
    e = (links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
         .where(F.col("u") != F.col("v")).distinct())
    e = written(e, "links")
    before = None
    for _ in range(ROUNDS):
        e = written(_star(_star(e, True), False), "links")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    # Settled links are stars: every node beside its root.
    roots = e.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)

"""Connected components of a link table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewrank.session import written

#: Rounds grow with the logarithm of the longest chain of links.
MOST_ROUNDS = 60


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """``node, component`` for every node that has a link; the component is its smallest node.

    Each round links all neighbours of a node to its smallest one, first the larger neighbours, then
    the smaller ones (Kiveris et al., "Connected Components in MapReduce and Beyond", 2014). Minima are
    grouped with partial aggregation, and a hot centre meets its neighbours in a plain join, which
    adaptive execution splits. Rounds are cut by written tables. Null ends and self links are ignored.
    """
    a, b = F.col(left), F.col(right)
    ends = links.where(a.isNotNull() & b.isNotNull() & (a != b))
    edges = written(ends.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links")
    mark = None
    for _ in range(MOST_ROUNDS):
        edges = written(_small_star(_large_star(edges)), "links")
        row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(row) == mark or not row[0]:
            break
        mark = tuple(row)
    else:
        raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node's larger neighbours are linked to the smallest of it and its neighbours."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))  # edges run from larger u to smaller v
    larger = edges.select(F.col("v").alias("centre"), F.col("u").alias("leaf"))
    joined = larger.join(least.withColumnRenamed("u", "centre"), "centre", "left")
    return joined.select(F.col("leaf").alias("u"), F.coalesce("m", "centre").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are linked to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = edges.join(least, "u")
    moved = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()

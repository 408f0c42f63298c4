"""Connected components of links between integer nodes, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.session import materialize


def _large_star(links: DataFrame) -> DataFrame:
    """Hang the larger neighbours of every node on its smallest neighbour."""
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return (
        both.filter("v > u")
        .join(least, "u")
        .select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        .distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Hang the smaller neighbours of every node, and itself, on the smallest of them.

    `links` holds u > v only.
    """
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def component_of(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node that has a link.

    `links` (u, v) are undirected; loops, repeats and nulls are ignored. Each round is
    written to the scratch folder, so lineage stays short and a lost executor costs one
    round. A node with very many neighbours meets only aggregations, which combine before
    the shuffle, and joins, whose large keys adaptive execution splits.
    """
    links = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    now, before = materialize(links.filter("u > v").distinct(), "links"), None
    while True:
        # Sums over hashes tell whether a round changed anything.
        state = now.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if state == before or state[0] == 0:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        before = state
        now = materialize(_small_star(_large_star(now)), "links")

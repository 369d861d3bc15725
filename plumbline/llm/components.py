"""Connected components of a link table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import join_groups, store


def _large_star(links: DataFrame, total: int) -> DataFrame:
    """Hang every larger neighbour of a node on the smallest node around it; the few hubs are broadcast."""
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count("*").alias("n"))
    return (join_groups(both, least, ["u"], "n", 2 * total).where("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(links: DataFrame, total: int) -> DataFrame:
    """Hang a node and its smaller neighbours on the smallest of them; here u > v always."""
    least = links.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    moved = (join_groups(links, least, ["u"], "n", total).where("v <> m")
             .select(F.col("v").alias("u"), F.col("m").alias("v")))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, root)`` for each linked node but the roots: the smallest node that it reaches.

    Nodes without a link have no row. Self-links, nulls and repeated links change nothing.
    Every round only groups by node (combined in the map task) and joins on it, and is
    written to the shared folder, so that neither lineage nor a hub grows. Rounds are
    repeated until the links no longer change, which takes about log2 of the nodes.
    """
    links = (links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
             .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct())
    links, before = store(links, "links"), None
    while True:
        state = links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == before or state[0] == 0:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state
        # Either star has at most as many links as there were, and the hubs' share is of that number.
        links = store(_large_star(links, state[0]), "links")
        links = store(_small_star(links, state[0]), "links")

"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skewkit.session import materialize


def _star(rows: DataFrame, name: str) -> DataFrame:
    """(u, v, m): every row with the smallest neighbour m of its u, or u itself if smaller.

    The minima are written first, so the join reads two plain tables and a
    node with very many neighbours is split by the skew join.
    """
    least = materialize(rows.groupBy("u").agg(F.min("v").alias("m")), name)
    return rows.join(least, "u").select("u", "v", F.least("u", "m").alias("m"))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node that has a link; component is its smallest reachable node.

    Each round is a few joins and aggregates over the links, written to the
    shared folder; rounds grow with the logarithm of the longest chain. Nothing
    but a count and a checksum reaches the driver. Self links, repeated links and either
    order are fine; null ends are ignored; no links give no rows.
    """
    hi, lo = F.greatest(a, b), F.least(a, b)
    edges = materialize(
        links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .select(hi.alias("u"), lo.alias("v")).distinct(), "links")
    before = None
    while True:
        seen = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == before or seen[0] == 0:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        before = seen
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = materialize(_star(both, "star-min").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                            .where("u != v").distinct(), "large-star")
        small = _star(large, "star-min")
        edges = materialize(
            small.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(small.select("u", F.col("m").alias("v"))).where("u != v").distinct(), "small-star")

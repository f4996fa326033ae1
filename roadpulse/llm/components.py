"""Connected components of links between numbers, by alternating star operations on tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.session import written_out


def connected_components(links: DataFrame) -> DataFrame:
    """(``node``, ``component``): for each linked node the smallest node that it can reach.

    ``links`` has two columns of one integer type, in either direction, repeats allowed. Large-star and
    small-star rounds move every node's links to its smallest neighbour until each component is a star;
    the number of rounds grows with the logarithm of a component's diameter. Each round is written to
    the shared folder, so a lost executor costs a round at most.
    """
    a, b = links.columns
    edges = written_out(
        links.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct(),
        "links",
    )
    before = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            break
        before = now
        edges = written_out(_small_star(_large_star(edges)), "stars")
    own = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return own.unionByName(own.select(F.col("component").alias("node"), "component").distinct())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node's larger neighbours are linked to the smallest of its neighbours and itself."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy(F.col("u").alias("c")).agg(F.min("v").alias("m"))
    least = least.select("c", F.least("c", "m").alias("m"))
    larger = both.where("v > u").join(least, F.col("u") == F.col("c"))
    return larger.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are linked to the smallest of them."""
    least = edges.groupBy(F.col("u").alias("c")).agg(F.min("v").alias("m"))
    moved = edges.join(least, F.col("u") == F.col("c")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select(F.col("c").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(own).where("u != v").distinct()

"""Connected components of a link table by alternating star contraction.

Each round has a large-star and a small-star step, written as aggregates and
joins, so a hub's neighbours are never gathered in one row. A round ends in a
reliable checkpoint; the rounds stop when the links no longer change, which
takes a number of rounds logarithmic in practice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.llm.common import checkpointed


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node with a link to another node.

    ``component`` is the smallest node reachable, itself included. Links may
    repeat, come in either direction or be loops; nulls in either end are no
    links.
    """
    edges = checkpointed(
        links.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct()
    )
    before = None
    while True:
        now = edges.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if now[0] == 0 or now == before:
            break
        before = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.join(least, "u").where("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        root = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(root, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = checkpointed(small.unionByName(root.select("u", F.col("m").alias("v"))).distinct())
    roots = edges.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)

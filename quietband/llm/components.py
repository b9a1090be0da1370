"""Connected components of a distributed edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quietband.llm.common import stored


def components(edges: DataFrame, a: str, b: str, label: str) -> DataFrame:
    """(node, root) for every node of the edges (a, b); root is the smallest node of its component.

    Alternates the large-star and small-star steps of distributed union-find until the edges no longer change: every
    step is a map-side combined minimum per node and a join with it, so a node with very many edges is an ordinary skewed
    join. Each round is written to the shared folder; only a count and a checksum come to the driver.
    Loops (a node linked with itself) and repeated edges are allowed; null ends are ignored.
    """
    pairs = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    star = stored(
        pairs.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), f"{label}-edges"
    )
    before, round_ = None, 0
    while True:
        state = star.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u") % 1_000_003)).first()
        if state == before:
            break
        before = state
        both = star.where("u != v").unionByName(star.where("u != v").select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        star = stored(
            small.unionByName(least.select("u", F.col("m").alias("v")))
            .unionByName(star.where("u = v")).distinct(),
            f"{label}-{round_}",
        )
        round_ += 1
    roots = star.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return star.where("u != v").select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        roots.join(star.where("u != v").select(F.col("u").alias("node")), "node", "left_anti")
    )

"""Connected components of a graph of links, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.session import stage

#: Rounds grow with the logarithm of the longest path; more than this is a fault.
MAX_ROUNDS = 60


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of a link; root is the smallest node of its component.

    Alternates two steps until nothing changes: every node tells its larger neighbours, then
    its smaller ones, of the smallest it knows (large star, small star).  Minima are combined
    before the shuffle, and the joins are plain ones that adaptive execution can split, so a
    node with very many links takes no task of its own.  Links to a null node or to oneself
    are ignored.  Each round is written to the shared folder.
    """
    edges = stage(
        links.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct(),
        "links",
    )
    before = None
    for _ in range(MAX_ROUNDS):
        now = edges.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")
        ).first()
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        before = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (
            both.join(lowest, "u")
            .filter("v > u AND v > m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        large = stage(large, "large-star")
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(lowest, "u")
            .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                      F.struct("u", F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .filter("u > v")
            .distinct()
        )
        edges = stage(small, "small-star")
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")

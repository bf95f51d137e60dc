"""Connected components of a table of links, by alternating star contractions.

Large-star links each node's larger neighbours to its smallest neighbour; small-star
links its smaller neighbours and itself to the smallest of them.  After a logarithmic
number of rounds every node hangs on the smallest of its component.  Each step is a
grouped minimum (summed up before the shuffle) and a join back, which Spark can split
where a node has many links; rounds are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vexel.llm.common import drop_stage, stage


def _lowest(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = _lowest(both).select("u", F.least("u", "m").alias("m"))
    return (
        both.join(low, "u")
        .where("v > u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    low = _lowest(edges)
    moved = (
        edges.join(low, "u")
        .where("v <> m")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
    )
    return moved.union(low.select("u", F.col("m").alias("v"))).distinct()


def _digest(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.col("v") % 1_000_003)
    ).first()
    return tuple(row)


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links (u, v)`` but the roots themselves.

    ``root`` is the smallest node of the component.  Links may repeat and may point
    either way; links of a node to itself and links with a null say nothing.
    """
    edges = stage(
        links.where("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(),
        "links",
    )
    seen = _digest(edges)
    while seen[0]:
        following = stage(_small_star(_large_star(edges)), "links")
        drop_stage(edges)
        edges, before, seen = following, seen, _digest(following)
        if seen == before:
            break
    found = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    found._vexel_path = edges._vexel_path
    return found

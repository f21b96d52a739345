"""Connected components of an edge table, as rounds of joins over staged tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiersmith.session import stage


def _star(edges: DataFrame) -> DataFrame:
    """Tie the larger neighbours of every node to its smallest neighbour or itself.

    The smallest neighbour is pre-aggregated on the map side, and the join
    with it may be split where a node has very many neighbours.
    """
    around = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = around.groupBy("a").agg(F.min("b").alias("least"))
    large = (
        around.where("b > a")
        .join(least, "a")
        .select(F.col("b").alias("a"), F.least("a", "least").alias("b"))
    )
    return large.where("a <> b").distinct()


def _fold(edges: DataFrame) -> DataFrame:
    """Tie every node and its smaller neighbours to the smallest of them (``a > b`` in each edge)."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    tied = edges.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    own = least.select("a", F.col("least").alias("b"))
    return tied.unionByName(own).where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` of every node in ``edges`` (``a``, ``b``); the root is its least node.

    Large-star and small-star rounds, each staged in the shared folder, until
    a round changes nothing. Self loops are ignored, so a node with no other
    link is not in the result. No links reach the driver, only a count and a
    checksum of each round.
    """
    current = stage(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    seen = None
    while True:
        mark = current.agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s"),
        ).first()
        if seen == (mark["n"], mark["s"]) or not mark["n"]:
            break
        seen = (mark["n"], mark["s"])
        current = stage(_fold(_star(current)), "edges")
    members = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = current.select("b").distinct()
    return members.unionByName(roots.select(F.col("b").alias("node"), F.col("b").alias("root")))

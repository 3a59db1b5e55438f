"""Connected components of a link table, by Spark joins alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightwater.session import written


def _nearest(edges: DataFrame) -> DataFrame:
    """For each node of a symmetric edge table the smallest of itself and its neighbours."""
    return edges.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))


def _mark(edges: DataFrame) -> tuple:
    """Number and sum of hashes of the edges, to see whether a round changed them."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """The smallest node each linked node can reach: ``(id, component_id)``.

    ``links`` has columns ``a`` and ``b`` of one type, in any direction;
    repeated rows and self-links change nothing, rows with a null are ignored.
    Nodes without a link do not appear. An empty table gives no rows.

    Each round hangs every node's greater neighbours, then its smaller ones,
    onto the smallest node it sees (the large-star and small-star steps), which
    shortens paths to stars in a number of rounds logarithmic in their length. Minima are
    combined before the shuffle and edges meet them in a join, so no hub's
    neighbours are gathered. Each round's edges are written to the shared
    folder; the loop ends when a round changes nothing.
    """
    edges = (
        links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    edges = written(edges, "links")
    before = _mark(edges)
    if not before[0]:
        return edges.select(F.col("a").alias("id"), F.col("b").alias("component_id"))
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = (
            both.join(_nearest(both), "a")
            .where("b > a")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where("a <> b")
            .distinct()
        )
        large = written(large, "large-star")
        small = large.join(large.groupBy("a").agg(F.min("b").alias("m")), "a")
        small = (
            small.select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e"))
            .select("e.a", "e.b")
            .where("a <> b")
            .distinct()
        )
        edges = written(small, "small-star")
        mark = _mark(edges)
        if mark == before:
            return edges.select(F.col("a").alias("id"), F.col("b").alias("component_id")).unionByName(
                edges.select(F.col("b").alias("id"), F.col("b").alias("component_id")).distinct()
            )
        before = mark
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")

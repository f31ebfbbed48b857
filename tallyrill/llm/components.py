"""Connected components of a link table by alternating large-star and small-star steps.

Every step is a minimum per vertex and a join on the vertex; the links stay in written tables, so
nothing is collected and a lost executor costs only its share of one step. The number of rounds
grows with the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyrill.llm.common import write_once


def _larger_to_least(links: DataFrame) -> DataFrame:
    """Large star: every neighbour above a vertex is linked to the least of its neighbourhood."""
    both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where("a <> b").distinct())


def _smaller_to_least(links: DataFrame) -> DataFrame:
    """Small star: the neighbours below a vertex, and the vertex, are linked to the least of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    return (down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionAll(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct())


def components(links: DataFrame) -> DataFrame:
    """``node``, ``root``: every linked vertex but the roots themselves, with the least vertex it reaches.

    ``links`` has two long columns ``a`` and ``b``; loops and repeated links do no harm, links with
    a null end are left out. No links give an empty result.
    """
    now = write_once(links.where("a is not null and b is not null and a <> b").select("a", "b").distinct(), "links")
    before = None
    while True:
        now = write_once(_smaller_to_least(_larger_to_least(now)), "links")
        # A forest of stars is a fixed point; equal sums of hashes mean the same set of links.
        said = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if tuple(said) == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = tuple(said)

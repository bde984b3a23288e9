"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stardw.llm.tables import in_tasks, stored


def _signature(edges: DataFrame):
    """The number of links and two sums of hashes of all of them, in one row."""
    sums = [F.sum(F.xxhash64(F.lit(seed), "a", "b").cast("decimal(38,0)")) for seed in (1, 2)]
    return edges.agg(F.count("*"), *sums).first()


def components(links: DataFrame) -> DataFrame:
    """(`node`, `root`) for every end of a link (`a`, `b`): the smallest node it reaches.

    Each round links every node to the smallest node next to it and every
    neighbour to that node's own smallest (large and small stars), so the
    rounds grow with the logarithm of the longest chain. Rounds are written to
    the shared folder; a node with very many neighbours is only ever reduced
    by aggregates that combine in each task. Rounds end when one leaves the links as
    they were, which their number and two sums of hashes of all of them tell. No
    round adds links, so their number at first tells how many tasks rounds ask for.
    """
    edges = stored(
        links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .filter("a <> b").distinct(), "links"
    )
    before = _signature(edges)
    n = before[0]
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        # Large star: neighbours above a node go to its smallest.
        large = both.filter("b > a").join(low, "a").select(F.col("low").alias("a"), "b").filter("a <> b")
        large = stored(in_tasks(in_tasks(large, n).distinct(), n), "large-star")
        # Small star: neighbours below a node go to the smallest of them, and the node as well.
        low = large.groupBy("b").agg(F.min("a").alias("low"))
        small = large.join(low, "b").select(
            F.col("low").alias("x"), F.explode(F.array("a", "b")).alias("y")
        ).filter("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b"))
        edges = stored(in_tasks(in_tasks(small, n).distinct(), n), "small-star")
        after = _signature(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())

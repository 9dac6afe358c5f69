"""Connected components of a graph given by its links, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.frames import kept_table

MAX_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """(node, root) for each node with a link, root being the least node that links reach.

    ``links``: columns a and b; repeated links and loops do no harm. A round tells every node of the least node among its
    neighbours; the number of rounds grows with the logarithm of the longest chain. Neighbours are never gathered: a
    round takes minima, which combine before the shuffle, and joins links with them. Both sides of a join are tables in the
    shared folder, one row a node on one of them, so Spark can split the links of a hub over many tasks.
    """
    now = kept_table(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "star")
    before = None
    for _ in range(MAX_ROUNDS):
        state = tuple(now.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first())
        if state == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = kept_table(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "star-least")
        # large star: greater neighbours go to the least of all
        large = kept_table(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "star-large")
        # small star: smaller neighbours and the node itself go to the least of them
        small = kept_table(large.groupBy("u").agg(F.min("v").alias("m")), "star-small")
        moved = large.join(small, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = kept_table(moved.union(small.select("u", F.col("m").alias("v"))).distinct(), "star")
    raise RuntimeError(f"components are not found after {MAX_ROUNDS} rounds")

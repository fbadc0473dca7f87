"""Connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import materialise


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with an edge; ``root`` is the smallest node of its component.

    ``edges``: columns ``a`` and ``b``. Each round links the larger neighbours of a node, then the
    smaller ones, to the smallest of them; the number of rounds grows with the logarithm of the
    longest chain. A round is written to the shared folder, so a lost executor costs one round.
    """
    high, low = F.greatest("a", "b"), F.least("a", "b")
    now = edges.where("a != b").select(high.alias("u"), low.alias("v")).distinct()
    before = None
    while True:
        now = materialise(now, "stars")
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state[0] == 0 or state == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        before = state
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialise(large.distinct(), "stars")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = small.unionByName(least.select("u", F.col("m").alias("v"))).distinct()

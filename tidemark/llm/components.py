"""Connected components of a graph given by its links, in rounds of ordinary groupings and joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.session import settled


def _stars(links: DataFrame) -> DataFrame:
    """Every node to the least of its smaller neighbours, and that one to the others through it."""
    least = links.groupBy("node").agg(F.min("to").alias("least"))
    moved = links.join(least, "node").where("to > least").select(F.col("to").alias("node"), F.col("least").alias("to"))
    return moved.unionByName(least.select("node", F.col("least").alias("to")))


def _written(links: DataFrame) -> tuple[DataFrame, tuple[int, int | None]]:
    """Different links, stored, with their number and a digest of them that are found while they are written."""
    seen = Observation()
    digest = F.bit_xor(F.xxhash64("node", "to")).alias("digest")
    stored = settled(links.distinct().observe(seen, F.count("*").alias("n"), digest), "links")
    found = seen.get  # nothing is observed in a plan that Spark finds to be empty
    return stored, (found.get("n", 0), found.get("digest"))


def components(links: DataFrame) -> DataFrame:
    """node and component (the least node reachable) of every linked node, except those that are the least themselves.

    ``links`` has the long columns ``a`` and ``b``; direction, repeats and loops don't matter, and links with a null
    end are no links. Each round points all larger neighbours of a node to its least neighbour, then all smaller
    ones, until nothing changes; the number of rounds grows with the logarithm of the longest chain. Every round is
    written to the shared folder, which cuts the lineage.
    """
    now, state = _written(links.where("a <> b").select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("to")))
    before = None
    while state[0] and state != before:
        before = state
        both = now.unionByName(now.select(F.col("to").alias("node"), F.col("node").alias("to")))
        least = both.groupBy("node").agg(F.min("to").alias("least"))
        least = least.select("node", F.least("node", "least").alias("least"))
        larger = both.join(least, "node").where("to > node").select(F.col("to").alias("node"), F.col("least").alias("to"))
        now, state = _written(_stars(larger.distinct()))
    return now.select("node", F.col("to").alias("component"))

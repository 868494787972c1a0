"""Connected components by alternating large and small stars, on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from care_episodes.session import materialize


def _star(both: DataFrame, keep) -> DataFrame:
    """Hangs neighbours on the smallest node seen from `u`; `keep` picks which of them move."""
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u").where(keep).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in `links` (a, b); root is the smallest node of its component.

    Each half round writes its links as a table in the shared folder, so a lost executor costs a re-read.  Grouping takes
    minima only and combines on the map side; no neighbourhood is ever gathered.  Links to themselves are dropped.
    """
    links = materialize(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct())
    seen = None
    while True:
        # Large star: larger neighbours of u move to the smallest node around u.
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        links = materialize(_star(both, F.col("v") > F.col("u")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))
        # Small star: u and its smaller neighbours move to the smallest of them.
        least = links.groupBy("u").agg(F.min("v").alias("m"))
        moved = links.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        links = materialize(moved.union(least.select("u", F.col("m").alias("v"))).distinct())
        state = links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if tuple(state) == seen:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                links.select(F.col("v").alias("node"), F.col("v").alias("root"))
            ).distinct()
        seen = tuple(state)

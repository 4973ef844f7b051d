"""Connected components by alternating large and small stars.

Each round is two aggregations and two joins over the edge list; a hub's edges
are never gathered in one task (minima combine on the map side, joins let the
adaptive executor split a hot key). Rounds write to the shared folder, so the
lineage stays short and a lost executor costs one round at most. Only a checksum
of the edges comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixspark.llm.common import materialise, release

#: Edges of one file of a written round.
PART_EDGES = 200_000


def _checksum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges``: two long columns a, b. Returns (node, root): root is the smallest id reachable.

    Nulls and loops are left out; repeated edges count once; nodes without an
    edge do not appear; an empty edge list gives an empty table.
    """
    now = materialise(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    seen = _checksum(now)
    parts = seen[0] // PART_EDGES + 1  # stars never have more edges than the graph
    while seen[0]:
        both = now.select(F.col("u").alias("x"), F.col("v").alias("y")).union(now.select(F.col("v").alias("x"), F.col("u").alias("y")))
        least = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("m", "x").alias("m"))
        large = materialise(both.where("y > x").join(least, "x").where("y <> m").select(F.col("y").alias("u"), F.col("m").alias("v")).coalesce(parts), "large-star")
        below = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(below, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(below.select("u", F.col("m").alias("v")))
        after = materialise(small.distinct().coalesce(parts), "small-star")
        got = _checksum(after)
        release(now, large)
        now = after
        if got == seen:
            break
        seen = got
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))

"""Linked groups by smallest labels, and walks up a tree."""

from __future__ import annotations

import math
import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows that a task sorts or groups by key, about.
ROWS = 1_000_000


def shared_root(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; only in a local session that names none, one of our own."""
    if spark.sparkContext.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(folder or tempfile.mkdtemp(prefix="spark-checkpoint-"))
    return spark.sparkContext.getCheckpointDir()


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path for a table in the shared folder."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back, which cuts the lineage."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def parts_of(rows: int) -> int:
    """Parts of about ``ROWS`` rows each."""
    return math.ceil(rows / ROWS)


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df`` of some ``rows`` rows dealt out by ``keys``, about ``ROWS`` to a task; few rows are left as they are.

    Few are those for which the session's number of partitions will do. That number
    does not grow with the table, so without more of them what a task holds would.
    """
    n = parts_of(rows)
    return df.repartition(n, *keys) if n > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df


def shared_checkpoint(df: DataFrame) -> DataFrame:
    """``checkpoint()`` in the cluster's shared folder."""
    shared_root(df.sparkSession)
    return df.checkpoint()


def numbered(df: DataFrame, by: list[Column], name: str) -> DataFrame:
    """``df`` with a column ``name``: 1, 2, ... in the order of ``by``, without one task that sees all rows.

    Ranges of the order are numbered side by side; the counts of those before, one
    number a range, are added. ``by`` should order the rows totally.
    """
    ranged = written(df.repartitionByRange(*by).withColumn("_part", F.spark_partition_id()), "ranges")
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    before = sizes.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*by))
    return ranged.join(F.broadcast(before), "_part").withColumn(name, place + F.col("_before")).drop("_part", "_before")


def linked_groups(links: DataFrame) -> DataFrame:
    """``links``: columns a, b of one comparable type. Returns (node, group): the smallest node reachable.

    Each round every node takes the smallest label of itself and its neighbours, then
    the label of its label; rounds end when no label changes.
    """
    both = shared_checkpoint(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a IS NOT NULL AND b IS NOT NULL").distinct())
    labels = shared_checkpoint(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("g")).select(F.col("a").alias("node"), "g"))
    while True:
        near = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("g").alias("m")).select(F.col("a").alias("node"), "m")
        least = labels.join(near, "node").select("node", F.col("g").alias("before"), F.least("g", "m").alias("g"))
        jump = least.select(F.col("node").alias("g"), F.col("g").alias("far"))
        after = shared_checkpoint(least.join(jump, "g", "left").select("node", "before", F.coalesce(F.least("g", "far"), "g").alias("g")))
        labels = after.select("node", "g")
        if not after.where("before <> g").take(1):
            return labels.withColumnRenamed("g", "group")


def walked(ids: DataFrame, nodes: DataFrame, ranks: list[str]) -> DataFrame:
    """For each id of ``ids`` that is a node, what a walk to the root finds: (tax_id, tops, near).

    ``nodes``: tax_id, parent, rank; a root is its own parent and an id counts once. tops:
    rank to node, of several nodes of a rank the one nearest to the root, the root left
    out; near: the first node at or above with one of ``ranks``.

    By pointer doubling: a node knows what lies within 2^k steps and the node that many
    steps up, and takes on what that one knows, so the rounds grow with the logarithm of
    the depth. They run when this is called. A parent outside the tree and a loop are
    errors that name an id, if an id of ``ids`` leads there.
    """
    at_root = F.col("tax_id") == F.col("parent")
    ranked = F.col("rank").isin(ranks)
    none = F.create_map().cast("map<string, string>")
    own = F.when(ranked & ~at_root, F.create_map("rank", "tax_id")).otherwise(none)
    state = nodes.select("tax_id", "parent", "rank").dropDuplicates(["tax_id"]).select("tax_id", F.when(~at_root, F.col("parent")).alias("up"), own.alias("tops"), F.when(ranked, F.col("tax_id")).alias("near"), F.lit(None).cast("string").alias("lost"))
    state = written(state, "walk-0")
    wanted, steps, total = ids.select("tax_id").distinct(), 1, state.count()
    while True:
        above = state.select(F.col("tax_id").alias("up"), F.col("up").alias("up_2"), F.col("tops").alias("tops_2"), F.col("near").alias("near_2"), F.col("lost").alias("lost_2"), F.lit(True).alias("there"))
        met = state.where("up IS NOT NULL").join(above, "up", "left")
        higher = F.map_concat(F.map_filter("tops", lambda k, _: ~F.map_contains_key("tops_2", k)), "tops_2")
        lost = F.when(F.col("there").isNull(), F.col("up")).otherwise(F.col("lost_2"))
        moved = met.select("tax_id", F.col("up_2").alias("up"), F.when(F.col("there"), higher).otherwise(F.col("tops")).alias("tops"), F.coalesce("near", "near_2").alias("near"), lost.alias("lost"))
        state = written(state.where("up IS NULL").unionByName(moved), "walk")
        steps *= 2
        waiting = state.where("up IS NOT NULL")
        if steps > total or not waiting.take(1):
            break
    state = wanted.join(state, "tax_id")
    if (bad := state.where("up IS NOT NULL OR lost IS NOT NULL").select("tax_id", "lost").take(1)):
        raise ValueError(f"the walk up from {bad[0].tax_id} " + (f"leaves the tree at {bad[0].lost}" if bad[0].lost else "does not end: its ancestors form a loop"))
    return state.select("tax_id", "tops", "near")

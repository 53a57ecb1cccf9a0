"""Which entities are connected through matches, directly or over others."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelframe.session import dropped, stage


def connected(edges: DataFrame, name: str = "groups") -> DataFrame:
    """``(node, group)`` for every node of ``edges(a, b)``; ``group`` is the smallest node reachable. Nodes are not null.

    Every round gives each node the smallest group that it or a neighbour has, and then the group of that group, so
    that labels travel twice as far with every round; it ends when no label changes. Nodes are combined before each
    shuffle, and nothing but the number of changes reaches the driver.
    """
    both = edges.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e")).select("e.*").distinct()
    both = stage(both, f"{name}-edges")
    labels = stage(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("group")).withColumnRenamed("a", "node"), f"{name}-labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("group").alias("near"))
        # A group takes over what its members have seen, and a member its group's group.
        seen = labels.join(near, "node")
        least = seen.groupBy(F.col("group").alias("node")).agg(F.min("near").alias("from_members"))
        moved = seen.join(least, "node", "left").withColumn("next", F.least("group", "near", F.coalesce("from_members", "group")))
        moved = stage(moved.select("node", "group", "next"), f"{name}-moved")
        jump = moved.select(F.col("node").alias("next"), F.col("next").alias("further"))
        after = stage(moved.join(jump, "next").select("node", F.col("further").alias("group"), (F.col("further") != F.col("group")).alias("changed")), f"{name}-labels")
        done = after.where("changed").isEmpty()
        dropped(labels, moved)
        labels = after.drop("changed")
        labels.staged_path = after.staged_path
        if done:
            dropped(both)
            return labels

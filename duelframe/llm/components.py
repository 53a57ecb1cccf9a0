"""Connected components of a link table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelframe.llm.text import released, stored


def components(links: DataFrame, name: str = "links") -> DataFrame:
    """``(node, component)`` for every node of ``links(a, b)``; ``component`` is the smallest node reachable.

    Each round hangs the larger neighbours of every node under its smallest neighbour, then the smaller ones, until
    the table of links stays as it is. Only counts and a checksum reach the driver. Nodes are aggregated before
    the shuffle and joined back, so that a hub with very many links is split like any skewed join. Links with a
    null end and links of a node to itself are ignored; an empty table gives an empty table.
    """
    pairs = links.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    pairs = stored(pairs, name)
    before = _state(pairs)
    while True:
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("x")).select("x.*")
        after_pairs = stored(small.where("a <> b").distinct(), name)
        after = _state(after_pairs)
        released(pairs)
        pairs = after_pairs
        if after == before:
            break
        before = after
    roots = pairs.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def _state(pairs: DataFrame) -> tuple:
    row = pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)

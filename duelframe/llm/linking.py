"""Links between the members of shared buckets, without all pairs of a bucket."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duelframe.llm.components import components
from duelframe.llm.text import released, stored


def shared_buckets(keyed: DataFrame) -> DataFrame:
    """``(key, id, hub)`` for the buckets of ``keyed(key, id)`` with several ids.

    The hub is the id that meets the most others over all its buckets: the text that copies were made from shares
    more buckets with each copy than two copies do. Ties go to the first in hash order.
    """
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    return with_hubs(stored(keyed.join(sizes, "key"), "buckets"))


def with_hubs(members: DataFrame) -> DataFrame:
    """``(key, id, hub)`` for the stored rows ``members(key, id, n)``, which are released; ``n`` only ranks the ids."""
    met = members.groupBy("id").agg(F.sum(F.col("n") - 1).alias("met"))
    ranked = members.join(met, "id").select("key", F.struct("met", F.xxhash64("id").alias("h"), F.col("id").alias("hub")).alias("x"))
    hubs = ranked.groupBy("key").agg(F.max("x").alias("x")).select("key", "x.hub")
    out = stored(members.select("key", "id").join(hubs, "key"), "buckets")
    released(members)
    return out


def linked(members: DataFrame, likely: Callable[[DataFrame], DataFrame], confirmed: Callable[[DataFrame], DataFrame], marks: DataFrame, close: Callable[[Column, Column], Column]) -> DataFrame:
    """Confirmed links ``(a, b)`` between ids of ``members(key, id, hub)``, enough of them for the components.

    ``likely`` takes pairs ``(a, b)`` and keeps those worth confirming, with a ``similarity``; ``confirmed`` keeps
    those that hold. Every id is compared with the hub of each of its buckets, its likeliest hub first and the
    others only if that left them in different components. Then all pairs of a bucket that are still in different
    components and have not been tried are compared, so no link that could join two components is lost; ``close``
    of two ``marks(id, mark)`` tells inside that join which pairs ``likely`` could keep.
    """
    stars = members.where("id <> hub").select(F.col("id").alias("a"), F.col("hub").alias("b")).distinct()
    stars = stored(likely(stars), "likely")
    best = stars.groupBy("a").agg(F.max_by("b", F.struct("similarity", "b")).alias("b"))
    first = stored(confirmed(best), "links")
    groups = stored(components(first), "groups")

    def label(c: str) -> DataFrame:
        return groups.select(F.col("node").alias(c), F.col("component").alias(f"c_{c}"))

    others = stars.join(best, ["a", "b"], "left_anti").select("a", "b")
    others = others.join(label("a"), "a", "left").join(label("b"), "b", "left").where("coalesce(c_a, a) <> coalesce(c_b, b)")
    links = stored(first.unionByName(confirmed(others.select("a", "b"))), "links")
    released(first, groups)

    groups = stored(components(links), "groups")
    split = members.join(groups.withColumnRenamed("node", "id"), "id", "left").select("key", "id", F.coalesce("component", "id").alias("c"))
    mixed_keys = split.groupBy("key").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low <> high").select("key")
    split = stored(split.join(mixed_keys, "key").join(marks, "id"), "open")
    left, right = (split.select("key", F.col("id").alias(x), F.col("c").alias(f"c_{x}"), F.col("mark").alias(f"m_{x}")) for x in "ab")
    apart = (F.col("a") < F.col("b")) & (F.col("c_a") != F.col("c_b"))
    across = left.join(right, (left["key"] == right["key"]) & apart & close(F.col("m_a"), F.col("m_b"))).select("a", "b").distinct()
    tried = stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rest = confirmed(likely(across.join(tried, ["a", "b"], "left_anti")))
    out = stored(links.unionByName(rest), "links")
    released(links, groups, split, stars)
    return out

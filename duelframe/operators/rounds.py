"""Matchday derivation: rounds are cut greedily, a new one starts when an entity appears again.

For every match, the match where a round starting there would end is a suffix minimum; the real round starts are the
chain of these ends from the first match on. The chain is followed inside blocks of consecutive matches first: each
match where it can enter a block leads to where it leaves it. Between blocks only those entries are left to follow.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from duelframe.operators.ordering import dense_index
from duelframe.session import dropped, stage

#: Consecutive matches of a block: two dozen bytes each.
BLOCK = 1 << 20
_ORDER = ["match_datetime", "home_team", "away_team", "match_id"]
# Stands for a missing season in joins, which drop nulls.
_NO_SEASON = "\u0000"


def _ends(table: pa.Table) -> tuple[np.ndarray, np.ndarray, pa.Table]:
    """Places of a block in order, and for each the place where the next round starts; 0 where none does."""
    table = table.sort_by("i")
    i = table.column("i").to_numpy()
    far = np.iinfo(np.int64).max
    j, later = (pc.fill_null(table.column(c), pa.scalar(far, pa.int64())).to_numpy() for c in ("j", "later"))
    j = np.minimum(j, later)
    end = np.minimum.accumulate(j[::-1])[::-1]
    return i, np.where(end == far, 0, end), table


def _exits(table: pa.Table) -> pa.Table:
    """``(i, exit)``: from each entry of a block, the first place of its chain behind the block, 0 at its end."""
    i, end, table = _ends(table)
    # Doubling inside the block: hops stay put once they have left it.
    at = end.copy()
    while True:
        inside = (at > 0) & (at <= i[-1])
        if not inside.any():
            break
        at[inside] = at[at[inside] - i[0]]
    entry = table.column("entry").to_numpy(zero_copy_only=False).astype(bool)
    return pa.table({"i": i[entry], "exit": at[entry]})


def _numbered(table: pa.Table) -> pa.Table:
    """Matches of a block with the number of round starts in it up to each one."""
    i, end, table = _ends(table)
    starts = np.zeros(len(i), bool)
    for at in i[table.column("entry").to_numpy(zero_copy_only=False).astype(bool)].tolist():
        while 0 < at <= i[-1] and not starts[at - i[0]]:
            starts[at - i[0]] = True
            at = int(end[at - i[0]])
    return pa.table({"block": table.column("block"), "s": table.column("s"), "match_id": table.column("match_id").cast(pa.int64()), "i": i, "inside": np.cumsum(starts)})


def matchdays(matches: DataFrame, season: str = "season", block: int = BLOCK) -> DataFrame:
    """``match_id, matchday`` for every match; matches without a season form one of their own.

    All seasons are one sequence in which every season's first match starts a round, whatever came before.
    """
    named = matches.select(F.coalesce(F.col(season).cast("string"), F.lit(_NO_SEASON)).alias("s"), *_ORDER)
    indexed = stage(dense_index(named, ["s", *_ORDER], "i").select("s", "match_id", "i", "home_team", "away_team"), "rounds-index")
    seasons = stage(indexed.groupBy("s").agg(F.min("i").alias("i")), "rounds-seasons")
    # Latest earlier match of either side in the season, then the first match that has it as its latest.
    sides = indexed.select("s", "i", F.explode(F.array("home_team", "away_team")).alias("team"))
    before = sides.select("i", F.lag("i").over(Window.partitionBy("s", "team").orderBy("i")).alias("p")).where("p is not null")
    before = before.groupBy("i").agg(F.max("p").alias("p")).select(F.col("p").alias("i"), F.col("i").alias("j"))
    ends = before.unionByName(seasons.where("i > 1").select((F.col("i") - 1).alias("i"), F.col("i").alias("j"))).groupBy("i").agg(F.min("j").alias("j"))
    placed = indexed.select("s", "i", "match_id").join(ends, "i", "left").withColumn("block", F.floor((F.col("i") - 1) / block))
    placed = stage(placed, "rounds-placed")
    # One row a block from here to ``later``: the earliest end that a later block has.
    least = placed.groupBy("block").agg(F.min("j").alias("j"))
    later = least.select("block", F.min("j").over(Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)).alias("later"))
    placed = placed.join(later, "block")
    # The chain enters a block at places that matches of earlier blocks end at: ends behind the matches' own block, and
    # the first end of all later blocks, which a match without one in its block has.
    crossing = placed.where(F.floor((F.col("j") - 1) / block) > F.col("block")).select(F.col("j").alias("i"))
    crossing = crossing.unionByName(later.where("later is not null").select(F.col("later").alias("i")))
    entries = stage(crossing.unionByName(seasons.agg(F.min("i").alias("i")).where("i is not null")).distinct(), "rounds-entries")
    marked = placed.join(entries.withColumn("entry", F.lit(True)), "i", "left").withColumn("entry", F.coalesce("entry", F.lit(False)))
    jump = stage(marked.groupBy("block").applyInArrow(_exits, "i bigint, exit bigint").where("exit > 0"), "rounds-exits")
    reached = stage(seasons.agg(F.min("i").alias("i")).where("i is not null"), "rounds-reached")
    # One hop a block is left; after k steps ``reached`` holds the first 2^k entries and ``jump`` skips 2^k blocks.
    while True:
        found = stage(reached.join(jump, "i").select(F.col("exit").alias("i")), "rounds-found")
        if found.isEmpty():
            break
        reached = stage(reached.unionByName(found), "rounds-reached")
        far = jump.select(F.col("i").alias("exit"), F.col("exit").alias("far"))
        jump = stage(jump.join(far, "exit").select("i", F.col("far").alias("exit")), "rounds-exits")
    walked = placed.join(reached.withColumn("entry", F.lit(True)), "i", "left").withColumn("entry", F.coalesce("entry", F.lit(False)))
    counted = walked.groupBy("block").applyInArrow(_numbered, "block bigint, s string, match_id bigint, i bigint, inside bigint")
    counted = stage(counted, "rounds-counted")
    totals = counted.groupBy("block").agg(F.max("inside").alias("n"))
    earlier = totals.select("block", F.coalesce(F.sum("n").over(Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("earlier"))
    total = counted.join(earlier, "block").select("s", "i", "match_id", (F.col("inside") + F.col("earlier")).alias("total"))
    base = total.join(seasons, ["s", "i"]).select("s", F.col("total").alias("base"))
    out = total.join(base, "s").select("match_id", (F.col("total") - F.col("base") + 1).alias("matchday"))
    dropped(indexed, entries)
    return out

"""Global order without a single-partition window.

Rows are range-sorted into a reliable checkpoint; every partition then knows its rows, and only one total per
partition is needed to place it. A key that holds a third of all rows is split over partitions like any other,
because the sort key is the whole order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duelframe.session import reliable_checkpoint

_POSITION_BITS = 33


def _sorted_parts(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    placed = reliable_checkpoint(df.orderBy(*order)).withColumn("_place", F.monotonically_increasing_id())
    return placed.withColumn("_part", F.shiftright("_place", _POSITION_BITS))


def _with_offsets(placed: DataFrame, total: Column) -> DataFrame:
    # One row per partition of the checkpoint: the window below sees only those few rows.
    totals = placed.groupBy("_part").agg(total.alias("_total"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_part", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_before"))
    # Broadcast is safe: one row per partition, whatever the number of rows.
    return placed.join(F.broadcast(offsets), "_part")


def dense_index(df: DataFrame, order: Sequence[str | Column], name: str = "match_id") -> DataFrame:
    """Number rows 1..n in ``order``; give an order without ties for a repeatable result."""
    placed = _with_offsets(_sorted_parts(df, order), F.count("*"))
    position = F.col("_place").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    return placed.withColumn(name, F.col("_before") + position + 1).drop("_place", "_part", "_before")


def running_total(df: DataFrame, order: Sequence[str | Column], value: str, name: str) -> DataFrame:
    """Sum of ``value`` over all rows up to and including the current one, in ``order``."""
    placed = _with_offsets(_sorted_parts(df, order), F.sum(value))
    inside = Window.partitionBy("_part").orderBy("_place").rowsBetween(Window.unboundedPreceding, 0)
    return placed.withColumn(name, F.col("_before") + F.sum(value).over(inside)).drop("_place", "_part", "_before")


def grouped_quantiles(
    df: DataFrame, group: Sequence[str], value: str, probabilities: Sequence[float], weight: str | None = None
) -> DataFrame:
    """Exact linear-interpolation quantiles per group: columns ``q0``, ``q1``, … and ``n``.

    ``group`` must take values from a fixed short list. ``weight`` names a row count for inputs that are
    grouped already.

    Equal values are counted before the shuffle, so a value shared by most rows is one row from then on; order
    statistics come from a running total instead of a value map held in one task.
    """
    rows = F.sum(weight) if weight else F.count("*")
    counts = df.filter(F.col(value).isNotNull()).groupBy(*group, value).agg(rows.alias("_cnt"))
    cum = running_total(counts, [*group, value], "_cnt", "_cum")
    base = cum.groupBy(*group).agg(
        F.min(F.col("_cum") - F.col("_cnt")).alias("_base"), F.sum("_cnt").alias("n")
    )
    # ``group`` names a fixed set (classes, feature names), so there are only that many rows to broadcast.
    ranked = cum.join(F.broadcast(base), list(group)).withColumn("_upto", F.col("_cum") - F.col("_base"))
    picks = []
    for i, q in enumerate(probabilities):
        low = F.floor((F.col("n") - 1) * F.lit(float(q)))
        picks.append(F.min(F.when(F.col("_upto") > low, F.col(value))).alias(f"_lo{i}"))
        picks.append(F.min(F.when(F.col("_upto") > F.least(low + 1, F.col("n") - 1), F.col(value))).alias(f"_hi{i}"))
    found = ranked.groupBy(*group, "n").agg(*picks)
    out = []
    for i, q in enumerate(probabilities):
        place = (F.col("n") - 1) * F.lit(float(q))
        share = place - F.floor(place)
        out.append((F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * share).alias(f"q{i}"))
    return found.select(*group, "n", *out)

"""Rolling form and rest over entity-perspective rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duelframe.operators import blocks
from duelframe.operators.ordering import dense_index
from duelframe.schema import MATCH_ORDER, PRIORS

FORM_STATS = {
    "points_5": ("points", 5),
    "points_10": ("points", 10),
    "goal_diff_5": ("goal_diff", 5),
    "goal_diff_10": ("goal_diff", 10),
    "goals_for_5": ("goals_for", 5),
    "goals_against_5": ("goals_against", 5),
}


def _history(keys: Sequence[str]):
    return Window.partitionBy(*keys).orderBy(*MATCH_ORDER)


def with_form(long: DataFrame, stats: Mapping[str, tuple[str, int]] = FORM_STATS, priors: Mapping[str, float] = PRIORS, spread: bool = False) -> DataFrame:
    """Mean of the last N matches at any venue, current match excluded, prior when there is none.

    The window partition is one entity. After the past-only guard an entity has at most one row per calendar
    date, so a partition is bounded by the calendar, however large the table is. ``spread``, here and below, is for
    tables without the guard: the same frames over blocks of rows.
    """
    if spread:
        def mean(field: str, n: int):
            return lambda w: F.coalesce(F.avg(field).over(w.rowsBetween(-n, -1)), F.lit(float(priors[field])))

        return blocks.framed(long, ["team"], MATCH_ORDER, max(n for _, n in stats.values()), {name: mean(*s) for name, s in stats.items()})
    w = _history(["team"])
    return long.withColumns(
        {
            name: F.coalesce(F.avg(field).over(w.rowsBetween(-n, -1)), F.lit(float(priors[field])))
            for name, (field, n) in stats.items()
        }
    )


def with_venue_form(long: DataFrame, n: int = 5, prior: float = PRIORS["points"], spread: bool = False) -> DataFrame:
    """Mean points of the last ``n`` matches at the same venue."""
    if spread:
        mean = lambda w: F.coalesce(F.avg("points").over(w.rowsBetween(-n, -1)), F.lit(float(prior)))
        return blocks.framed(long, ["team", "is_home"], MATCH_ORDER, n, {"venue_points": mean})
    w = _history(["team", "is_home"]).rowsBetween(-n, -1)
    return long.withColumn("venue_points", F.coalesce(F.avg("points").over(w), F.lit(float(prior))))


def with_rest_days(long: DataFrame, prior: float = PRIORS["rest_days"], spread: bool = False) -> DataFrame:
    if spread:
        days = lambda w: F.datediff("match_date", F.lag("match_date").over(w)).cast("double")
        return blocks.framed(long, ["team"], MATCH_ORDER, 1, {"rest_days": lambda w: F.coalesce(days(w), F.lit(float(prior)))})
    gap = F.datediff("match_date", F.lag("match_date").over(_history(["team"])))
    return long.withColumn("rest_days", F.coalesce(gap.cast("double"), F.lit(float(prior))))


def with_recent_entries(long: DataFrame, n: int = 40, name: str = "recent", keys: Sequence[str] = ("team",)) -> DataFrame:
    """The last ``n`` matches before the current one, oldest first, as an array of structs."""
    entry = F.struct("match_date", "points", "goals_for", "goals_against", "goal_diff", "is_home", "opponent")
    return long.withColumn(name, F.collect_list(entry).over(_history(keys).rowsBetween(-n, -1)))


def rolling_mean_before(
    df: DataFrame,
    keys: Sequence[str],
    day: str,
    order: Sequence[str],
    value: Column,
    n: int,
    name: str,
    default: float,
    one_per_day: bool | None = None,
    block: int = 1 << 16,
) -> DataFrame:
    """Mean of ``value`` over the ``n`` rows before the current one, for data with or without the guard.

    With one row per key and day (checked unless the caller knows) the plain row frame is bounded by the
    calendar. Otherwise rows are numbered in (key, day, order) and framed inside blocks of consecutive numbers;
    the last ``n`` rows of a block are handed to the next one as well. A block knows nothing of keys, so a key or
    a day that holds a large share of all rows is split like any other. Both ways give the same result.
    """
    keys, order = list(keys), list(order)
    if one_per_day is None:
        one_per_day = df.groupBy(*keys, day).agg(F.count("*").alias("_c")).filter("_c > 1").isEmpty()
    if one_per_day:
        w = Window.partitionBy(*keys).orderBy(day, *order).rowsBetween(-n, -1)
        return df.withColumn(name, F.coalesce(F.avg(value).over(w), F.lit(float(default))))

    size = max(block, n)
    numbered = dense_index(df.withColumns({"_v": value.cast("double"), "_k": F.struct(*keys)}), [*keys, day, *order], "_i")
    own = F.floor((F.col("_i") - 1) / size)
    places = F.array(F.struct(own.alias("b"), F.lit(False).alias("copy")))
    handed = F.array_append(places, F.struct((own + 1).alias("b"), F.lit(True).alias("copy")))
    last_of_block = F.col("_i") > (own + 1) * size - n
    spread = numbered.withColumn("_p", F.explode(F.when(last_of_block, handed).otherwise(places)))
    frame = Window.partitionBy("_p.b").orderBy("_i").rowsBetween(-n, -1)
    before = F.filter(F.collect_list(F.struct("_k", "_v")).over(frame), lambda e: e["_k"].eqNullSafe(F.col("_k")) & e["_v"].isNotNull())
    framed = spread.withColumn("_before", before).filter(~F.col("_p.copy"))
    total = F.aggregate("_before", F.lit(0.0), lambda acc, e: acc + e["_v"])
    mean = F.when(F.size("_before") > 0, total / F.size("_before")).otherwise(F.lit(float(default)))
    return framed.withColumn(name, mean).drop("_v", "_k", "_i", "_p", "_before")


def venue_form(matches: DataFrame, n: int = 5, default: float = 1.0, one_per_day: bool | None = None) -> DataFrame:
    """Mean points of each side over its previous ``n`` rows at this venue."""
    home_points = F.when(F.col("ftr") == "H", 3).when(F.col("ftr") == "D", 1).otherwise(0)
    away_points = F.when(F.col("ftr") == "A", 3).when(F.col("ftr") == "D", 1).otherwise(0)
    out = rolling_mean_before(
        matches, ["home_team"], "match_date", ["match_id"], home_points, n, "home_form_pts", default, one_per_day
    )
    return rolling_mean_before(
        out, ["away_team"], "match_date", ["match_id"], away_points, n, "away_form_pts", default, one_per_day
    )


def calendar_form(
    df: DataFrame, day: str, specs: Sequence[tuple[str, str, str]], days: int, default: float = 0.0, exact: int | None = None
) -> DataFrame:
    """Mean of a value over the trailing ``days`` calendar days, today excluded, for each (key, value, name).

    Rows are first summed per (key, day), before the shuffle; the range frame then runs over days, not rows. A row
    without a key is framed with the others that lack it, a row without a day gets the default. ``exact`` names the
    decimal digits of the values: their sums are then decimals, the same whatever the order of rows.
    """
    out = df.withColumn("_day", F.col(day))
    for key, value, name in specs:
        summed = F.col(value) if exact is None else F.col(value).cast(f"decimal(28,{exact})")
        daily = df.groupBy(F.col(key).alias("_k"), F.col(day).alias("_d")).agg(F.sum(summed).alias("_s"), F.count(value).alias("_c"))
        w = Window.partitionBy("_k").orderBy(F.unix_date("_d").cast("long")).rangeBetween(-days, -1)
        mean = F.sum("_s").over(w).cast("double") / F.sum("_c").over(w)
        found = daily.select("_k", "_d", F.when(F.col("_d").isNotNull(), mean).alias("_m"))
        same = out[key].eqNullSafe(found["_k"]) & out["_day"].eqNullSafe(found["_d"])
        out = out.join(found, same, "left").withColumn(name, F.coalesce("_m", F.lit(float(default)))).drop("_k", "_d", "_m")
    return out.drop("_day")

"""Chronological splits and the expanding-window backtest."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duelframe.functions.scalars import season_start_year
from duelframe.schema import CLASSES


def season_split(season: str, lists: Mapping[str, Sequence[str]]) -> Column:
    """Split name of each row from named season lists; NULL when a season is in none."""
    out = F.lit(None).cast("string")
    for name, seasons in reversed(list(lists.items())):
        out = F.when(F.col(season).isin(*seasons), name).otherwise(out)
    return out


def split_counts(df: DataFrame, split: str = "split") -> DataFrame:
    return df.filter(F.col(split).isNotNull()).groupBy(split).agg(F.count("*").alias("n_rows"))


def require_splits(df: DataFrame, names: Sequence[str], split: str = "split") -> dict[str, int]:
    """Row counts by split in one job; an empty split is an error."""
    found = {r[split]: r["n_rows"] for r in split_counts(df, split).filter(F.col(split).isin(*names)).collect()}
    empty = [n for n in names if not found.get(n)]
    if empty:
        raise ValueError(f"empty splits, check the season lists: {empty}")
    return found


def year_split(year: Column | str, last_train: int, validation: int) -> Column:
    year = F.col(year) if isinstance(year, str) else year
    return F.when(year <= last_train, "train").when(year == validation, "validation").when(year > validation, "test")


def fraction_split(df: DataFrame, day: str, train: float = 0.5, validation: float = 0.1) -> DataFrame:
    """Split by share of rows, cut at date boundaries.

    A split ends with the first date at which the cumulative share of rows reaches its limit. Rows are counted
    per date first; the running sum sees one row per calendar date, and each date then carries its split. Rows
    without a date come first.
    """
    daily = df.groupBy(day).agg(F.count("*").alias("_c"))
    before = F.sum("_c").over(Window.orderBy(day).rowsBetween(Window.unboundedPreceding, -1))
    total = F.sum("_c").over(Window.orderBy(day).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    share = F.coalesce(before, F.lit(0)) / total
    name = F.when(share < train, "train").when(share < train + validation, "validation").otherwise("test")
    named = daily.select(F.col(day).alias("_day"), name.alias("split"))
    return df.join(named, df[day].eqNullSafe(named["_day"]), "left").drop("_day")


def dates_and_bounds(df: DataFrame, day: str = "match_date", count: str = "n_matches") -> DataFrame:
    """Every date in order with its rows, and whether it is the first or the last one: what cuts are made at.

    Rows are counted per date before the shuffle, so the window behind sees one row per calendar date. Rows without a
    date are a row of their own, with NULL for both.
    """
    daily = df.groupBy(day).agg(F.count("*").alias(count))
    every = Window.partitionBy(F.lit(1))
    is_first, is_last = F.col(day) == F.min(day).over(every), F.col(day) == F.max(day).over(every)
    return daily.select(day, count, is_first.alias("is_first"), is_last.alias("is_last")).orderBy(day)


def folds(seasons: DataFrame, season: str = "season") -> DataFrame:
    """One row per fold: train on all seasons up to ``train_up_to``, test on the next one."""
    distinct = seasons.select(season).distinct()
    start = season_start_year(season)
    w = Window.orderBy(start)
    return distinct.select(
        F.col(season).alias("train_up_to"), F.lead(season).over(w).alias("test_season"), F.row_number().over(w).alias("fold")
    ).filter("test_season is not null")


def frequency_backtest(df: DataFrame, season: str = "season", label: str = "ftr", eps: float = 2.220446049250313e-16) -> DataFrame:
    """Expanding-window backtest of the class-frequency model.

    Rows are reduced to (season, class) counts first: the training frequencies of a fold are running sums over
    earlier seasons, and every metric of a constant model follows from the test season's counts.
    """
    n = [f"n_{c}" for c in CLASSES]
    counts = df.groupBy(season).agg(*[F.count_if(F.col(label) == c).alias(f"n_{c}") for c in CLASSES])
    w = Window.orderBy(season_start_year(season))
    earlier = w.rowsBetween(Window.unboundedPreceding, -1)
    total = F.col("n_H") + F.col("n_D") + F.col("n_A")
    hist = counts.withColumns(
        {f"t_{c}": F.sum(f"n_{c}").over(earlier) for c in CLASSES} | {"train_up_to": F.lag(season).over(w), "n": total}
    ).filter("train_up_to is not null")
    train = F.col("t_H") + F.col("t_D") + F.col("t_A")
    hist = hist.withColumns({f"p_{c}": F.col(f"t_{c}") / train for c in CLASSES})
    clip = [F.greatest(F.least(F.col(f"p_{c}"), F.lit(1 - eps)), F.lit(eps)) for c in CLASSES]
    loss = sum((-F.log(p) * F.col(c) for p, c in zip(clip, n)), F.lit(0.0)) / F.col("n")
    square = sum((F.col(f"p_{c}") * F.col(f"p_{c}") for c in CLASSES), F.lit(0.0))
    brier = sum(((square - 2 * F.col(f"p_{c}") + 1) * F.col(f"n_{c}") for c in CLASSES), F.lit(0.0)) / F.col("n")
    p = [F.col(f"p_{c}") for c in CLASSES]
    hit = F.when((p[0] >= p[1]) & (p[0] >= p[2]), F.col("n_H")).when(p[1] >= p[2], F.col("n_D")).otherwise(F.col("n_A"))
    return hist.select(
        "train_up_to",
        F.col(season).alias("test_season"),
        F.col("n").alias("n_rows"),
        loss.alias("log_loss"),
        (hit / F.col("n")).alias("accuracy"),
        brier.alias("brier"),
    )

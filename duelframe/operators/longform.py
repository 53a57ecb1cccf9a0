"""Match rows to entity-perspective rows and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duelframe.functions import scalars as S


def entity_rows(matches: DataFrame, extra: Sequence[str] = (), strict: bool = False) -> DataFrame:
    """Two rows per match, one per side, in one pass over the input (no union of two scans)."""

    def side(team: str, opponent: str, goals_for: str, goals_against: str, is_home: bool) -> Column:
        home = F.lit(is_home)
        gf, ga = F.col(goals_for).cast("double"), F.col(goals_against).cast("double")
        return F.struct(
            F.col(team).alias("team"),
            F.col(opponent).alias("opponent"),
            home.alias("is_home"),
            S.points("ftr", home, strict).cast("double").alias("points"),
            gf.alias("goals_for"),
            ga.alias("goals_against"),
            (gf - ga).alias("goal_diff"),
        )

    sides = F.array(
        side("home_team", "away_team", "home_goals", "away_goals", True),
        side("away_team", "home_team", "away_goals", "home_goals", False),
    )
    return matches.select(
        "match_id", "match_date", "match_datetime", "home_team", "away_team", *extra, F.explode(sides).alias("e")
    ).select("match_id", "match_date", "match_datetime", "home_team", "away_team", *extra, "e.*")


def match_rows(long: DataFrame, numeric: Sequence[str]) -> DataFrame:
    """Back to one row per match: ``home_<name>`` and ``away_<name>`` for every numeric column.

    One shuffle on the match key and no self-join; numbers only, so the aggregate stays a hash aggregate.
    """
    home = F.col("is_home")
    aggs = [
        F.max(F.when(home if side == "home" else ~home, F.col(n))).alias(f"{side}_{n}")
        for side in ("home", "away")
        for n in numeric
    ]
    return long.groupBy("match_id").agg(*aggs)


def entity_dates(matches: DataFrame, *keep: str) -> DataFrame:
    """(entity, date) pairs, two per match."""
    return matches.select(*keep, "match_date", F.explode(F.array("home_team", "away_team")).alias("team"))

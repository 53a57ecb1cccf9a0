"""Checks that keep features free of leakage, as violation tables or as errors."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelframe.operators.longform import entity_dates


def repeated_days(matches: DataFrame) -> DataFrame:
    """Entities with more than one match on a date, the only way a history date can reach the current one.

    Counts are combined before the shuffle, so a hot entity or date is never gathered.
    """
    return (
        entity_dates(matches)
        .groupBy("team", "match_date")
        .agg(F.count("*").alias("n_matches"))
        .filter("n_matches > 1")
    )


def assert_past_only(matches: DataFrame) -> None:
    bad = repeated_days(matches).limit(5).collect()
    if bad:
        raise ValueError(f"several matches of one entity on one date, e.g. {bad[0].asDict()}")


def assert_labels(matches: DataFrame, result: str = "ftr") -> None:
    """Raise on a row whose result is missing or none of H, D, A: nothing else can be learned from or rated."""
    bad = matches.filter(~F.coalesce(F.col(result).isin("H", "D", "A"), F.lit(False))).limit(5).collect()
    if bad:
        raise ValueError(f"results must be H, D or A, e.g. {bad[0].asDict()}")


def competitions_per_entity(matches: DataFrame, competition: str) -> DataFrame:
    """Entities that appear in more than one competition."""
    return (
        entity_dates(matches, competition)
        .groupBy("team")
        .agg(F.min(competition).alias("first_competition"), F.max(competition).alias("last_competition"))
        .filter("first_competition <> last_competition")
    )


def contradicting_results(matches: DataFrame) -> DataFrame:
    """Rows whose stored result is not the one their score implies."""
    from duelframe.functions.scalars import result_from_score

    return matches.filter(F.col("ftr") != result_from_score("home_goals", "away_goals"))


def probability_violations(df: DataFrame, columns=("p_home", "p_draw", "p_away"), tolerance: float = 1e-6) -> DataFrame:
    """One row: how many probability triples leave [0, 1] or do not add to one."""
    cols = [F.col(c) for c in columns]
    outside = reduce(lambda a, b: a | b, [c.isNull() | (c < 0) | (c > 1) for c in cols])
    total = reduce(lambda a, b: a + b, cols)
    return df.agg(
        F.count("*").alias("n_rows"),
        F.count_if(outside).alias("n_outside"),
        F.count_if(~(F.abs(total - 1.0) <= tolerance)).alias("n_bad_sum"),
    )

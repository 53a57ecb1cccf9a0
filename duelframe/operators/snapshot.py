"""The serving snapshot as a state that new matches are folded into, without a replay of history.

An entity's state is its rating, its last date, and the last entries its means are made of: ten matches at any venue
and five at each. Entries of two stretches of time merge by keeping the last of both, so a day's matches cost a day's
work, and an update gives what a rebuild over all matches gives.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duelframe.operators import elo, longform
from duelframe.operators.form import FORM_STATS
from duelframe.schema import ELO, MATCH_ORDER, PRIORS

#: Entries kept of an entity: at any venue, and at home and away.
RECENT, AT_VENUE = 10, 5


def _last(c: Column, n: int) -> Column:
    return F.when(F.size(c) > n, F.slice(c, -n, n)).otherwise(c)


def stretch(matches: DataFrame, snapshot: DataFrame | None = None, competition: str | None = None, rating: dict = ELO) -> DataFrame:
    """State of the entities of ``matches`` by these alone, but for ratings, which go on from those of ``snapshot``.

    Only the last entries of an entity are gathered, picked by rank before they become a list.
    """
    initial = snapshot.select("team", "elo") if snapshot is not None else None
    rated = elo.with_rating_change(matches.join(elo.elo_ratings(matches, competition, rating, initial=initial), "match_id"), rating)
    long = longform.entity_rows(rated, extra=["elo_home_after", "elo_away_after"])
    back = [F.desc(c) for c in MATCH_ORDER]
    ranked = long.withColumns(
        {
            "_n": F.row_number().over(Window.partitionBy("team").orderBy(*back)),
            "_v": F.row_number().over(Window.partitionBy("team", "is_home").orderBy(*back)),
        }
    ).filter((F.col("_n") <= RECENT) | (F.col("_v") <= AT_VENUE))
    order = F.struct(*MATCH_ORDER).alias("at")

    def entries(condition: Column, kept: Column) -> Column:
        listed = F.sort_array(F.collect_list(F.when(condition, F.struct(order, kept.alias("e")))))
        return F.transform(listed, lambda x: x["e"])

    whole = F.struct("points", "goals_for", "goals_against", "goal_diff")
    after = F.when(F.col("is_home"), F.col("elo_home_after")).otherwise(F.col("elo_away_after"))
    venue = F.col("_v") <= AT_VENUE
    return ranked.groupBy("team").agg(
        F.max_by(after, F.struct(*MATCH_ORDER)).alias("elo"),
        F.max_by("match_date", F.struct(*MATCH_ORDER)).alias("last_date"),
        entries(F.col("_n") <= RECENT, whole).alias("recent"),
        entries(venue & F.col("is_home"), F.col("points")).alias("at_home"),
        entries(venue & ~F.col("is_home"), F.col("points")).alias("away"),
    )


def updated(snapshot: DataFrame, matches: DataFrame, competition: str | None = None, rating: dict = ELO) -> DataFrame:
    """``snapshot`` with later ``matches`` folded in; entities without a new match stay as they are.

    Every match must come after the last one of both its sides, as an increment does.
    """
    new = stretch(matches, snapshot, competition, rating)
    old = snapshot.withColumnsRenamed({c: f"_{c}" for c in snapshot.columns})
    joined = new.join(old, new["team"].eqNullSafe(old["_team"]), "full")

    def merged(c: str, n: int) -> Column:
        empty = F.array().cast(dict(snapshot.dtypes)[c])
        return _last(F.concat(F.coalesce(f"_{c}", empty), F.coalesce(c, empty)), n).alias(c)

    return joined.select(
        F.coalesce("team", "_team").alias("team"),
        F.coalesce("elo", "_elo").alias("elo"),
        F.coalesce("last_date", "_last_date").alias("last_date"),
        merged("recent", RECENT),
        merged("at_home", AT_VENUE),
        merged("away", AT_VENUE),
    )


def states(snapshot: DataFrame, priors: dict = PRIORS) -> DataFrame:
    """The columns of ``asof.current_states`` from a snapshot."""
    def mean(values: Column) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda s, v: s + v) / F.size(values)

    def last_of(field: str, n: int) -> Column:
        return F.transform(_last(F.col("recent"), n), lambda e: e[field])

    form = {name: mean(last_of(field, n)) for name, (field, n) in FORM_STATS.items()}
    venue = {name: F.when(F.size(c) > 0, mean(F.col(c))).otherwise(F.lit(float(priors["points"]))) for name, c in (("home_points_5", "at_home"), ("away_points_5", "away"))}
    return snapshot.select("team", "elo", "last_date", *(c.alias(n) for n, c in (form | venue).items()))

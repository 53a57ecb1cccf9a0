"""Elo ratings: an ordered fold through opponents.

One way at every size. Entities that meet nobody outside a group, directly or over others, form groups that need
nothing from each other; each is one ordered fold over its matches, in a task of its own. A group of more matches than
a task should hold is cut in time: its first stretch of matches is grouped anew, among fewer matches into smaller
groups, then the next stretch begins with the ratings the one before has left. So a hot entity, whose matches only its
own order can settle, costs its number of matches in one stretch a task, and a large open population falls apart into
very many groups a stretch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duelframe.functions import scalars as S
from duelframe.operators.groups import connected
from duelframe.operators.ordering import dense_index
from duelframe.schema import ELO
from duelframe.session import dropped, stage

#: Matches of one group that a task folds, some 60 bytes each.
TASK_ROWS = 500_000
#: Matches that are Python objects at once while a group is folded.
WALKED = 1 << 14
_ORDER = ["match_datetime", "home_team", "away_team", "match_id"]
_OUT = "match_id bigint, elo_home double, elo_away double, team string, elo double"


def _key(team: str) -> Column:
    """Entities as text; a missing one is an entity of its own."""
    return F.coalesce(F.concat(F.lit("="), F.col(team).cast("string")), F.lit(""))


def _fold(k: float, advantage: float, start: float):
    """Ratings before each match of a group in order, then a row for each entity with its rating after the last.

    Entities are numbers and matches are walked ``WALKED`` at a time, so that a match never stands as Python objects for
    longer than its portion.
    """

    def run(matches: pa.Table, state: pa.Table | None = None) -> pa.Table:
        order = [(c, "ascending") for c in _ORDER]
        at = pc.sort_indices(matches.select(_ORDER), sort_keys=order, null_placement="at_start")
        matches = matches.select(["match_id", "home", "away", "actual"]).take(at)
        known = [] if state is None else state.column("team").chunks
        names = pa.chunked_array([*matches.column("home").chunks, *matches.column("away").chunks, *known], pa.string())
        names = names.combine_chunks().dictionary_encode()
        n, m = matches.num_rows, len(names.dictionary)
        places = names.indices.to_numpy(zero_copy_only=False)
        homes, aways = places[:n], places[n : 2 * n]
        rating = [start] * m
        for team, elo in zip(places[2 * n :].tolist(), [] if state is None else state.column("elo").to_pylist()):
            rating[team] = elo
        before = np.empty((2, n))
        for i in range(0, n, WALKED):
            found = []
            for h, a, s in zip(homes[i : i + WALKED].tolist(), aways[i : i + WALKED].tolist(), matches.column("actual").slice(i, WALKED).to_pylist()):
                own, other = rating[h], rating[a]
                found.append((own, other))
                gain = 0.0 if s is None else k * (s - 1.0 / (1.0 + 10.0 ** ((other - own - advantage) / 400.0)))
                rating[h] += gain
                rating[a] -= gain
            before[:, i : i + WALKED] = np.array(found).T
        return pa.table(
            {
                "match_id": pa.concat_arrays([matches.column("match_id").combine_chunks().cast(pa.int64()), pa.nulls(m, pa.int64())]),
                "elo_home": pa.concat_arrays([pa.array(before[0]), pa.nulls(m, pa.float64())]),
                "elo_away": pa.concat_arrays([pa.array(before[1]), pa.nulls(m, pa.float64())]),
                "team": pa.concat_arrays([pa.nulls(n, pa.string()), names.dictionary]),
                "elo": pa.concat_arrays([pa.nulls(n, pa.float64()), pa.array(rating, pa.float64())]),
            }
        )

    return run


def _by_opponents(table: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Matches with the group of their entities, and tables to drop once the result has been used."""
    groups = connected(table.select(F.col("home").alias("a"), F.col("away").alias("b")).distinct(), "elo-groups")
    placed = stage(table.join(groups.withColumnRenamed("node", "home"), "home"), "elo-placed")
    return placed, [groups, placed]


def _by_pools(table: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """The same from competitions: those that share an entity are one group, so only they are connected."""
    plays = table.select(F.explode(F.array("home", "away")).alias("team"), "pool").distinct()
    several = plays.groupBy("team").agg(F.min("pool").alias("a"), F.max("pool").alias("b")).where("a < b").select("team", "a")
    edges = stage(plays.join(several, "team").select("a", F.col("pool").alias("b")).distinct(), "elo-pools")
    if edges.isEmpty():
        return table.withColumn("group", F.col("pool")), [edges]
    groups = connected(edges, "elo-groups")
    placed = table.join(groups.withColumnRenamed("node", "pool"), "pool", "left").withColumn("group", F.coalesce("group", "pool"))
    return placed, [edges, groups]


def _stretches(first: int, last: int, rows: int, task_rows: int) -> Iterator[tuple[int, int]]:
    """Places first..last cut into stretches that would hold half a task's matches each if they were spread evenly."""
    parts = min(last - first + 1, max(2, -(-2 * rows // task_rows)))
    step = -(-(last - first + 1) // parts)
    for at in range(first, last + 1, step):
        yield at, min(at + step - 1, last)


def elo_ratings(matches: DataFrame, competition: str | None = None, params: dict = ELO, task_rows: int = TASK_ROWS, initial: DataFrame | None = None) -> DataFrame:
    """``match_id, elo_home, elo_away``: ratings before each match, of one rating per entity over all its matches.

    Order is time, then names, then id; matches without a time come first. A match without a result changes nothing, and
    a missing entity is one like any other. ``competition`` only says whose entities to take as one group at first,
    which is cheaper than looking at every pair of opponents and right whether or not entities play in several.
    ``initial`` has the ratings ``(team, elo)`` that entities begin with, instead of the common one.
    """
    fold = _fold(float(params["k_factor"]), float(params["home_advantage"]), float(params["initial_rating"]))
    extra = [F.coalesce(F.concat(F.lit("#"), F.col(competition).cast("string")), F.lit("#")).alias("pool")] if competition else []
    actual = F.when(F.col("ftr").isNotNull(), S.actual_home_score("ftr")).alias("actual")
    rows = matches.select(*_ORDER, _key("home_team").alias("home"), _key("away_team").alias("away"), actual, *extra)
    if not hasattr(matches, "staged_path"):
        rows = stage(rows, "elo-matches")
    state = None if initial is None else initial.select(_key("team").alias("team"), "elo")
    done: DataFrame | None = None
    # Matches still to be rated, earliest last, with the places they cover once they are numbered.
    waiting: list[tuple[DataFrame, tuple[int, int] | None]] = [(rows, None)]
    while waiting:
        table, span = waiting.pop()
        placed, used = (_by_pools if competition and span is None else _by_opponents)(table)
        sizes = stage(placed.groupBy("group").agg(F.count("*").alias("n")).where(F.col("n") > task_rows), "elo-large")
        large = sizes.agg(F.sum("n")).first()[0]
        small = placed if large is None else placed.join(sizes, "group", "left_anti")
        small = small.select("group", *_ORDER, "home", "away", "actual")
        if state is None:
            found = small.groupBy("group").applyInArrow(lambda matches: fold(matches), _OUT)
        else:
            teams = small.select(F.col("group").alias("of"), F.explode(F.array("home", "away")).alias("team")).distinct()
            begun = teams.join(state, "team").select("of", "team", "elo")
            found = small.groupBy("group").cogroup(begun.groupBy("of")).applyInArrow(fold, _OUT)
        found = stage(found, "elo-ratings")
        rated = found.where("team is null").select("match_id", "elo_home", "elo_away")
        done = rated if done is None else done.unionByName(rated)
        if large is not None or waiting:
            latest = found.where("team is not null").select("team", "elo")
            before = None if state is None else state.join(latest.select("team"), "team", "left_anti")
            state = stage(latest if before is None else latest.unionByName(before), "elo-state")
        if large is not None:
            rest = placed.join(sizes.select("group"), "group").drop("group")
            if span is None:
                rest, span = dense_index(rest, _ORDER, "i"), (1, large)
            rest = stage(rest, "elo-rest")
            for a, b in reversed(list(_stretches(*span, large, task_rows))):
                waiting.append((rest.where(F.col("i").between(a, b)), (a, b)))
        dropped(sizes, *used)
    return done


def with_rating_change(rated: DataFrame, params: dict = ELO) -> DataFrame:
    """Add ``elo_home_after`` and ``elo_away_after``; the change is zero-sum."""
    change = F.lit(float(params["k_factor"])) * (
        S.actual_home_score("ftr") - S.elo_expected("elo_home", "elo_away", params["home_advantage"])
    )
    return rated.withColumns(
        {"elo_home_after": F.col("elo_home") + change, "elo_away_after": F.col("elo_away") - change}
    )

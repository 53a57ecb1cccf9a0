"""Block-wise windows against plain ones, with a key in a third of all rows, and snapshots against rebuilds."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from duelframe.operators import asof, blocks, elo, snapshot
from duelframe.plans.features import build_features
from duelframe.plans.fixtures import build_fixture_features
from duelframe.session import stage


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(7)
    data = [(i, rng.choice(["hot", f"k{rng.randint(0, 9)}", None]), rng.randint(0, 5), rng.choice([None, rng.randint(0, 9)])) for i in range(300)]
    return stage(spark.createDataFrame(data, "id int, k string, day int, v int"), "test-rows")


@pytest.mark.parametrize("block", [5, 64, 1 << 16])
def test_blocks_equal_plain_windows(rows, block):
    w = Window.partitionBy("k").orderBy("day", "id")
    plain = rows.withColumn("s", F.sum("v").over(w.rowsBetween(-3, -1))).withColumn("g", F.lag("id").over(w))
    columns = {"s": lambda w: F.sum("v").over(w.rowsBetween(-3, -1)), "g": lambda w: F.lag("id").over(w)}
    got = blocks.framed(rows, ["k"], ["day", "id"], 3, columns, block)
    assert sorted(map(tuple, got.select(*plain.columns).collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
    plain = rows.withColumn("v", F.last("v", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    got = blocks.last_before(rows, ["k"], ["day", "id"], ["v"], block)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)


def test_as_of_with_a_hot_entity_and_many_matches_a_day(matches_of):
    rng = random.Random(3)
    history = [(f"2020-01-{1 + i // 6:02d}", "hot" if i % 3 == 0 else f"A{rng.randint(0, 3)}", f"B{rng.randint(0, 3)}", rng.randint(0, 3), rng.randint(0, 3)) for i in range(90)]
    df = matches_of(history)
    ratings = stage(elo.elo_ratings(df), "test-ratings")
    order = ["match_datetime", "home_team", "away_team", "match_id"]
    plain, spread = asof.entity_states(df, ratings), asof.entity_states(df, ratings, spread=True, block=8)
    key = lambda r: (r.team, r.match_id)
    assert sorted(spread.select(*plain.columns).collect(), key=key) == sorted(plain.collect(), key=key)
    probes = asof.probes_of(df)
    whole = asof.latest_before(probes, plain, asof.STATE, order)
    parts = asof.latest_before(probes, plain, asof.STATE, order, spread=True, block=8)
    key = lambda r: (r.team, r.match_date)
    assert sorted(parts.select(*whole.columns).collect(), key=key) == sorted(whole.collect(), key=key)


def test_plans_without_the_guard_equal_those_with_it(enc):
    key = lambda r: r.match_id
    a, b = (sorted(build_features(enc, "competition", strict=s).collect(), key=key) for s in (True, False))
    assert a == b
    asked = enc.filter("season >= '2000-01'").select("match_id", "match_date", "home_team", "away_team", "odds_home", "odds_draw", "odds_away")
    a, b = (sorted(build_fixture_features(enc, asked, keep=("match_id",), strict=s).collect(), key=key) for s in (True, False))
    assert a == b


def test_snapshot_plus_increments_equals_a_rebuild(enc):
    want = {r.team: r for r in asof.current_states(asof.entity_states(enc, elo.elo_ratings(enc))).collect()}
    state = stage(snapshot.stretch(enc.filter("match_date < '1995-01-01'")), "test-snapshot")
    for first, last in (("1995-01-01", "1999-12-31"), ("2000-01-01", "2100-01-01")):
        state = stage(snapshot.updated(state, enc.filter(F.col("match_date").between(first, last))), "test-snapshot")
    got = {r.team: r for r in snapshot.states(state).collect()}
    assert set(got) == set(want)
    for team, r in want.items():
        for c in (*asof.STATE[2:], "last_date"):
            assert got[team][c] == r[c], (team, c)
        assert got[team].elo == pytest.approx(r.elo, abs=1e-7)
    same = {r.team: r for r in snapshot.states(snapshot.updated(state, enc.limit(0))).collect()}
    assert same == got

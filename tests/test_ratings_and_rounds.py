import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import brute
from duelframe.operators import elo, groups, rounds

def ratings(df):
    return {r["match_id"]: (r["elo_home"], r["elo_away"]) for r in df.collect()}


def expected(rows):
    out, _ = brute.replay([r.asDict() for r in rows])
    return {k: (v["elo_home"], v["elo_away"]) for k, v in out.items()}


def close(a, b, tol=1e-7):
    assert a.keys() == b.keys()
    for k in a:
        assert a[k] == pytest.approx(b[k], abs=tol), k


def random_season(n_days=60, n_teams=8, seed=3):
    rng = random.Random(seed)
    rows = []
    for d in range(n_days):
        teams = [f"T{i}" for i in range(n_teams)]
        rng.shuffle(teams)
        for i in range(0, rng.choice([2, 4, n_teams]), 2):
            rows.append((f"2020-{1 + d // 28:02d}-{1 + d % 28:02d}", teams[i], teams[i + 1], rng.randint(0, 4), rng.randint(0, 3)))
    return rows


def test_one_step(matches_of):
    df = matches_of([("2020-01-01", "A", "B", 1, 0), ("2020-01-08", "A", "B", 1, 1)])
    got = ratings(elo.elo_ratings(df))
    assert got[1] == (1500.0, 1500.0)
    assert got[2][0] == pytest.approx(1508.290026, abs=1e-6)
    assert got[2][0] + got[2][1] == pytest.approx(3000.0)


def test_ratings_equal_replay(enc):
    close(ratings(elo.elo_ratings(enc, "competition")), expected(enc.collect()))
    close(ratings(elo.elo_ratings(enc)), expected(enc.collect()))


def test_groups_larger_than_a_task_are_cut_in_time(matches_of):
    df = matches_of(random_season(28))
    close(ratings(elo.elo_ratings(df, task_rows=40)), expected(df.collect()))


def test_hot_entity(matches_of):
    rng = random.Random(2)
    rows = [(f"2020-{1 + i // 28:02d}-{1 + i % 28:02d}", "hot", f"T{rng.randint(0, 20)}", rng.randint(0, 3), rng.randint(0, 3)) for i in range(40)]
    rows += [(d, f"A{rng.randint(0, 60)}", f"B{rng.randint(0, 60)}", h, a) for d, _, _, h, a in rows for _ in range(2)]
    df = matches_of(rows)
    close(ratings(elo.elo_ratings(df, "competition", task_rows=30)), expected(df.collect()))


def test_many_matches_of_an_entity_per_day(matches_of):
    rng = random.Random(5)
    rows = [("2020-01-0" + str(1 + i // 12), f"T{rng.randint(0, 3)}", f"U{rng.randint(0, 3)}", rng.randint(0, 3), rng.randint(0, 3)) for i in range(36)]
    df = matches_of(rows)
    close(ratings(elo.elo_ratings(df, task_rows=20)), expected(df.collect()))


def test_groups_of_different_size(matches_of):
    first = matches_of(random_season(20, 6, 1))
    second = matches_of(random_season(12, 4, 2)).withColumns(
        {"match_id": F.col("match_id") + 1000, "competition": F.lit(2), "home_team": F.concat(F.lit("Z"), "home_team"), "away_team": F.concat(F.lit("Z"), "away_team")}
    )
    df = first.unionByName(second)
    limit = second.count()
    assert first.count() > limit
    close(ratings(elo.elo_ratings(df, "competition", task_rows=limit)), expected(df.collect()))


def test_ratings_of_nothing_and_without_result_or_entity(matches_of):
    df = matches_of([("2020-01-01", "A", None, 1, 0), ("2020-01-02", None, "B", 0, 0), ("2020-01-03", "A", "B", 2, 0)])
    assert elo.elo_ratings(df.limit(0)).collect() == []
    got = ratings(elo.elo_ratings(df.withColumn("ftr", F.when(F.col("match_id") != 2, F.col("ftr")))))
    assert got[1] == (1500.0, 1500.0) and got[2][0] == pytest.approx(1500 - (got[3][0] - 1500)) and got[3][1] == 1500.0


def test_connected(spark):
    edges = [(f"n{i}", f"n{i + 1}") for i in range(40)] + [("x", "y"), ("y", "z"), ("m", "m")]
    got = {r.node: r.group for r in groups.connected(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert got == {f"n{i}": "n0" for i in range(41)} | dict.fromkeys("xyz", "x") | {"m": "m"}


def test_entity_in_two_competitions_keeps_one_rating(matches_of):
    df = matches_of(random_season(15, 4, 9)).withColumn("competition", F.col("match_id") % 2)
    close(ratings(elo.elo_ratings(df, "competition")), expected(df.collect()))


def test_rounds_equal_replay(matches_of, enc):
    df = matches_of(random_season(40, 8, 4)).withColumn("season", F.when(F.col("match_id") % 3 == 0, "2020-21").otherwise("2021-22"))
    want = brute.rounds([r.asDict() for r in df.collect()])
    for got in (rounds.matchdays(df), rounds.matchdays(df, block=7), rounds.matchdays(df, block=2)):
        assert {r["match_id"]: r["matchday"] for r in got.collect()} == want
    want = brute.rounds([r.asDict() for r in enc.collect()])
    assert {r["match_id"]: r["matchday"] for r in rounds.matchdays(enc).collect()} == want


def test_new_round_on_repeat(matches_of):
    df = matches_of([("2020-01-01", "A", "B", 0, 0), ("2020-01-01", "C", "D", 0, 0), ("2020-01-02", "E", "A", 0, 0), ("2020-01-03", "B", "C", 0, 0)])
    assert [r["matchday"] for r in rounds.matchdays(df).orderBy("match_id").collect()] == [1, 1, 2, 2]


def test_no_row_is_lost_without_season_or_date(matches_of):
    df = matches_of(random_season(12, 4, 6)).withColumn("season", F.when(F.col("match_id") % 5 > 0, F.lit("2020-21")))
    assert {r["match_id"]: r["matchday"] for r in rounds.matchdays(df).collect()} == brute.rounds([r.asDict() for r in df.collect()])
    gone = F.when(F.col("match_id") != 3, F.col("match_date"))
    undated = df.withColumns({"match_date": gone, "match_datetime": gone.cast("timestamp")})
    whole = ratings(elo.elo_ratings(undated))
    assert len(whole) == df.count()
    close(ratings(elo.elo_ratings(undated, task_rows=12)), whole)


def test_a_fold_holds_few_bytes_a_match():
    n = 100_000
    at = np.arange(n)
    matches = pa.table(
        {
            "match_datetime": pa.array(at, pa.int64()),
            **{c: pa.array([f"={x}" for x in at * step % 997], pa.string()) for c, step in (("home_team", 3), ("away_team", 5))},
            "match_id": pa.array(at, pa.int64()),
            **{c: pa.array([f"={x}" for x in at * step % 997], pa.string()) for c, step in (("home", 3), ("away", 5))},
            "actual": pa.array(at % 3 / 2, pa.float64()),
        }
    )
    fold = elo._fold(20.0, 60.0, 1500.0)
    tracemalloc.start()
    try:
        assert fold(matches).num_rows == n + 997
        assert tracemalloc.get_traced_memory()[1] < 100 * n
    finally:
        tracemalloc.stop()

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import brute
from duelframe.operators import asof, elo, form, guard, longform, registry, splits
from duelframe.plans.features import build_features
from duelframe.plans.fixtures import build_fixture_features, eligibility, prediction_rows
from duelframe.schema import FEATURES


@pytest.fixture(scope="module")
def built(enc):
    return {r["match_id"]: r.asDict() for r in build_features(enc, "competition").collect()}


def agree(got, want):
    assert got.keys() == want.keys()
    for k, features in want.items():
        for name, value in features.items():
            assert got[k][name] == pytest.approx(value, abs=1e-7), (k, name)


def test_all_features_equal_sequential_replay(enc, built):
    want, _ = brute.replay([r.asDict() for r in enc.collect()])
    agree(built, want)
    row = next(iter(built.values()))
    assert set(FEATURES) <= set(row)


def test_one_league_without_competition_column(matches_of):
    df = matches_of([("2020-01-01", "A", "B", 2, 0), ("2020-01-04", "B", "A", 1, 1), ("2020-01-09", "A", "B", 0, 3)])
    got = {r["match_id"]: r.asDict() for r in build_features(df).collect()}
    agree(got, brute.replay([r.asDict() for r in df.collect()])[0])
    assert got[1]["home_points_5"] == 1.35 and got[1]["home_rest_days"] == 7.0
    assert got[2]["away_points_5"] == 3.0 and got[2]["away_rest_days"] == 3.0
    assert got[3]["home_home_points_5"] == 3.0


def test_input_order_does_not_matter(enc, built):
    again = {r["match_id"]: r.asDict() for r in build_features(enc.orderBy(F.rand(1)).repartition(7), "competition").collect()}
    assert again == built


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(min_value=0, max_value=1490))
def test_later_results_never_reach_earlier_rows(enc, built, pick):
    ids = sorted(built)
    target = built[ids[pick]]
    changed = enc.withColumn(
        "home_goals", F.when(F.col("match_id") == target["match_id"], F.col("home_goals") + 7).otherwise(F.col("home_goals"))
    ).withColumn("ftr", F.when(F.col("match_id") == target["match_id"], "H").otherwise(F.col("ftr")))
    for r in build_features(changed, "competition").filter(F.col("match_date") <= F.lit(target["match_date"])).collect():
        for f in FEATURES:
            assert r[f] == pytest.approx(built[r["match_id"]][f], abs=1e-9), f


def test_guard_raises_and_reports(matches_of):
    df = matches_of([("2020-01-01", "A", "B", 1, 0), ("2020-01-01", "C", "A", 1, 0)])
    assert [(r.team, r.n_matches) for r in guard.repeated_days(df).collect()] == [("A", 2)]
    with pytest.raises(ValueError, match="one entity on one date"):
        build_features(df)
    assert build_features(df, strict=False).count() == 2


def test_rolling_mean_chunked_equals_plain(spark, enc):
    long = longform.entity_rows(enc)
    args = (["team"], "match_date", ["match_id"], F.col("goals_for"), 5, "m", -1.0)
    plain = form.rolling_mean_before(long, *args, one_per_day=True)
    split = form.rolling_mean_before(long, *args, one_per_day=False, block=64)
    key = ["match_id", "team"]
    both = plain.select(*key, F.col("m").alias("a")).join(split.select(*key, F.col("m").alias("b")), key)
    assert both.count() == long.count()
    assert both.filter("abs(a - b) > 1e-12").isEmpty()


def test_rolling_mean_of_one_hot_key(spark):
    # One key holds every row, many of them on the same day.
    rows = [(i, dt.date(2020, 1, 1 + i // 40), float(i * i % 13)) for i in range(200)]
    df = spark.createDataFrame(rows, "i int, day date, v double").withColumn("k", F.lit("hot"))
    for block in (7, 30, 1 << 16):
        got = form.rolling_mean_before(df, ["k"], "day", ["i"], F.col("v"), 7, "m", -1.0, block=block).collect()
        assert len(got) == len(rows)
        for r in got:
            before = [v for i, _, v in rows if i < r.i][-7:]
            assert r.m == pytest.approx(brute.mean(before, -1.0))


def test_calendar_form_counts_days_not_rows(matches_of):
    df = matches_of([("2020-01-01", "A", "B", 4, 0), ("2020-01-05", "A", "C", 2, 0), ("2020-01-11", "A", "B", 1, 0)])
    out = form.calendar_form(df, "match_date", [("home_team", "home_goals", "f")], 6).orderBy("match_id").collect()
    assert [r.f for r in out] == [0.0, 4.0, 2.0]


def test_recent_entries_are_bounded(enc):
    long = form.with_recent_entries(longform.entity_rows(enc), 3)
    assert long.agg(F.max(F.size("recent"))).first()[0] == 3
    assert long.filter(F.exists("recent", lambda e: e["match_date"] >= F.col("match_date"))).isEmpty()


def test_fixture_features_equal_feature_rows(enc, built):
    fixtures = enc.filter("season = '2000-01'").select("match_id", "match_date", "home_team", "away_team", "odds_home", "odds_draw", "odds_away")
    for r in build_fixture_features(enc, fixtures, "competition", keep=("match_id",)).collect():
        for f in FEATURES:
            assert r[f] == pytest.approx(built[r["match_id"]][f], abs=1e-7), f


def test_fixture_of_unknown_entities_gets_defaults(spark, matches_of):
    history = matches_of([("2020-01-01", "A", "B", 2, 0)])
    fixtures = spark.sql(
        "select date'2020-02-01' as match_date, 'A' as home_team, 'Z' as away_team, 2.0D as odds_home, 4.0D as odds_draw, 4.0D as odds_away"
        " union all select date'2020-01-01', 'A', 'B', null, null, null"
    )
    late, same_day = build_fixture_features(history, fixtures).orderBy(F.desc("match_date")).collect()
    assert (late.home_points_5, late.home_rest_days, late.away_points_5, late.away_rest_days) == (3.0, 31.0, 1.35, 7.0)
    assert (late.elo_away, late.implied_home) == (1500.0, 0.5) and late.elo_home > 1500
    assert (same_day.home_points_5, same_day.elo_home, same_day.implied_home) == (1.35, 1500.0, None)


def test_current_states(matches_of):
    df = matches_of([("2020-01-01", "A", "B", 2, 0), ("2020-01-08", "B", "A", 1, 1), ("2020-01-15", "C", "B", 0, 1)])
    states = {r.team: r for r in asof.current_states(asof.entity_states(df, elo.elo_ratings(df))).collect()}
    _, final = brute.replay([r.asDict() for r in df.collect()])
    for team, rating in final.items():
        assert states[team].elo == pytest.approx(rating, abs=1e-9)
    assert states["B"].last_date == dt.date(2020, 1, 15)
    assert states["B"].points_5 == pytest.approx(4 / 3)
    assert (states["B"].home_points_5, states["B"].away_points_5) == (1.0, 1.5)
    assert states["C"].away_points_5 == 1.35


def test_eligibility_order_of_rules(spark, matches_of):
    daily = [(f"2024-01-{d:02d}", "Alpha", f"G{d}", 1, 0) for d in range(1, 8)] + [(f"2024-01-{d:02d}", f"H{d}", "Beta", 1, 0) for d in range(1, 8)]
    history = matches_of(daily)
    entities = spark.createDataFrame([("Alpha",), ("Beta",), ("G1",)], "name string")
    asked = spark.createDataFrame(
        [(1, " Alpha", "ALPHA ", "2024-02-01"), (2, "Alpha", "Nobody", "2024-02-01"), (3, "Nobody", "Beta", "2024-02-01"),
         (4, "Alpha", "G1", "2024-02-01"), (5, "Alpha", "Beta", "2024-01-05"), (6, "Alpha ", "Beta", "2024-01-06")],
        "id int, home_team string, away_team string, d string",
    ).withColumn("match_date", F.to_date("d"))
    out = {r.id: r for r in eligibility(asked, entities, history).collect()}
    assert [out[i].status for i in range(1, 7)] == ["invalid_input", "not_found", "not_found", "insufficient_history", "insufficient_history", "ok"]
    assert "different" in out[1].message and "Away team 'Nobody'" in out[2].message and "Home team 'Nobody'" in out[3].message
    assert (out[6].home_history, out[6].away_history) == (5, 5)


def test_prediction_rows_normalise(spark):
    row = prediction_rows(
        spark.sql(
            "select 'A' as home_team, 'B' as away_team, date'2024-02-01' as match_date, 2.0D as p_home, 1.0D as p_draw, 0.5D as p_away, 'v1' as model_version,"
            " 1.6D as home_goals_for_5, 1.2D as away_goals_for_5, 1.0D as home_goals_against_5, 1.1D as away_goals_against_5, 45.0D as elo_diff, 1.0D as rest_days_diff"
        )
    ).first()
    assert row.home_win_probability + row.draw_probability + row.away_win_probability == pytest.approx(1.0, abs=1e-6)
    assert row.home_win_probability == pytest.approx(0.4) and row.predicted_outcome == "H"
    assert 0 <= row.expected_away_goals <= row.expected_home_goals <= 6


def test_registry(spark, matches_of):
    df = matches_of([("2020-01-01", "A", "B", 2, 0), ("2020-01-08", "C", "A", 1, 1)])
    have = spark.createDataFrame([("A",), ("X",)], "name string")
    table, counts = registry.sync_entities(have, df)
    assert {(r.name, r.created) for r in table.collect()} == {("A", False), ("X", False), ("B", True), ("C", True)}
    assert tuple(counts.first()) == (2, 1)
    assert [(r.id, r.name) for r in registry.numbered_universe(df).orderBy("id").collect()] == [(1, "A"), (2, "B"), (3, "C")]
    models = spark.createDataFrame([("v1", "p1", 1, True), ("v2", "p2", 2, False)], "version string, artifact_path string, created_at int, is_active boolean")
    now = spark.createDataFrame([("v2", "p9", 7)], "version string, artifact_path string, created_at int")
    out = {r.version: r for r in registry.upsert_model(models, now).collect()}
    assert (out["v2"].artifact_path, out["v2"].created_at, out["v2"].is_active, out["v1"].is_active) == ("p9", 2, True, False)
    assert registry.newest_active(registry.upsert_model(models, now)).first().version == "v2"


def test_windows_and_splits_keep_rows_without_key_or_day(matches_of):
    df = matches_of([("2020-01-01", "A", "B", 2, 0), ("2020-01-03", "A", "C", 1, 1), ("2020-01-05", "A", "B", 0, 1), ("2020-01-06", "B", "C", 3, 1)])
    df = df.withColumn("home_team", F.when(F.col("match_id") != 4, F.col("home_team"))).withColumn("match_date", F.when(F.col("match_id") != 2, F.col("match_date")))
    got = {r["match_id"]: r["f"] for r in form.calendar_form(df, "match_date", [("home_team", "home_goals", "f")], 30).collect()}
    assert got == {1: 0.0, 2: 0.0, 3: 2.0, 4: 0.0}
    assert splits.fraction_split(df, "match_date").count() == 4


@pytest.mark.parametrize("label", ["X", None])
def test_bad_labels_raise(matches_of, label):
    df = matches_of([("2020-01-01", "A", "B", 2, 0), ("2020-01-03", "A", "C", 1, 1)])
    df = df.withColumn("ftr", F.when(F.col("match_id") == 1, F.lit(label)).otherwise(F.col("ftr")))
    with pytest.raises(ValueError, match="H, D or A"):
        build_features(df)
    with pytest.raises(ValueError, match="H, D or A"):
        build_fixture_features(df, df)

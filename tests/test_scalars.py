import datetime as dt
import json
import math

import pytest
from pyspark.sql import functions as F

from duelframe.functions import scalars as S
from duelframe.schema import ALIASES, INGEST_ALIASES


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


@pytest.mark.parametrize(
    "text, want",
    [
        ("25/08/2020", dt.date(2020, 8, 25)),
        ("05/03/2026", dt.date(2026, 3, 5)),
        ("2026-03-05", dt.date(2026, 3, 5)),
        ("13/05/17", dt.date(2017, 5, 13)),
        ("13/05/93", dt.date(1993, 5, 13)),
        ("08/25/2020", dt.date(2020, 8, 25)),
        ("1/8/2020", dt.date(2020, 8, 1)),
        ("5 Aug 2020", dt.date(2020, 8, 5)),
        ("25.08.2020", dt.date(2020, 8, 25)),
        ("31/02/2020", None),
        ("13/13/2020", None),
        (" 25/08/2020 ", dt.date(2020, 8, 25)),
        ("soon", None),
        (None, None),
    ],
)
def test_parse_date(spark, text, want):
    assert one(spark, d=S.parse_date(F.lit(text).cast("string"))).d == want


@pytest.mark.parametrize(
    "text, want",
    [
        ("Aug 5 2020", "2020-08-05"),
        ("20200805", "2020-08-05"),
        ("05/08/2020 15:30", "2020-08-05"),
        ("2020-08-05T10:00:00.5Z", "2020-08-05"),
        ("5th August, 2020", "2020-08-05"),
        ("Wed, 05 Aug 2020 10:00:00 +0000", "2020-08-05"),
        ("1 Sept. 2020 3 pm", "2020-09-01"),
        ("05AUG69", "1969-08-05"),
        ("Aug 2020", "2020-08-01"),
        ("2020-13-05", "2020-05-13"),
        ("5 Aug", None),
        ("31/02/2020", None),
        ("99999999", None),
        ("1/2/3/4", None),
        ("May 5 June 2020", None),
        ("5 Foo 2020", None),
        ("2020", None),
        ("", None),
        (None, None),
    ],
)
def test_free_text_dates(spark, text, want):
    got = one(spark, d=S.parse_date(F.lit(text).cast("string"))).d
    assert (got and str(got)) == want


def test_kickoff(spark):
    day = F.to_date(F.lit("2020-08-25"))
    row = one(
        spark,
        good=S.kickoff_timestamp(day, F.lit("15:30")),
        short=S.kickoff_timestamp(day, F.lit("7:05")),
        bad=S.kickoff_timestamp(day, F.lit("late")),
        none=S.kickoff_timestamp(day, F.lit(None).cast("string")),
    )
    base = dt.datetime(2020, 8, 25)
    assert (row.good, row.short, row.bad, row.none) == (base.replace(hour=15, minute=30), base.replace(hour=7, minute=5), base, base)


def test_names(spark):
    row = one(
        spark,
        a=S.normalise_name(F.lit(" Man City "), ALIASES),
        b=S.normalise_name(F.lit("Newcastle"), INGEST_ALIASES),
        c=S.normalise_name(F.lit(None).cast("string"), ALIASES),
        d=S.normalise_name(F.lit("Elsewhere"), {}),
    )
    assert tuple(row) == ("Manchester City", "Newcastle", None, "Elsewhere")


def test_result_and_points(spark):
    row = one(
        spark,
        kept=S.validated_result(F.lit("A"), F.lit(3), F.lit(0)),
        lower=S.validated_result(F.lit("h"), F.lit(0), F.lit(2)),
        null=S.validated_result(F.lit(None).cast("string"), F.lit(1), F.lit(1)),
        hp=S.points(F.lit("H"), F.lit(True)),
        ap=S.points(F.lit("H"), F.lit(False)),
        dp=S.points(F.lit("D"), F.lit(False)),
    )
    assert tuple(row) == ("A", "A", "D", 3, 0, 1)
    with pytest.raises(Exception, match="unexpected result label"):
        one(spark, x=S.points(F.lit("X"), F.lit(True), strict=True))


def test_number_and_finite(spark):
    row = one(
        spark,
        a=S.to_number(F.lit("2.5")),
        b=S.to_number(F.lit("x")),
        c=S.finite(F.lit(float("inf"))),
        d=S.finite(F.lit(float("nan"))),
        e=S.finite(F.lit(-1.5)),
        f=S.to_number(F.lit("NaN")),
    )
    assert tuple(row) == (2.5, None, None, None, -1.5, None)


def test_implied(spark):
    h, d, a = S.implied_probabilities(F.lit(2.0), F.lit(4.0), F.lit(4.0))
    row = one(spark, h=h, d=d, a=a)
    assert tuple(row) == (0.5, 0.25, 0.25)
    for bad in (1.0, float("nan"), None):
        h, _, _ = S.implied_probabilities(F.lit(2.0), F.lit(bad).cast("double"), F.lit(4.0))
        assert one(spark, h=h).h is None


@pytest.mark.parametrize(
    "raw, want",
    [
        ((2.0, 1.0, 1.0), (1 / 3, 1 / 3, 1 / 3)),
        ((0.6, 0.2, 0.0), (0.75, 0.25, 0.0)),
        ((float("inf"), 0.5, 0.5), (0.5, 0.25, 0.25)),
        ((-1.0, 0.0, 0.0), (1 / 3, 1 / 3, 1 / 3)),
        ((float("nan"), 0.5, 0.5), (1 / 3, 1 / 3, 1 / 3)),
        ((None, 0.5, 0.5), (1 / 3, 1 / 3, 1 / 3)),
    ],
)
def test_sanitise(spark, raw, want):
    cols = S.sanitise_triple(*[F.lit(x).cast("double") for x in raw])
    row = one(spark, h=cols[0], d=cols[1], a=cols[2])
    assert tuple(row) == pytest.approx(want)
    assert math.fsum(row) == pytest.approx(1.0)


def test_expected_goals_defaults_zero(spark):
    # Zero form counts as missing, so both sides start from 1.35.
    df = spark.range(1).select(
        *[F.lit(0.0).alias(c) for c in ("home_goals_for_5", "away_goals_for_5", "home_goals_against_5", "elo_diff")],
        F.lit(None).cast("double").alias("away_goals_against_5"),
        F.lit(40.0).alias("rest_days_diff"),
    )
    home, away = S.expected_goals(F.lit(0.5), F.lit(0.2), F.lit(0.3))
    row = df.select(home.alias("h"), away.alias("a")).first()
    assert row.h == pytest.approx(1.35 + 0.07 + 0.1 + 0.03, abs=1e-9)
    assert row.a == pytest.approx(1.35 - 0.07 - 0.1 + 0.03, abs=1e-9)


def test_labels_and_badges_break_ties_differently(spark):
    row = one(
        spark,
        da=S.predicted_label(F.lit(0.2), F.lit(0.4), F.lit(0.4)),
        hd=S.predicted_label(F.lit(0.4), F.lit(0.4), F.lit(0.2)),
        badge_da=S.outcome_badge(F.lit(20), F.lit(40), F.lit(40)),
        badge_ha=S.outcome_badge(F.lit(40), F.lit(20), F.lit(40)),
        badge_a=S.outcome_badge(F.lit(20), F.lit(30), F.lit(50)),
    )
    assert tuple(row) == ("D", "H", "draw", "home", "away")


def test_percentages(spark):
    def pct(h, d, a):
        cols = S.integer_percentages(F.lit(h), F.lit(d), F.lit(a))
        return tuple(one(spark, h=cols[0], d=cols[1], a=cols[2]))

    assert pct(0.5, 0.3, 0.2) == (50, 30, 20)
    assert pct(0.505, 0.495, 0.0) == (50, 50, 0)
    assert pct(0.3, 0.705, 0.0) == (30, 70, 0)


def test_seasons_and_labels(spark):
    row = one(
        spark,
        code=S.season_code(F.lit("2023-24")),
        path=S.season_path(F.lit("1999-00")),
        year=S.season_start_year(F.lit("2016-17")),
        label=S.season_from_path(F.lit("/data/raw/2016-17.csv")),
        none=S.season_from_path(F.lit("/data/2016-17/all.csv")),
        week=S.iso_week_label(F.to_date(F.lit("2021-01-01"))),
        key=S.natural_key(F.lit("2020-21"), F.to_date(F.lit("2020-09-12")), F.lit("A"), F.lit("B")),
        short=S.short_code(F.lit("Arsenal")),
        colour=S.colour(F.lit("x"), {}),
    )
    assert tuple(row) == ("2324", "9900/E0.csv", 2016, "2016-17", None, "W53-2021", "2020-21:2020-09-12:A:B", "ARS", "#8891B8")


def test_snapshot_and_log_line(spark):
    df = spark.range(1).select(
        F.to_date(F.lit("2024-01-02")).alias("d"), F.lit(float("nan")).alias("x"), F.lit(1.5).alias("y"), F.lit(None).cast("string").alias("s")
    )
    snap = df.select(S.json_snapshot(["d", "x", "y", "s"], ["d"], ["x", "y"]).alias("j")).first().j
    assert json.loads(snap) == {"d": "2024-01-02T00:00:00", "x": None, "y": 1.5, "s": None}
    line = one(spark, l=S.log_line(F.lit("T"), F.lit("train"), {"b": (F.lit(0.5), True), "a": (F.lit(3), False)})).l
    assert line == "ts=T | event=train | a=3 | b=0.500000"


def test_search(spark):
    df = spark.createDataFrame([("Arsenal",), ("Chelsea",)], "name string")
    assert [r.name for r in df.filter(S.matches_search("name", " SEN ")).collect()] == ["Arsenal"]
    assert df.filter(S.matches_search("name", "  ")).count() == 2

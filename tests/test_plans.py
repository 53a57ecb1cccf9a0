"""The plans that write reports and predictions, and the flat pipelines' scores."""

import random

import pytest
from pyspark.sql import functions as F

from duelframe.operators import models
from duelframe.plans import flat, publish
from duelframe.sources import writers


def test_a_missing_model_is_an_error(enc, tmp_path):
    with pytest.raises(FileNotFoundError):
        publish.evaluate_and_report(enc, {}, str(tmp_path / "none"), str(tmp_path / "r"), str(tmp_path / "l"))
    with pytest.raises(FileNotFoundError):
        publish.predict_and_publish(enc, enc, str(tmp_path / "none"), str(tmp_path / "p"), str(tmp_path / "l"))


def test_predictions_file_and_log(spark, enc, tmp_path):
    root = str(tmp_path)
    writers.save_model(spark, models.ConstantModel((0.5, 0.2, 0.3)), f"{root}/m", {}, "v7")
    asked = enc.limit(5).select("match_date", "home_team", "away_team", "odds_home", "odds_draw", "odds_away")
    back = publish.predict_and_publish(enc, asked, f"{root}/m", f"{root}/p", f"{root}/l", fixtures_name="week.csv").collect()
    assert len(back) == 5 and {(r.P_home, r.P_draw, r.P_away, r.predicted_outcome, r.model_version) for r in back} == {(0.5, 0.2, 0.3, "H", "v7")}
    payload = spark.read.parquet(f"{root}/l").first().payload
    assert payload == {"fixtures_file": "week.csv", "predictions_file": f"{root}/p", "n_predictions": "5", "model_version": "v7"}


def test_an_empty_split_is_an_error(spark, enc, tmp_path):
    root = str(tmp_path)
    writers.save_model(spark, models.ConstantModel((0.5, 0.2, 0.3)), f"{root}/m", {}, "v1")
    features = enc.withColumns({c: F.lit(0.0) for c in models.FEATURES})
    with pytest.raises(ValueError):
        publish.evaluate_and_report(features, {"validation": ["1999-00"], "test": ["2090-91"]}, f"{root}/m", f"{root}/r", f"{root}/l")


def test_weighted_scores(spark):
    rng = random.Random(1)
    rows = [("m", rng.choice("HDA"), rng.choice("HHA")) for _ in range(60)]
    got = flat.weighted_scores(spark.createDataFrame(rows, "model string, actual string, predicted string"), ["model"]).first()
    f1 = 0.0
    for c in "HDA":
        there, said, right = (sum(f(a, p) for _, a, p in rows) for f in (lambda a, p: a == c, lambda a, p: p == c, lambda a, p: a == p == c))
        f1 += there / 60 * (2 * right / (there + said) if there + said else 0)
    assert (got.n_rows, got.accuracy, got.f1) == (60, pytest.approx(sum(a == p for _, a, p in rows) / 60), pytest.approx(f1))


def test_counts_fills_and_bounds(spark):
    from duelframe.operators import clean, splits

    rows = [("2020-01-01", "A", "B", 1, 0), ("2020-01-01", "A", "A", 1, 0), (None, "A", "B", 1, 0), ("2020-02-01", None, "B", 1, 0), ("2020-02-01", "A", "B", None, 0)]
    df = spark.createDataFrame(rows, "d string, home_team string, away_team string, home_goals int, away_goals int").withColumn("match_date", F.to_date("d"))
    assert tuple(clean.invalid_row_counts(df).first()) == (5, 1, 4) and tuple(clean.invalid_row_counts(df, scores=False).first()) == (5, 2, 3)
    assert tuple(clean.invalid_row_counts(df.limit(0)).first()) == (0, 0, 0)
    assert [r.home_goals for r in clean.fill_missing(df, {"home_goals": 7}).collect()] == [1, 1, 1, 1, 7]
    assert clean.fill_missing(df, {}).filter("d is null or home_team is null").count() == 2
    with pytest.raises(ValueError):
        clean.fill_missing(df, {"odds": 1.0})
    got = [(str(r.match_date), r.n_matches, r.is_first, r.is_last) for r in splits.dates_and_bounds(df).collect()]
    assert got == [("None", 1, None, None), ("2020-01-01", 2, True, False), ("2020-02-01", 2, False, True)]

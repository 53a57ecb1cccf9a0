"""Fits: whole ones through the registered queries, and their parts against plain computations."""

import inspect
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from duelframe.catalog import models as catalog
from duelframe.operators import boosting, calibration, logistic, models, packing
from duelframe.plans import train


@pytest.fixture(scope="module")
def data(spark, sf_dir):
    return catalog.prepared(spark, sf_dir)


@pytest.fixture()
def on_data(data, monkeypatch):
    monkeypatch.setattr(catalog, "prepared", lambda *_: data)
    return entry.queries()


def test_fits_are_whole():
    """Every fit of the registered queries has the operator's own trees and iterations: none passes any."""
    assert inspect.signature(models.fit_boosted).parameters["params"].default == models.BOOSTING
    assert models.BOOSTING == {"n_estimators": 500, "learning_rate": 0.03, "max_depth": 5, "subsample": 0.9, "feature_share": 0.9}
    assert inspect.signature(models.fit_logistic).parameters["max_iter"].default == 2000
    assert "params=" not in inspect.getsource(catalog) and "max_iter" not in inspect.getsource(catalog)


def test_every_match_is_a_fixture(spark, sf_dir, enc):
    asked = entry.queries()["M08_predict_fixtures"](spark, sf_dir).collect()
    assert {r.match_id for r in asked} == {r.match_id for r in enc.select("match_id").collect()}
    assert len(asked) == enc.count() and all(r.valid for r in asked)


def test_whole_boosted_fit(spark, sf_dir, on_data):
    rows = {r.split: r for r in on_data["M03_boosted"](spark, sf_dir).collect()}
    assert set(rows) == {"train", "validation", "test"}
    assert all(r.n_rows > 0 and r.n_invalid == 0 for r in rows.values()) and rows["train"].better_than_frequencies


def test_logistic_optimum(spark, sf_dir, on_data):
    rows = on_data["M02_logistic_optimum"](spark, sf_dir).collect()
    assert len(rows) == 75 and all(r.flat for r in rows)


@pytest.mark.parametrize("kind", ["logistic", "boosted"])
def test_folds_agree_with_single_fits(data, kind):
    params = {**models.BOOSTING, "n_estimators": 15}
    many = {"logistic": models.fit_logistic_folds, "boosted": lambda df: models.fit_boosted_folds(df, params=params)}[kind]
    one = {"logistic": models.fit_logistic, "boosted": lambda df: models.fit_boosted(df, params=params)}[kind]
    rows = train.rolling_backtest(data.drop("split"), many).collect()
    assert len(rows) > 3
    r = rows[2]
    single = models.evaluate(one(data.filter(F.substring("season", 1, 4) < r.test_season[:4])), data.filter(F.col("season") == r.test_season))
    assert (r.n_rows, r.log_loss, r.accuracy) == (single["n_rows"], pytest.approx(single["log_loss"], abs=1e-9), single["accuracy"])


@pytest.mark.parametrize("kind", ["logistic", "boosted"])
def test_fits_do_not_depend_on_partitions(data, kind, monkeypatch):
    # Several blocks a fit, and a row that stands very often.
    monkeypatch.setattr(packing.packed, "__defaults__", ("label", "fold", 200, None))
    rows = data.filter("split = 'train'").select("label", *models.FEATURES)
    rows = rows.unionByName(rows.limit(1).withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(300)))).drop("k"))
    fit = {"logistic": models.fit_logistic, "boosted": lambda df: models.fit_boosted(df, params={**models.BOOSTING, "n_estimators": 5})}[kind]
    a, b = (fit(x) for x in (rows.coalesce(1), rows.repartition(7)))
    if kind == "logistic":
        assert a.fitted == b.fitted
    else:
        assert len(a.blocks) > 1 and [t.to_bytes() for t in a.blocks] == [t.to_bytes() for t in b.blocks]


def test_bound_on_rows_is_drawn_by_hash(spark):
    rows = spark.range(5000).select(F.lit(0).alias("fold"), (F.col("id") % 3).cast("double").alias("label"), F.rand(1).alias("a"), F.rand(2).alias("b"))
    whole = packing.packed(rows, ["a", "b"], block_rows=1000).agg(F.sum("n"), F.count("*")).first()
    assert tuple(whole) == (5000, 5)
    some = packing.packed(rows, ["a", "b"], block_rows=1000, max_blocks=2).agg(F.sum("n"), F.count("*")).first()
    assert 1700 < some[0] < 2300 and some[1] == 2


def test_trees_learn_what_one_column_tells():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 3))
    y = np.digitize(x[:, 1], [-0.4, 0.4])
    trees = boosting.grow(x, y, np.ones(600), {**models.BOOSTING, "n_estimators": 60, "learning_rate": 0.2}, 1)
    p = trees.probabilities(x)
    assert np.allclose(p.sum(axis=0), 1) and (p.argmax(axis=0) == y).mean() > 0.97
    again = boosting.Trees.from_bytes(trees.to_bytes())
    assert (again.probabilities(x) == p).all()
    none = boosting.grow(x[:3], np.zeros(3, np.int64), np.ones(3), {**models.BOOSTING, "n_estimators": 2}, 1)
    assert np.isfinite(none.probabilities(x)).all()


def _plain_isotonic(points):
    blocks = []
    for s in sorted({s for s, _ in points}):
        hits = [h for t, h in points if t == s]
        blocks.append([s, s, len(hits), sum(hits)])
        while len(blocks) > 1 and blocks[-2][3] / blocks[-2][2] >= blocks[-1][3] / blocks[-1][2]:
            b = blocks.pop()
            blocks[-1] = [blocks[-1][0], b[1], blocks[-1][2] + b[2], blocks[-1][3] + b[3]]
    return blocks


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(4)
    rows = []
    for _ in range(700):
        s = [rng.choice([0.1, 0.5, round(rng.random(), 2)]) for _ in range(3)]
        rows.append((max(range(3), key=lambda c: s[c] + rng.random()), *s))
    return spark.createDataFrame(rows, "label int, s0 double, s1 double, s2 double").repartition(9)


@pytest.mark.parametrize("fan_in", [2, 16])
def test_isotonic_equals_plain_pooling(spark, scored, monkeypatch, fan_in):
    monkeypatch.setattr(calibration, "FAN_IN", fan_in)
    rows = scored.collect()
    got = [tuple(r) for r in calibration.isotonic_blocks(scored, ["s0", "s1", "s2"]).collect()]
    want = [(c, lo, hi, n, h) for c in range(3) for lo, hi, n, h in _plain_isotonic([(r[f"s{c}"], int(r.label == c)) for r in rows])]
    assert got == want
    fit = calibration.fit_isotonic(scored, ["s0", "s1", "s2"])
    assert all(f["y"] == sorted(f["y"]) for f in fit)
    ends = spark.createDataFrame([(-5.0,), (5.0,), (0.5,)], "s double").select(calibration.applied(fit[0], "s")).collect()
    assert ends[0][0] == fit[0]["y"][0] and ends[1][0] == fit[0]["y"][-1] and ends[2][0] == pytest.approx(np.interp(0.5, fit[0]["x"], fit[0]["y"]))


def test_sigmoid_is_flat_at_its_fit(spark, scored):
    rows = scored.collect()
    for c, fit in enumerate(calibration.fit_sigmoid(scored, ["s0", "s1", "s2"])):
        hits = sum(r.label == c for r in rows)
        high, low = (hits + 1) / (hits + 2), 1 / (len(rows) - hits + 2)
        slope = offset = 0.0
        for r in rows:
            p = 1 / (1 + math.exp(fit["slope"] * r[f"s{c}"] + fit["offset"]))
            d = (high if r.label == c else low) - p
            slope, offset = slope + d * r[f"s{c}"], offset + d
        assert abs(slope) < 1e-4 and abs(offset) < 1e-4 and fit["slope"] < 0
    one = spark.createDataFrame([(0, 0.2, 0.3, 0.5)] * 3, "label int, s0 double, s1 double, s2 double")
    assert all(math.isfinite(f["slope"] + f["offset"]) for f in calibration.fit_sigmoid(one, ["s0", "s1", "s2"]))


def test_logistic_with_missing_and_constant_columns(spark):
    rng = random.Random(1)
    rows = [(rng.randrange(3), rng.choice([None, rng.random()]), 1.0, None) for _ in range(90)]
    df = spark.createDataFrame([(0, *r) for r in rows], "fold int, label int, a double, b double, c double")
    model = logistic.fit_folds(df, ["a", "b", "c"])[0]
    present = sorted(a for _, a, _, _ in rows if a is not None)
    assert model.medians[0] == pytest.approx(float(np.median(present))) and model.scale[1:] == [1.0, 1.0]
    p = df.select(*[x.alias(f"p{i}") for i, x in enumerate(model.probabilities())]).collect()
    assert all(sum(r) == pytest.approx(1.0) for r in p)
    shares = [sum(r[0] == c for r in rows) / 90 for c in range(3)]
    assert [sum(r[c] for r in p) / 90 for c in range(3)] == pytest.approx(shares, abs=1e-6)

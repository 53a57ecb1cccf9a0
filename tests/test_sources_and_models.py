import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from duelframe.operators import clean, metrics, models, ordering, splits
from duelframe.plans import train
from duelframe.plans.features import build_features
from duelframe.session import stage
from duelframe.sources import readers, writers

SEASONS = {"train": ["1994-95", "1995-96", "1996-97", "1997-98", "1998-99"], "validation": ["1999-00"], "test": ["2000-01", "2001-02"]}
SHORT = {**models.BOOSTING, "n_estimators": 3, "max_depth": 2}


@pytest.fixture()
def season_dir(tmp_path):
    # The first file has a byte-order mark, a leading extra column, prices of two providers and a repeated match.
    (tmp_path / "2020-21.csv").write_bytes(
        "﻿Div,Date,Time,HomeTeam,AwayTeam,FTHG,FTAG,FTR,PSH,PSD,PSA,AvgH,AvgD,AvgA\n"
        "E0,12/09/2020,15:00, Man United ,Spurs,1,1,D,2.0,3.5,4.0,9,9,9\n"
        "E0,12/09/2020,15:00,Manchester United,Tottenham,2,1,H,2.1,3.5,4.0,9,9,9\n"
        "E0,11/09/20,late,A,B,0,2,h,1.0,,4.0,9,9,9\n"
        "E0,2020-10-05,,C,A,3,0,A,bad,3.0,4.0,9,9,9\n"
        "E0,soon,12:00,C,D,1,0,H,2,3,4,9,9,9\n"
        "E0,13/09/2020,12:00,,D,1,0,H,2,3,4,9,9,9\n"
        "E0,13/09/2020,12:00,D, D,1,0,H,2,3,4,9,9,9\n"
        "E0,13/09/2020,12:00,D,E,x,0,H,2,3,4,9,9,9\n".encode()
    )
    (tmp_path / "2021-22.csv").write_text("AwayTeam,HomeTeam,Date,FTAG,FTHG,HS,AS\nB,A,01/08/2021,0,4,11,3\nA,B,02/08/2021,1,1,,7\n")
    return tmp_path


def test_read_matches(spark, season_dir):
    rows = readers.read_matches(spark, f"{season_dir}/*.csv").orderBy("match_id").collect()
    assert [(r.match_id, r.season, str(r.match_date), r.home_team, r.away_team, r.ftr) for r in rows] == [
        (1, "2020-21", "2020-09-11", "A", "B", "A"),
        (2, "2020-21", "2020-09-12", "Manchester United", "Tottenham", "D"),
        (3, "2020-21", "2020-10-05", "C", "A", "A"),
        (4, "2021-22", "2021-08-01", "A", "B", "H"),
        (5, "2021-22", "2021-08-02", "B", "A", "D"),
    ]
    assert rows[0].match_datetime == dt.datetime(2020, 9, 11) and rows[1].match_datetime == dt.datetime(2020, 9, 12, 15)
    assert (rows[0].odds_home, rows[0].odds_draw) == (1.0, None)
    assert (rows[2].odds_home, rows[2].odds_draw) == (None, 3.0) and rows[3].odds_home is None


def test_read_extended(spark, season_dir):
    rows = readers.read_extended(spark, f"{season_dir}/*.csv", "files").orderBy("match_date", "home_team").collect()
    assert [r.matchday for r in rows] == [1, 1, 2, 1, 2]
    assert (rows[3].home_shots, rows[4].home_shots, rows[4].away_shots, rows[0].home_shots) == (11.0, None, 7.0, None)
    assert rows[3].source_match_id == "2021-22:2021-08-01:A:B" and rows[3].status == "completed"


def test_one_scan_a_header(spark, tmp_path):
    """Many files, two headers, one of them behind a byte-order mark; an empty file; the number of jobs does not grow."""
    heads = ("Date,HomeTeam,AwayTeam,FTHG,FTAG", "\ufeffHomeTeam,Date,AwayTeam,FTAG,FTHG,,HomeTeam")
    lines = ("01/08/{y},A{k},B,2,0", "A{k},01/08/{y},B,0,2,x,y")
    for k in range(24):
        y = 1980 + k
        (tmp_path / f"{y}-{(y + 1) % 100:02d}.csv").write_text(heads[k % 2] + "\n" + lines[k % 2].format(y=y, k=k) + "\n")
    (tmp_path / "2010-11.csv").write_text("")
    assert readers.header_columns(heads[1]) == ("HomeTeam0", "Date", "AwayTeam", "FTAG", "FTHG", "_c5", "HomeTeam6")
    sc = spark.sparkContext
    sc.setJobGroup("seasons", "seasons")
    frames = readers.read_seasons(spark, f"{tmp_path}/*.csv")
    jobs = len(sc.statusTracker().getJobIdsForGroup("seasons"))
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert len(frames) == 2 and jobs <= 6
    assert sorted(r._season for f in frames for r in f.collect()) == [f"{y}-{(y + 1) % 100:02d}" for y in range(1980, 2004)]


def test_reader_errors(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        readers.list_files(spark, f"{tmp_path}/*.csv")
    (tmp_path / "all.csv").write_text("Date\n1\n")
    with pytest.raises(ValueError, match="season label"):
        readers.read_matches(spark, f"{tmp_path}/all.csv")
    (tmp_path / "2020-21.csv").write_text("Date,HomeTeam\n1,A\n")
    with pytest.raises(ValueError, match=r"\['AwayTeam', 'FTAG', 'FTHG'\]"):
        readers.read_matches(spark, f"{tmp_path}/2020-21.csv")


def test_fixtures_and_cache(spark, tmp_path):
    (tmp_path / "f.csv").write_text("Date,HomeTeam,AwayTeam\n2026-03-15,Man City,Arsenal\n2026-03-15,X,X\n")
    rows = readers.read_fixtures(spark, f"{tmp_path}/f.csv").collect()
    assert [(str(r.match_date), r.home_team, r.odds_home) for r in rows] == [("2026-03-15", "Manchester City", None)]
    path = f"{tmp_path}/cache"
    assert readers.read_or_build(spark, path, lambda: spark.range(3)).count() == 3
    assert readers.read_or_build(spark, path, lambda: spark.range(9)).count() == 3
    assert readers.read_or_build(spark, path, lambda: spark.range(9), use_cached=False).count() == 9


def test_numbering_and_quantiles_with_a_hot_value(spark):
    # A third of all rows share one value and one order key prefix.
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 7.0).otherwise((F.col("id") * 7919 % 3001) / 10.0).alias("v"), F.lit("g").alias("g"))
    numbered = ordering.dense_index(df, ["v", "id"], "n").orderBy("n").collect()
    assert [r.n for r in numbered] == list(range(1, 3001))
    assert [(r.v, r.id) for r in numbered] == sorted((r.v, r.id) for r in numbered)
    q = ordering.grouped_quantiles(df, ["g"], "v", [0.0, 0.25, 0.5, 0.9, 1.0]).first()
    want = df.toPandas()["v"].quantile([0.0, 0.25, 0.5, 0.9, 1.0]).tolist()
    assert [q[f"q{i}"] for i in range(5)] == pytest.approx(want)


def test_hot_duplicates_are_cut_before_the_shuffle(spark):
    df = spark.range(5000).select(F.expr("id div 4000").alias("k"), F.col("id").alias("o"))
    kept = clean.first_per_key(df, ["k"], ["o"])
    assert sorted(r.o for r in kept.collect()) == [0, 4000]
    assert "WindowGroupLimit" in kept._jdf.queryExecution().toString()


def test_splits(spark, enc):
    named = enc.withColumn("split", splits.season_split("season", SEASONS))
    assert set(splits.require_splits(named, list(SEASONS))) == set(SEASONS)
    with pytest.raises(ValueError, match="missing"):
        splits.require_splits(named, [*SEASONS, "missing"])
    cut = splits.fraction_split(enc, "match_date")
    share = {r.split: r.n for r in cut.groupBy("split").agg((F.count("*") / enc.count()).alias("n")).collect()}
    assert share["train"] == pytest.approx(0.5, abs=0.01) and share["validation"] == pytest.approx(0.1, abs=0.01)
    ends = {r.split: r for r in cut.groupBy("split").agg(F.min("match_date").alias("a"), F.max("match_date").alias("b")).collect()}
    assert ends["train"].b < ends["validation"].a <= ends["validation"].b < ends["test"].a


def test_metrics_by_hand(spark):
    df = spark.createDataFrame([("H", 1.0, 0.0, 0.0), ("A", 0.5, 0.25, 0.25)], "ftr string, p_home double, p_draw double, p_away double")
    row = metrics.compute_metrics(df).first()
    assert (row.n_rows, row.accuracy) == (2, 0.5)
    assert row.brier == pytest.approx((0.25 + 0.0625 + 0.5625) / 2)
    assert row.log_loss == pytest.approx((-math.log(1 - metrics.EPS) - math.log(0.25)) / 2)
    cells = {(r.actual, r.predicted): r.n for r in metrics.confusion_matrix(df).collect()}
    assert len(cells) == 9 and cells[("H", "H")] == 1 and cells[("A", "H")] == 1 and sum(cells.values()) == 2


@pytest.fixture(scope="module")
def features(spark, enc):
    # Results follow the prices here, so that there is something to learn.
    real = enc.withColumn("ftr", F.when(F.col("odds_home") < 2.2, "H").when(F.col("odds_away") < 2.2, "A").otherwise("D"))
    return stage(build_features(real, "competition"), "test-features")


def test_train_publish_load(spark, features, tmp_path):
    root = str(tmp_path)
    model, report = train.train_and_publish(features, SEASONS, f"{root}/m", f"{root}/report", f"{root}/log", boosting=SHORT, max_iter=30)
    scores = report["validation_metrics"]
    best = min(("most_common", "logistic", "main_gb"), key=lambda n: scores[n]["log_loss"])
    assert scores["selected"]["name"] == best
    assert scores["logistic"]["log_loss"] < scores["most_common"]["log_loss"]
    loaded, meta = writers.load_model(spark, f"{root}/m")
    assert meta["class_order"] == ["H", "D", "A"] and meta["selected_model_name"] == best
    sample = models.prepare(features.filter("season = '1999-00'"))
    a, b = (m.transform(sample).orderBy("match_id").select(*metrics.PROBS).collect() for m in (model, loaded))
    assert a == b
    assert all(sum(r) == pytest.approx(1.0) for r in a)
    rows = {(r.split, r.season): r for r in train.evaluate_published(loaded, features, SEASONS).collect()}
    assert rows[("validation", "overall")].log_loss == pytest.approx(scores[best]["log_loss"])
    assert spark.read.parquet(f"{root}/log").first().line.startswith("ts=")


def test_calibration_is_never_worse_than_raw(spark, features, tmp_path):
    data = models.prepare(features)
    model = models.fit_boosted(data.filter("season < '1999-00'"), params=SHORT)
    best, rows = models.calibrate(model, data.filter("season = '1999-00'"), ("sigmoid", "isotonic"))
    by = {r["name"]: r["log_loss"] for r in rows}
    assert by[best.method] == min(by.values()) and set(by) == {"none", "sigmoid", "isotonic"}
    assert by[best.method] <= by["none"]
    root = str(tmp_path)
    for i, kept in enumerate((best, model)):
        writers.save_model(spark, kept, root, {}, f"v{i}")
        again, _ = writers.load_model(spark, root, f"v{i}")
        sample = data.filter("season = '2000-01'")
        a, b = (m.transform(sample).orderBy("match_id").select(*metrics.PROBS).collect() for m in (kept, again))
        assert a == b


def test_rolling_backtest_uses_only_earlier_seasons(features):
    seen = []

    def fit(df):
        seen.extend(r[1] for r in df.groupBy("fold").agg(F.max("season")).orderBy("fold").collect())
        return models.ConstantModel.fit_folds(df)

    rows = train.rolling_backtest(features, fit).collect()
    assert [r.train_up_to for r in rows] == seen
    want = {r.test_season: r for r in splits.frequency_backtest(features).collect()}
    for r in rows:
        for c in ("log_loss", "accuracy", "brier"):
            assert r[c] == pytest.approx(want[r.test_season][c])


def test_stages_live_in_the_shared_folder_and_can_be_dropped(spark, tmp_path, monkeypatch):
    from duelframe import session

    monkeypatch.setattr(session, "_STAGED", [])
    df = session.stage(spark.range(4), "t")
    assert df.count() == 4
    (path,) = session._STAGED
    assert path.startswith(spark.conf.get("spark.checkpoint.dir")) and readers.exists(spark, path)
    assert session.drop_stages(spark) == 1 and not readers.exists(spark, path)


def test_selection_ties():
    rows = [{"name": "a", "log_loss": 1.0, "f1": 0.5}, {"name": "b", "log_loss": 1.0, "f1": 0.5}, {"name": "c", "log_loss": 1.5, "f1": 0.6}]
    assert train.select(rows)["name"] == "a"
    assert train.select(rows, "f1", largest=True)["name"] == "c"


def test_writers(spark, enc, tmp_path):
    root = str(tmp_path)
    counts = {r.split: r.n_rows for r in writers.write_splits(enc, f"{root}/s", {"train": ["1994-95"]}).collect()}
    assert counts["train"] + counts["other"] == enc.count()
    writers.write_json(spark, {"b": 1, "a": {"y": [1.5], "x": "t"}}, f"{root}/j")
    assert spark.read.text(f"{root}/j").first().value == '{"a":{"x":"t","y":[1.5]},"b":1}'

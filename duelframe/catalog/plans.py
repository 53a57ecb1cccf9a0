"""Whole plans with their files: evaluation report, published predictions, and the two flat pipelines."""

from __future__ import annotations

from pyspark.sql import functions as F

from duelframe.catalog.aggregates import _METRICS_SQL, SEASONS, SPLIT_SQL
from duelframe.catalog.base import query
from duelframe.catalog.scalars import PREDICTED_SQL
from duelframe.catalog.testbed import encounters, stored, with_enc
from duelframe.operators import models, splits
from duelframe.plans import flat, publish
from duelframe.session import stage, stage_path
from duelframe.sources import writers

_FREQUENCIES = f"""frq as (select avg(case when ftr = 'H' then 1.0e0 else 0 end) as p_home, avg(case when ftr = 'D' then 1.0e0 else 0 end) as p_draw,
  avg(case when ftr = 'A' then 1.0e0 else 0 end) as p_away from enc where {SPLIT_SQL} = 'train'),
src as (select enc.*, {SPLIT_SQL} as split, p_home, p_draw, p_away from enc, frq)"""


def _published_frequencies(spark, enc) -> str:
    """The class frequencies of train rows as a published model: its numbers have a SQL form."""
    root = stage_path(spark, "published")
    train = enc.filter(splits.season_split("season", SEASONS) == "train")
    writers.save_model(spark, models.ConstantModel.fit(train), root, {"selected_model_name": "most_common", "trained_at": "v1"}, "v1")
    return root


@query(
    "T04_evaluation_report",
    with_enc(
        f"""select 'validation' as part, 'overall' as season, {_METRICS_SQL} from src where split = 'validation'
union all select 'test', 'overall', {_METRICS_SQL} from src where split = 'test'
union all select split, season, {_METRICS_SQL} from src where split in ('validation', 'test') group by split, season
union all select 'backtest', test_season, {_METRICS_SQL} from bts group by test_season
union all select 'log', season, cast(null as bigint), log_loss, accuracy, brier from (select 'test' as season, {_METRICS_SQL} from src where split = 'test')""",
        _FREQUENCIES
        + """,
ss as (select season, lag(season) over (order by season) as train_up_to from (select distinct season from enc)),
bfr as (select ss.season as test_season, avg(case when e.ftr = 'H' then 1.0e0 else 0 end) as p_home, avg(case when e.ftr = 'D' then 1.0e0 else 0 end) as p_draw,
  avg(case when e.ftr = 'A' then 1.0e0 else 0 end) as p_away from ss join enc e on e.season < ss.season group by ss.season),
bts as (select bfr.*, e.ftr from bfr join enc e on e.season = bfr.test_season)""",
    ),
)
def evaluation_report(spark, sf):
    """The report and the log line of the evaluation plan, read back from their files."""
    enc = stored(spark, sf)
    # Only the model's own inputs are missing here: class frequencies need none.
    features = stage(enc.withColumns({c: F.lit(None).cast("double") for c in models.FEATURES}), "evaluated-features")
    root = stage_path(spark, "evaluation")
    publish.evaluate_and_report(features, SEASONS, _published_frequencies(spark, enc), f"{root}/report", f"{root}/log", models.ConstantModel.fit_folds)
    report = spark.read.json(f"{root}/report/evaluation_report")
    names = ("n_rows", "log_loss", "accuracy", "brier")
    out = report.select(F.lit("backtest").alias("part"), F.explode("rolling_backtest").alias("e")).select("part", F.col("e.test_season").alias("season"), *(f"e.{n}" for n in names))
    for part in ("validation", "test"):
        seasons = report.select(f"{part}.by_season.*").columns
        for season, path in (("overall", f"{part}.overall"), *((s, f"{part}.by_season.`{s}`") for s in seasons)):
            out = out.unionByName(report.select(F.lit(part).alias("part"), F.lit(season).alias("season"), *(F.col(f"{path}.{n}").alias(n) for n in names)))
    line = spark.read.parquet(f"{root}/log").select("payload")
    logged = [F.col("payload")[f"test_{n}"].cast("double").alias(n) for n in names[1:]]
    out = out.unionByName(line.select(F.lit("log").alias("part"), F.lit("test").alias("season"), F.lit(None).cast("long").alias("n_rows"), *logged))
    return out.withColumns({c: F.round(c, 9) for c in ("log_loss", "brier")})


@query(
    "M08_S12_published_predictions",
    with_enc(f"select match_id, match_date, home_team, away_team, round(p_home, 9) as P_home, round(p_draw, 9) as P_draw, round(p_away, 9) as P_away, {PREDICTED_SQL} as predicted_outcome, 'v1' as model_version from src", _FREQUENCIES),
)
def published_predictions(spark, sf):
    enc = stored(spark, sf)
    root = stage_path(spark, "predictions")
    asked = enc.select("match_id", "match_date", "home_team", "away_team", "odds_home", "odds_draw", "odds_away")
    back = publish.predict_and_publish(enc, asked, _published_frequencies(spark, enc), f"{root}/csv", f"{root}/log", "competition", keep=("match_id",))
    return back.withColumns({c: F.round(c, 9) for c in ("P_home", "P_draw", "P_away")})


def _stats(spark, sf):
    """The flat statistics layout: shots from the line items, corners and fouls as numbers of the key."""
    enc = encounters(spark, sf, with_shots=True)
    key = F.col("match_id")
    out = enc.withColumnsRenamed({"home_sot": "home_shots_on_target", "away_sot": "away_shots_on_target", "match_date": "date", "ftr": "result"})
    numbers = {n: (key % m + 2).cast("int") for n, m in (("home_corners", 10), ("away_corners", 9), ("home_fouls", 8), ("away_fouls", 7))}
    return stage(out.withColumns(numbers), "flat-stats")


def _in_range():
    return (F.col("accuracy").between(0, 1) & F.col("f1").between(0, 1)).alias("in_range")


@query(
    "M05_M06_season_pipeline",
    with_enc(
        """select model, split, n_rows, true as in_range, case when model = 'rf' and split = 'test' then n_rows end as n_reported from (
select case when left(season, 4) = '1999' then 'validation' else 'test' end as split, cast(count(*) as bigint) as n_rows from enc where left(season, 4) >= '1999' group by 1),
(values ('lr'), ('rf')) m(model)"""
    ),
)
def season_pipeline(spark, sf):
    path = stage_path(spark, "flat")
    rows = flat.run_by_season(_stats(spark, sf), path, 1998, 1999)
    reported = spark.read.csv(f"{path}/report", header=True).agg(F.count("*").alias("n")).withColumns({"model": F.lit("rf"), "split": F.lit("test")})
    return rows.join(reported, ["model", "split"], "left").select("model", "split", "n_rows", _in_range(), F.col("n").alias("n_reported"))


@query(
    "M07_share_pipeline",
    with_enc(
        """select model, split, n_rows, true as in_range, 1 as n_chosen, case when split = 'test' then n_rows end as n_reported from (
select case when s < 0.6e0 then 'validation' else 'test' end as split, cast(count(*) as bigint) as n_rows from enc join dd using (match_date) where s >= 0.5e0 group by 1),
(values ('lr'), ('rf')) m(model)""",
        """dc as (select match_date, count(*) as c from enc group by match_date),
dd as (select match_date, coalesce(sum(c) over (order by match_date rows between unbounded preceding and 1 preceding), 0) / cast(sum(c) over () as double) as s from dc)""",
    ),
)
def share_pipeline(spark, sf):
    path = stage_path(spark, "flat")
    rows = flat.run_by_share(_stats(spark, sf), path, run_date="2024-01-01")
    reported = spark.read.csv(f"{path}/predictions_report", header=True).agg(F.count("*").alias("n")).withColumn("split", F.lit("test"))
    chosen = rows.groupBy("split").agg(F.count_if("chosen").cast("int").alias("n_chosen"))
    return rows.join(reported, "split", "left").join(chosen, "split").select("model", "split", "n_rows", _in_range(), "n_chosen", F.col("n").alias("n_reported"))

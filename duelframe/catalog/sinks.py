"""Writers: every sink is written from the derived encounters and read back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from duelframe.catalog.aggregates import SEASONS, SPLIT_SQL
from duelframe.catalog.base import query
from duelframe.catalog.ordering import CANDIDATES_SQL, candidates
from duelframe.catalog.scalars import IMPLIED_SQL, PREDICTED_SQL, with_probabilities
from duelframe.catalog.testbed import encounters, with_enc
from duelframe.catalog.windows import FEATURES_SQL, RATED
from duelframe.functions import scalars as S
from duelframe.operators import metrics
from duelframe.plans import features as features_plan
from duelframe.session import stage_path
from duelframe.sources import writers


@query(
    "S10_write_splits",
    with_enc(f"select coalesce({SPLIT_SQL}, 'other') as split, match_id, season, ftr from enc"),
)
def write_splits(spark, sf):
    path = stage_path(spark, "splits")
    writers.write_splits(encounters(spark, sf).select("match_id", "season", "ftr"), path, SEASONS)
    return spark.read.parquet(path).select("split", "match_id", "season", "ftr")


@query("S10_split_counts", with_enc(f"select {SPLIT_SQL} as split, cast(count(*) as bigint) as n_rows from enc group by 1"))
def write_split_counts(spark, sf):
    return writers.write_splits(encounters(spark, sf).select("match_id", "season"), stage_path(spark, "splits"), SEASONS)


@query("S11_write_feature_table", FEATURES_SQL)
def write_features(spark, sf):
    """All columns of the written table, read back."""
    path = stage_path(spark, "features")
    features = features_plan.build_features(encounters(spark, sf), "competition")
    writers.write_table(features, path, ["season"])
    back = spark.read.parquet(path).select(*features.columns)
    return back.withColumns({c: F.round(c, 4) for c in RATED})


_PREDICTIONS = "match_date date, home_team long, away_team long, P_home double, P_draw double, P_away double, predicted_outcome string, model_version string"


@query(
    "S12_write_predictions",
    with_enc(
        f"select match_date, home_team, away_team, p_home as P_home, p_draw as P_draw, p_away as P_away, {PREDICTED_SQL} as predicted_outcome, 'prices' as model_version from prob",
        IMPLIED_SQL,
    ),
)
def write_predictions(spark, sf):
    path = stage_path(spark, "predictions")
    writers.write_csv(
        with_probabilities(encounters(spark, sf)).select(
            "match_date",
            "home_team",
            "away_team",
            F.col("p_home").alias("P_home"),
            F.col("p_draw").alias("P_draw"),
            F.col("p_away").alias("P_away"),
            S.predicted_label("p_home", "p_draw", "p_away").alias("predicted_outcome"),
            F.lit("prices").alias("model_version"),
        ),
        path,
    )
    return spark.read.schema(_PREDICTIONS).csv(path, header=True)


@query(
    "S13_match_report",
    with_enc(
        f"select season, match_date as date, home_team, away_team, ftr as result, cast(case {PREDICTED_SQL} when 'H' then 2 when 'D' then 1 else 0 end as integer) as predicted from prob",
        IMPLIED_SQL,
    ),
)
def match_report(spark, sf):
    path = stage_path(spark, "report")
    prob = with_probabilities(encounters(spark, sf))
    label = S.predicted_label("p_home", "p_draw", "p_away")
    writers.write_csv(
        prob.select(
            "season",
            F.col("match_date").alias("date"),
            "home_team",
            "away_team",
            F.col("ftr").alias("result"),
            S.descending_target(label).alias("predicted"),
        ),
        path,
    )
    schema = "season string, date date, home_team long, away_team long, result string, predicted int"
    return spark.read.schema(schema).csv(path, header=True)


@query(
    "S14_dated_metrics",
    with_enc(
        f"select cast('2001-08-31' as date) as run_date, model, cast(count(*) as bigint) as n_rows, avg(case when {PREDICTED_SQL} = ftr then 1.0e0 else 0.0e0 end) as accuracy from cand group by model",
        CANDIDATES_SQL,
    ),
)
def dated_metrics(spark, sf):
    path = stage_path(spark, "metrics")
    rows = metrics.compute_metrics(candidates(spark, sf), ["model"]).select("model", "n_rows", "accuracy")
    writers.write_small_csv(rows, path, "2001-08-31")
    read = spark.read.schema("model string, n_rows long, accuracy double, run_date date").csv(path, header=True)
    return read.select("run_date", "model", "n_rows", "accuracy")


@query(
    "S15_json_report",
    with_enc(
        f"""select cast(count(*) as bigint) as n_rows, cast(count(*) filter (where {SPLIT_SQL} = 'train') as bigint) as train,
  cast(count(*) filter (where {SPLIT_SQL} = 'test') as bigint) as test, avg(case when {PREDICTED_SQL} = ftr then 1.0e0 else 0.0e0 end) as accuracy from prob""",
        IMPLIED_SQL,
    ),
)
def json_report(spark, sf):
    path = stage_path(spark, "json-report")
    prob = with_probabilities(encounters(spark, sf))
    by_season = metrics.compute_metrics(prob, ["season"]).collect()  # one row per season
    split_of = {s: name for name, seasons in SEASONS.items() for s in seasons}
    counts = {name: sum(r["n_rows"] for r in by_season if split_of.get(r["season"]) == name) for name in SEASONS}
    overall = metrics.compute_metrics(prob).first()
    report = {
        "n_rows": overall["n_rows"],
        "split_counts": counts,
        "metrics": {"overall": {k: overall[k] for k in ("accuracy", "brier", "log_loss")}},
    }
    writers.write_json(spark, report, path)
    return spark.read.json(path).select(
        "n_rows",
        F.col("split_counts.train").alias("train"),
        F.col("split_counts.test").alias("test"),
        F.col("metrics.overall.accuracy").alias("accuracy"),
    )


@query(
    "S16_run_log",
    with_enc(
        "select 'evaluate' as event, printf('ts=2001-08-31T00:00:00Z | event=evaluate | model=prices | n_rows=%d | val_share=%.6f', count(*), avg(case when ftr = 'H' then 1.0e0 else 0.0e0 end)) as line from enc"
        " union all select 'train', printf('ts=2001-08-31T00:00:00Z | event=train | n_rows=%d', count(*)) from enc"
    ),
)
def run_log(spark, sf):
    path = stage_path(spark, "run-log")
    row = encounters(spark, sf).agg(F.count("*").alias("n"), F.avg(S.home_win_target("ftr").cast("double")).alias("share")).first()
    at = dt.datetime(2001, 8, 31, tzinfo=dt.timezone.utc)
    writers.append_run_log(spark, path, "evaluate", {"val_share": row["share"], "n_rows": row["n"], "model": "prices"}, at)
    writers.append_run_log(spark, path, "train", {"n_rows": row["n"]}, at)
    return spark.read.parquet(path).select("event", "line")


@query(
    "S16_log_lines",
    with_enc(
        "select match_id, printf('ts=%sT00:00:00Z | event=match | goals=%d | odds=%.6f', strftime(match_date, '%Y-%m-%d'), home_goals + away_goals, odds_away) as line from enc"
    ),
)
def log_lines(spark, sf):
    ts = F.concat(S.iso_day("match_date"), F.lit("T00:00:00Z"))
    fields = {"odds": (F.col("odds_away"), True), "goals": (F.col("home_goals") + F.col("away_goals"), False)}
    return encounters(spark, sf).select("match_id", S.log_line(ts, F.lit("match"), fields).alias("line"))

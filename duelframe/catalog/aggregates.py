"""Metrics, statistics, splits and the frequency backtest."""

from __future__ import annotations

from pyspark.sql import functions as F

from duelframe.catalog.base import query
from duelframe.catalog.ordering import CANDIDATES_SQL, F1_SQL, ROW_LOSS_SQL, candidates
from duelframe.catalog.scalars import IMPLIED_SQL, PREDICTED_SQL, raw_sql, typed_rows, with_probabilities
from duelframe.catalog.scalars import TYPED_SQL
from duelframe.catalog.testbed import encounters, stored, with_enc
from duelframe.operators import clean, metrics, models, splits

# Season lists used by every split of the derived encounters.
SEASONS = {
    "train": ("1994-95", "1995-96", "1996-97", "1997-98", "1998-99"),
    "validation": ("1999-00",),
    "test": ("2000-01", "2001-02"),
}
SPLIT_SQL = (
    "case when season in ('1994-95', '1995-96', '1996-97', '1997-98', '1998-99') then 'train'"
    " when season = '1999-00' then 'validation' when season in ('2000-01', '2001-02') then 'test' end"
)
_METRICS_SQL = f"""cast(count(*) as bigint) as n_rows, round(avg({ROW_LOSS_SQL}), 9) as log_loss,
  avg(case when {PREDICTED_SQL} = ftr then 1.0e0 else 0.0e0 end) as accuracy,
  round(avg(power(p_home - case ftr when 'H' then 1 else 0 end, 2) + power(p_draw - case ftr when 'D' then 1 else 0 end, 2)
    + power(p_away - case ftr when 'A' then 1 else 0 end, 2)), 9) as brier"""


def _round9(df):
    return df.withColumns({c: F.round(c, 9) for c in ("log_loss", "brier")})


def probabilities(spark, sf):
    return with_probabilities(encounters(spark, sf))


@query(
    "A01_class_frequencies",
    with_enc(
        ", ".join(f"avg(case when ftr = '{c}' then 1.0e0 else 0.0e0 end) as {p}" for c, p in zip("HDA", metrics.PROBS)).join(
            ("select ", " from enc")
        )
    ),
)
def class_frequencies(spark, sf):
    return metrics.class_frequencies(encounters(spark, sf))


@query("A02_A03_A04_metrics", with_enc(f"select {_METRICS_SQL} from prob", IMPLIED_SQL))
def overall_metrics(spark, sf):
    return _round9(metrics.compute_metrics(probabilities(spark, sf)))


@query(
    "A05_confusion_matrix",
    with_enc(
        f"""select a as actual, p as predicted, cast(count(*) filter (where ftr = a and {PREDICTED_SQL} = p) as bigint) as n
from prob, (values ('H'), ('D'), ('A')) x(a), (values ('H'), ('D'), ('A')) y(p) group by a, p""",
        IMPLIED_SQL,
    ),
)
def confusion_matrix(spark, sf):
    return metrics.confusion_matrix(probabilities(spark, sf))


@query(
    "A06_metrics_by_season",
    with_enc(
        f"""select season, cast(split_part(season, '-', 1) as integer) as start_year, {_METRICS_SQL} from prob group by season
union all select 'overall', -1, {_METRICS_SQL} from prob""",
        IMPLIED_SQL,
    ),
)
def metrics_by_season(spark, sf):
    return _round9(metrics.metrics_by_season(probabilities(spark, sf))).orderBy("start_year")


@query(
    "A07_calibration_curve",
    with_enc(
        "select class, "
        + "cast("
        + " + ".join(f"cast(e{i} < p as integer)" for i in range(1, 10))
        + " as integer) as bin, cast(count(*) as bigint) as n_rows, avg(hit * 1.0e0) as observed, round(avg(p), 9) as mean_predicted"
        + " from one join edg using (class) group by 1, 2",
        IMPLIED_SQL
        + """,
one as (select 'H' as class, p_home as p, cast(ftr = 'H' as integer) as hit from prob
  union all select 'D', p_draw, cast(ftr = 'D' as integer) from prob union all select 'A', p_away, cast(ftr = 'A' as integer) from prob),
rnk as (select class, p, row_number() over (partition by class order by p) - 1 as r, count(*) over (partition by class) as n from one),
edg as (select class, """
        + ", ".join(
            f"min(case when r = floor((n - 1) * {i / 10}e0) then p end)"
            f" + (min(case when r = least(floor((n - 1) * {i / 10}e0) + 1, n - 1) then p end) - min(case when r = floor((n - 1) * {i / 10}e0) then p end))"
            f" * ((any_value(n) - 1) * {i / 10}e0 - floor((any_value(n) - 1) * {i / 10}e0)) as e{i}"
            for i in range(1, 10)
        )
        + " from rnk group by class)",
    ),
)
def calibration_curve(spark, sf):
    return metrics.calibration_curve(probabilities(spark, sf)).withColumn("mean_predicted", F.round("mean_predicted", 9))


_REPORT_SQL = f"""pred as (select *, {PREDICTED_SQL} as predicted from src),
cls as (select g, c, cast(count(*) filter (where ftr = c and predicted = c) as double) as tp,
   cast(count(*) filter (where ftr = c) as double) as act, cast(count(*) filter (where predicted = c) as double) as prd
   from pred, (values ('H'), ('D'), ('A')) k(c) group by g, c),
pr as (select *, case when prd = 0 then 0 else tp / prd end as pre, case when act = 0 then 0 else tp / act end as rec from cls),
rep as (select g, cast(sum(act) as bigint) as n_rows, sum(tp) / sum(act) as accuracy, sum(pre) / 3 as precision, sum(rec) / 3 as recall,
   sum(case when pre + rec = 0 then 0 else 2 * pre * rec / (pre + rec) end) / 3 as f1_score,
   sum(act * case when pre + rec = 0 then 0 else 2 * pre * rec / (pre + rec) end) / sum(act) as weighted_f1 from pr group by g)"""


@query(
    "A08_accuracy_and_f1",
    with_enc(
        "select n_rows, " + ", ".join(f"round({c}, 9) as {c}" for c in ("accuracy", "weighted_f1", "precision", "recall", "f1_score")) + " from rep",
        f"{IMPLIED_SQL},\nsrc as (select *, 1 as g from prob),\n{_REPORT_SQL}",
    ),
)
def accuracy_and_f1(spark, sf):
    out = metrics.classification_report(probabilities(spark, sf))
    return out.select("n_rows", *[F.round(c, 9).alias(c) for c in ("accuracy", "weighted_f1", "precision", "recall", "f1_score")])


@query(
    "A09_invalid_row_counts",
    raw_sql(
        "select cast((select count(*) from typed) as bigint) as n_rows, cast((select count(*) from valid) as bigint) as n_valid,"
        " cast((select count(*) from typed) - (select count(*) from valid) as bigint) as n_invalid",
        f",\n{TYPED_SQL}",
    ),
)
def invalid_counts(spark, sf):
    return clean.invalid_row_counts(typed_rows(spark, sf))


@query(
    "A10_content_hash",
    with_enc(
        "select cast(count(*) as bigint) as n_rows, cast(sum(cast(concat('0x', substring(md5(concat(season, '|', match_date, '|', home_team, '|', away_team, '|', ftr)), 1, 15)) as hugeint)) as varchar) as digest_sum from enc"
    ),
)
def content_hash(spark, sf):
    return metrics.content_hash(encounters(spark, sf), ["season", "match_date", "home_team", "away_team", "ftr"])


_STATS = ("odds_home", "odds_draw", "odds_away", "home_goals", "home_shots")


@query(
    "A11_medians",
    with_enc(
        " union all ".join(
            f"select '{c}' as feature, median({c} * 1.0e0) as median, cast(count({c}) as bigint) as n from enc" for c in _STATS
        )
    ),
)
def medians(spark, sf):
    enc = encounters(spark, sf, with_shots=True)
    return metrics.feature_medians(enc.select(*[F.col(c).cast("double").alias(c) for c in _STATS]), _STATS)


@query(
    "A12_moments",
    with_enc(
        " union all ".join(
            f"select '{c}' as feature, round(avg({c}), 9) as mean, round(stddev_pop({c}), 9) as std_pop, round(stddev_samp({c}), 9) as std_samp from enc"
            for c in _STATS
        )
    ),
)
def moments(spark, sf):
    out = metrics.feature_moments(encounters(spark, sf, with_shots=True), _STATS)
    return out.select("feature", *[F.round(c, 9).alias(c) for c in ("mean", "std_pop", "std_samp")])


@query(
    "A12_standardise",
    with_enc(
        "select match_id, round((odds_draw - (select avg(odds_draw) from enc)) / (select stddev_pop(odds_draw) from enc), 6) as odds_draw,"
        " round((odds_away - (select avg(odds_away) from enc)) / (select stddev_pop(odds_away) from enc), 6) as odds_away from enc"
    ),
)
def standardise(spark, sf):
    enc = stored(spark, sf)
    columns = ["odds_draw", "odds_away"]
    # One fitted row per named column comes back, whatever the size of the table.
    fitted = {r["feature"]: (r["mean"], r["std_pop"]) for r in metrics.feature_moments(enc, columns).collect()}
    out = metrics.standardise(enc.select("match_id", *columns), columns, fitted)
    return out.select("match_id", *[F.round(c, 6).alias(c) for c in columns])


@query(
    "A13_weekly_report",
    with_enc(
        """select g[1] as week, cast('2001-08-31' as date) as run_date, g[2] as model, round(accuracy, 4) as accuracy, round(precision, 4) as precision,
  round(recall, 4) as recall, round(f1_score, 4) as f1_score, n_rows as matches_scored from rep""",
        f"{CANDIDATES_SQL},\nsrc as (select *, [concat('W', weekofyear(match_date), '-', year(match_date)), model] as g from cand),\n{_REPORT_SQL}",
    ),
)
def weekly_report(spark, sf):
    return metrics.weekly_report(candidates(spark, sf), run_date=F.to_date(F.lit("2001-08-31")))


@query(
    "T01_A09_season_split_counts",
    with_enc(f"select {SPLIT_SQL} as split, cast(count(*) as bigint) as n_rows from enc group by 1"),
)
def season_split(spark, sf):
    split = encounters(spark, sf).withColumn("split", splits.season_split("season", SEASONS))
    return splits.split_counts(split)


@query(
    "T02_year_split",
    with_enc(
        "select match_id, case when y <= 1998 then 'train' when y = 1999 then 'validation' else 'test' end as split"
        " from (select match_id, cast(split_part(season, '-', 1) as integer) as y from enc)"
    ),
)
def year_split(spark, sf):
    from duelframe.functions.scalars import season_start_year

    return encounters(spark, sf).select("match_id", splits.year_split(season_start_year("season"), 1998, 1999).alias("split"))


@query(
    "T03_fraction_split",
    with_enc(
        "select match_id, case when s < 0.5e0 then 'train' when s < 0.6e0 then 'validation' else 'test' end as split from enc join dd using (match_date)",
        """dc as (select match_date, count(*) as c from enc group by match_date),
dd as (select match_date, coalesce(sum(c) over (order by match_date rows between unbounded preceding and 1 preceding), 0) / cast(sum(c) over () as double) as s from dc)""",
    ),
)
def fraction_split(spark, sf):
    return splits.fraction_split(stored(spark, sf), "match_date").select("match_id", "split")


@query(
    "T04_folds",
    with_enc(
        "select * from (select season as train_up_to, lead(season) over (order by season) as test_season,"
        " cast(row_number() over (order by season) as integer) as fold from (select distinct season from enc)) t where test_season is not null"
    ),
)
def folds(spark, sf):
    return splits.folds(encounters(spark, sf))


@query(
    "T04_A01_frequency_backtest",
    with_enc(
        f"select train_up_to, test_season, {_METRICS_SQL} from src group by train_up_to, test_season",
        """ss as (select season, lag(season) over (order by season) as train_up_to from (select distinct season from enc)),
frq as (select ss.season as test_season, ss.train_up_to, avg(case when e.ftr = 'H' then 1.0e0 else 0 end) as p_home,
   avg(case when e.ftr = 'D' then 1.0e0 else 0 end) as p_draw, avg(case when e.ftr = 'A' then 1.0e0 else 0 end) as p_away
   from ss join enc e on e.season < ss.season group by ss.season, ss.train_up_to),
src as (select frq.*, e.ftr from frq join enc e on e.season = frq.test_season)""",
    ),
)
def frequency_backtest(spark, sf):
    return _round9(splits.frequency_backtest(encounters(spark, sf)))


@query(
    "M01_constant_predictions",
    with_enc(
        "select match_id, p_home, p_draw, p_away, "
        + PREDICTED_SQL
        + " as predicted from enc, (select avg(case when ftr = 'H' then 1.0e0 else 0 end) as p_home,"
        " avg(case when ftr = 'D' then 1.0e0 else 0 end) as p_draw, avg(case when ftr = 'A' then 1.0e0 else 0 end) as p_away"
        f" from enc where {SPLIT_SQL} = 'train') where {SPLIT_SQL} = 'validation'"
    ),
)
def constant_predictions(spark, sf):
    from duelframe.functions.scalars import predicted_label

    enc = stored(spark, sf).withColumn("split", splits.season_split("season", SEASONS))
    model = models.ConstantModel.fit(enc.filter("split = 'train'"))
    out = model.transform(enc.filter("split = 'validation'"))
    return out.select("match_id", *metrics.PROBS, predicted_label(*metrics.PROBS).alias("predicted"))

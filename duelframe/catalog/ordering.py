"""Deduplication, numbering, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from duelframe.catalog.base import query
from duelframe.catalog.scalars import IMPLIED_SQL, PREDICTED_SQL, with_probabilities
from duelframe.catalog.testbed import encounters, with_enc
from duelframe.operators import clean, metrics, registry, splits
from duelframe.session import stage

_COPIES_SQL = """cop as (
  select season, match_date, home_team, away_team, match_id, c as copy, home_goals + c as home_goals
  from enc, (values (0), (1), (2)) v(c) where c <= match_id % 3)"""


def _copies(spark, sf):
    copies = F.explode(F.sequence(F.lit(0), (F.col("match_id") % 3).cast("int"))).alias("copy")
    return encounters(spark, sf).select("season", "match_date", "home_team", "away_team", "match_id", "home_goals", copies).withColumn(
        "home_goals", F.col("home_goals") + F.col("copy")
    )


@query(
    "P09_first_per_key",
    with_enc(
        "select season, match_date, home_team, away_team, match_id, copy, home_goals from (select *, row_number() over"
        " (partition by season, match_date, home_team, away_team order by copy desc, match_id) as rn from cop) where rn = 1",
        _COPIES_SQL,
    ),
)
def first_per_key(spark, sf):
    return clean.first_per_key(_copies(spark, sf), clean.KEY, [F.desc("copy"), "match_id"])


@query(
    "P09_duplicate_counts",
    with_enc(
        "select cast(count(*) as bigint) as n_rows, cast(count(distinct (season, match_date, home_team, away_team)) as bigint) as n_kept,"
        " cast(count(*) - count(distinct (season, match_date, home_team, away_team)) as bigint) as n_dropped from cop",
        _COPIES_SQL,
    ),
)
def duplicate_counts(spark, sf):
    return clean.duplicate_count(_copies(spark, sf))


@query(
    "P10_dense_ids",
    with_enc(
        "select row_number() over (order by match_date, home_team, away_team) as match_id, season, home_team, away_team, ftr from enc"
    ),
)
def dense_ids(spark, sf):
    return clean.number_matches(encounters(spark, sf)).select("match_id", "season", "home_team", "away_team", "ftr")


@query(
    "O01_chronological_order",
    with_enc("select match_id, match_date, home_team, away_team from enc order by match_date, home_team, away_team"),
)
def chronological(spark, sf):
    return (
        encounters(spark, sf)
        .orderBy("match_datetime", "home_team", "away_team")
        .select("match_id", "match_date", "home_team", "away_team")
    )


# Three candidate models per match: normalised prices, one third each, always home.
CANDIDATES_SQL = f"""{IMPLIED_SQL},
cand as (
  select match_id, season, match_date, ftr, 'prices' as model, 0 as ordinal, p_home, p_draw, p_away from prob
  union all select match_id, season, match_date, ftr, 'uniform', 1, 1.0e0 / 3, 1.0e0 / 3, 1.0e0 / 3 from prob
  union all select match_id, season, match_date, ftr, 'home', 2, 0.5e0, 0.2e0, 0.3e0 from prob)"""

ROW_LOSS_SQL = "-ln(greatest(least(case ftr when 'H' then p_home when 'D' then p_draw else p_away end, 1 - 2.220446049250313e-16), 2.220446049250313e-16))"


def candidates(spark, sf):
    prob = with_probabilities(encounters(spark, sf))
    third = F.lit(1.0 / 3)
    rows = [("prices", 0, "p_home", "p_draw", "p_away"), ("uniform", 1, third, third, third), ("home", 2, F.lit(0.5), F.lit(0.2), F.lit(0.3))]
    structs = [
        F.struct(
            F.lit(m).alias("model"),
            F.lit(o).alias("ordinal"),
            *[(F.col(c) if isinstance(c, str) else c).alias(n) for c, n in zip(p, metrics.PROBS)],
        )
        for m, o, *p in rows
    ]
    return prob.select("match_id", "season", "match_date", "ftr", F.explode(F.array(*structs)).alias("e")).select(
        "match_id", "season", "match_date", "ftr", "e.*"
    )


@query(
    "O03_lowest_log_loss",
    with_enc(
        f"select model, round(avg({ROW_LOSS_SQL}), 9) as log_loss from cand group by model, ordinal order by avg({ROW_LOSS_SQL}), ordinal limit 1",
        CANDIDATES_SQL,
    ),
)
def lowest_log_loss(spark, sf):
    rows = metrics.compute_metrics(candidates(spark, sf), ["model", "ordinal"])
    return registry.best_candidate(rows, F.col("log_loss")).select("model", F.round("log_loss", 9).alias("log_loss"))


@query(
    "O03_lowest_log_loss_per_season",
    with_enc(
        f"""select season, arg_min(model, (loss, ordinal)) as selected from (
        select season, model, ordinal, avg({ROW_LOSS_SQL}) as loss from cand group by season, model, ordinal) group by season""",
        CANDIDATES_SQL,
    ),
)
def lowest_log_loss_per_season(spark, sf):
    rows = metrics.compute_metrics(candidates(spark, sf), ["season", "model", "ordinal"])
    return registry.best_per_group(rows, "season", F.col("log_loss"), "model")


F1_SQL = f"""pred as (select *, {PREDICTED_SQL} as predicted from cand),
cls as (select model, ordinal, season, c, cast(count(*) filter (where ftr = c and predicted = c) as double) as tp,
          cast(count(*) filter (where ftr = c) as double) as act, cast(count(*) filter (where predicted = c) as double) as prd
        from pred, (values ('H'), ('D'), ('A')) k(c) group by model, ordinal, season, c),
f1 as (select model, ordinal, season, sum(act * case when tp = 0 then 0 else 2 * (tp / prd) * (tp / act) / (tp / prd + tp / act) end) / sum(act) as wf1
       from cls group by model, ordinal, season)"""


@query(
    "O04_highest_validation_f1",
    with_enc(
        "select model, round(wf1, 9) as weighted_f1 from f1 where season = '1999-00' order by wf1 desc, ordinal limit 1",
        f"{CANDIDATES_SQL},\n{F1_SQL}",
    ),
)
def highest_f1(spark, sf):
    rows = metrics.classification_report(candidates(spark, sf).filter("season = '1999-00'"), ["model", "ordinal"])
    return registry.best_candidate(rows, -F.col("weighted_f1")).select("model", F.round("weighted_f1", 9).alias("weighted_f1"))


@query(
    "U01_concatenate_seasons",
    with_enc(
        """select match_id, season, case cast(left(season, 4) as integer) % 3 when 0 then odds_home end as odds_home,
  case cast(left(season, 4) as integer) % 3 when 1 then odds_draw end as odds_draw,
  case cast(left(season, 4) as integer) % 3 when 2 then odds_away end as odds_away from enc"""
    ),
)
def concatenate(spark, sf):
    """All seasons, each a table of its own with one of three sets of columns in an order of its own."""
    enc = stage(encounters(spark, sf), "seasons")
    out = None
    for r in enc.select("season").distinct().orderBy("season").collect():  # seasons are few
        odds = ("odds_home", "odds_draw", "odds_away")[int(r.season[:4]) % 3]
        one = enc.filter(F.col("season") == r.season).select("season", odds, "match_id")
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out.select("match_id", "season", "odds_home", "odds_draw", "odds_away")


@query("U02_entity_universe", with_enc("select home_team as name from enc union select away_team from enc"))
def universe(spark, sf):
    return registry.entity_universe(encounters(spark, sf))


@query(
    "U03_numbered_universe",
    with_enc(
        "select row_number() over (order by name) as id, name from (select home_team as name from enc union select away_team from enc)"
    ),
)
def numbered_universe(spark, sf):
    return registry.numbered_universe(encounters(spark, sf))


@query("U04_seasons_in_order", with_enc("select distinct season as label from enc order by label"))
def seasons(spark, sf):
    return registry.seasons_in_order(encounters(spark, sf))


@query(
    "A14_dates_and_bounds",
    with_enc(
        "select match_date, cast(count(*) as bigint) as n_matches, match_date = (select min(match_date) from enc) as is_first,"
        " match_date = (select max(match_date) from enc) as is_last from enc group by match_date"
    ),
)
def date_bounds(spark, sf):
    return splits.dates_and_bounds(encounters(spark, sf))

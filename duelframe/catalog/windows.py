"""Form, rest, ratings, rounds, guard and the feature tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from duelframe.catalog.base import query
from duelframe.catalog.scalars import IMPLIED_SQL
from duelframe.catalog.testbed import encounters, stored, table, with_enc
from duelframe.functions import scalars as S
from duelframe.operators import asof, elo, form, guard, longform, rounds, snapshot
from duelframe.plans import features as features_plan
from duelframe.plans import fixtures as fixtures_plan
from duelframe.schema import FEATURES
from duelframe.session import stage

LONG_SQL = """lng as (
  select match_id, match_date, home_team, away_team, home_team as team, away_team as opponent, true as is_home,
         case ftr when 'H' then 3.0e0 when 'D' then 1.0e0 else 0.0e0 end as points,
         home_goals * 1.0e0 as goals_for, away_goals * 1.0e0 as goals_against, (home_goals - away_goals) * 1.0e0 as goal_diff from enc
  union all
  select match_id, match_date, home_team, away_team, away_team, home_team, false,
         case ftr when 'A' then 3.0e0 when 'D' then 1.0e0 else 0.0e0 end,
         away_goals * 1.0e0, home_goals * 1.0e0, (away_goals - home_goals) * 1.0e0 from enc)"""

_PRIOR = {"points": "1.35e0", "goal_diff": "0.0e0", "goals_for": "1.35e0", "goals_against": "1.35e0"}
_W = "partition by team order by match_date, match_id"
FORM_SQL = (
    LONG_SQL
    + ",\nfrm as (select *, "
    + ", ".join(
        f"coalesce(avg({f}) over ({_W} rows between {n} preceding and 1 preceding), {_PRIOR[f]}) as {name}"
        for name, (f, n) in form.FORM_STATS.items()
    )
    + ", coalesce(avg(points) over (partition by team, is_home order by match_date, match_id rows between 5 preceding and 1 preceding), 1.35e0) as venue_points"
    + f", coalesce(cast(date_diff('day', lag(match_date) over ({_W}), match_date) as double), 7.0e0) as rest_days from lng),\n"
    + "sid as (select match_id, "
    + ", ".join(
        f"max(case when {'is_home' if s == 'home' else 'not is_home'} then {c} end) as {s}_{c}"
        for s in ("home", "away")
        for c in features_plan.SIDE_STATS
    )
    + " from frm group by match_id)"
)

ELO_SQL = """dts as (select match_date, row_number() over (order by match_date) as i from (select distinct match_date from enc)),
plays as materialized (
  select i, match_id, home_team as team, 1 as sgn, case ftr when 'H' then 1.0e0 when 'D' then 0.5e0 else 0.0e0 end as actual
  from enc join dts using (match_date)
  union all
  select i, match_id, away_team, -1, case ftr when 'H' then 1.0e0 when 'D' then 0.5e0 else 0.0e0 end
  from enc join dts using (match_date)),
elo(i, team, r) as (
  select cast(1 as bigint), team, 1500.0e0 from (select home_team as team from enc union select away_team from enc)
  union all
  select i + 1, team,
         case when match_id is null then r
              when sgn = 1 then r + 20 * (actual - expected)
              else r - 20 * (actual - expected) end
  from (select e.i, e.team, e.r, p.match_id, p.sgn, p.actual,
               1 / (1 + pow(10.0e0, (max(case when sgn = -1 then e.r end) over (partition by p.match_id)
                                  - (max(case when sgn = 1 then e.r end) over (partition by p.match_id) + 60)) / 400)) as expected
        from elo e left join plays p on p.i = e.i and p.team = e.team
        where e.i <= (select max(i) from dts))),
rat as materialized (
  select match_id, max(case when sgn = 1 then r end) as elo_home, max(case when sgn = -1 then r end) as elo_away
  from plays join elo using (i, team) group by match_id)"""

RATED = {"elo_home", "elo_away", "elo_diff"}


def _feature_select(alias: str) -> str:
    source = {
        "home_home_points_5": "home_venue_points",
        "away_away_points_5": "away_venue_points",
        "rest_days_diff": "home_rest_days - away_rest_days",
        "elo_diff": "elo_home - elo_away",
        "implied_home": "i_home",
        "implied_draw": "i_draw",
        "implied_away": "i_away",
        "implied_edge_home_minus_away": "i_home - i_away",
    }
    parts = []
    for f in FEATURES:
        expr = source.get(f, f)
        parts.append(f"round({expr}, 4) as {f}" if f in RATED else f"{expr} as {f}")
    return ", ".join(parts)


FEATURE_CTES = f"{IMPLIED_SQL},\n{FORM_SQL},\n{ELO_SQL}"


def _rounded(df):
    return df.withColumns({c: F.round(c, 4) for c in RATED})


@query("J01_entity_rows", with_enc("select * from lng", LONG_SQL))
def entity_rows(spark, sf):
    return longform.entity_rows(encounters(spark, sf)).drop("match_datetime")


_RENAMED = ", ".join(f"{s}_{c}" for s in ("home", "away") for c in features_plan.SIDE_STATS)


@query("W01_W02_W03_J02_side_features", with_enc(f"select match_id, {_RENAMED} from sid", FORM_SQL))
def side_features(spark, sf):
    return features_plan.side_features(encounters(spark, sf))


@query(
    "W04_elo_ratings",
    with_enc(
        "select match_id, round(elo_home, 4) as elo_home, round(elo_away, 4) as elo_away, round(elo_home - elo_away, 4) as elo_diff from rat",
        ELO_SQL,
        recursive=True,
    ),
)
def elo_ratings(spark, sf):
    rated = elo.elo_ratings(encounters(spark, sf), "competition")
    return _rounded(rated.withColumn("elo_diff", F.col("elo_home") - F.col("elo_away")))


@query(
    "W05_venue_form",
    with_enc(
        """select match_id,
  coalesce(avg(case ftr when 'H' then 3 when 'D' then 1 else 0 end) over (partition by home_team order by match_date, match_id rows between 5 preceding and 1 preceding), 1.0e0) as home_form_pts,
  coalesce(avg(case ftr when 'A' then 3 when 'D' then 1 else 0 end) over (partition by away_team order by match_date, match_id rows between 5 preceding and 1 preceding), 1.0e0) as away_form_pts
from enc"""
    ),
)
def venue_form(spark, sf):
    return form.venue_form(encounters(spark, sf)).select("match_id", "home_form_pts", "away_form_pts")


@query(
    "W05_rolling_mean_many_rows_per_day",
    """select event_id, round(coalesce(avg(value) over (partition by user_id order by cast(ts as date), event_id
       rows between 5 preceding and 1 preceding), -1), 6) as recent_value from events""",
)
def rolling_events(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", F.col("ts").cast("date").alias("day"), "value")
    out = form.rolling_mean_before(events, ["user_id"], "day", ["event_id"], F.col("value"), 5, "recent_value", -1.0)
    return out.select("event_id", F.round("recent_value", 6).alias("recent_value"))


_RANGE = "order by match_date range between interval 1825 days preceding and interval 1 days preceding"


@query(
    "W06_calendar_form",
    with_enc(
        f"""select match_id, coalesce(avg(home_goals) over (partition by home_team {_RANGE}), 0.0e0) as home_form_scored,
  coalesce(avg(away_goals) over (partition by away_team {_RANGE}), 0.0e0) as away_form_conceded from enc"""
    ),
)
def calendar_form(spark, sf):
    specs = [("home_team", "home_goals", "home_form_scored"), ("away_team", "away_goals", "away_form_conceded")]
    df = form.calendar_form(stored(spark, sf), "match_date", specs, 5 * 365)
    return df.select("match_id", "home_form_scored", "away_form_conceded")


@query(
    "W06_calendar_form_events",
    """select event_id, round(coalesce(cast(sum(cast(value as decimal(28,4))) over w as double) / count(value) over w, 0.0e0), 6) as weekly_value from events
       window w as (partition by user_id order by cast(ts as date) range between interval 7 days preceding and interval 1 days preceding)""",
)
def calendar_form_events(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", F.col("ts").cast("date").alias("day"), "value")
    return form.calendar_form(events, "day", [("user_id", "value", "weekly_value")], 7, exact=4).select(
        "event_id", F.round("weekly_value", 6).alias("weekly_value")
    )


@query(
    "W07_repeated_days",
    with_enc("select team, match_date, cast(count(*) as bigint) as n_matches from sides group by team, match_date having count(*) > 1"),
)
def repeated_days(spark, sf):
    return guard.repeated_days(encounters(spark, sf, drop_clashes=False))


@query(
    "W08_matchdays",
    with_enc(
        "select match_id, cast(count(*) filter (where starts) over (partition by season order by i) as bigint) as matchday from"
        " (select idx.season, idx.i, idx.match_id, chn.i is not null as starts from idx left join chn on chn.season = idx.season and chn.i = idx.i)",
        """idx as materialized (select season, match_id, home_team, away_team, row_number() over (partition by season order by match_date, home_team, away_team) as i from enc),
lst as (select season, i, lag(i, 1, 0) over (partition by season, team order by i) as p
        from (select season, i, home_team as team from idx union all select season, i, away_team from idx)),
prv as (select season, i, max(p) as p from lst group by season, i),
fst as (select season, p, min(i) as j from prv where p > 0 group by season, p),
nxt as materialized (select idx.season, idx.i, min(fst.j) over (partition by idx.season order by idx.i desc) as j
        from idx left join fst on fst.season = idx.season and fst.p = idx.i),
chn(season, i) as (select season, cast(1 as bigint) from (select distinct season from enc)
        union all select nxt.season, nxt.j from chn join nxt on nxt.season = chn.season and nxt.i = chn.i where nxt.j is not null)""",
        recursive=True,
    ),
)
def matchdays(spark, sf):
    return rounds.matchdays(encounters(spark, sf))


@query(
    "W09_recent_entries",
    with_enc(
        """select match_id, team, cast(len(l) as integer) as n_recent, list_aggregate(l, 'string_agg', ',') as points from (
  select match_id, team, coalesce(list(cast(cast(points as integer) as varchar)) over (partition by team order by match_date, match_id rows between 40 preceding and 1 preceding), []) as l from lng)""",
        LONG_SQL,
    ),
)
def recent_entries(spark, sf):
    long = form.with_recent_entries(longform.entity_rows(encounters(spark, sf)), 40)
    text = F.concat_ws(",", F.transform("recent", lambda e: e["points"].cast("int").cast("string")))
    return long.select("match_id", "team", F.size("recent").alias("n_recent"), F.when(F.size("recent") > 0, text).alias("points"))


_UP_TO = "rows between {n} preceding and current row"
STATE_SQL = (
    f"{LONG_SQL},\n{ELO_SQL},\naft as (select lng.*, "
    + ", ".join(f"avg({f}) over ({_W} {_UP_TO.format(n=n - 1)}) as {name}" for name, (f, n) in form.FORM_STATS.items())
    + f", avg(points) over (partition by team, is_home order by match_date, match_id {_UP_TO.format(n=4)}) as venue"
    + f", row_number() over (partition by team order by match_date desc) as back from lng),\n"
    + "fin as (select team, r as elo from elo where i = (select max(i) + 1 from dts))"
)


STATES_SQL = with_enc(
    "select team, round(elo, 4) as elo, match_date as last_date, "
        + ", ".join(form.FORM_STATS)
        + ", coalesce((select arg_max(venue, match_date) from aft b where b.team = aft.team and b.is_home), 1.35e0) as home_points_5"
        + ", coalesce((select arg_max(venue, match_date) from aft b where b.team = aft.team and not b.is_home), 1.35e0) as away_points_5"
        + " from aft join fin using (team) where back = 1",
        STATE_SQL,
        recursive=True,
    )


@query("W10_current_states", STATES_SQL)
def current_states(spark, sf):
    enc = stored(spark, sf)
    states = asof.entity_states(enc, elo.elo_ratings(enc, "competition"))
    return asof.current_states(states).withColumn("elo", F.round("elo", 4))


@query("W10_updated_snapshot", STATES_SQL)
def updated_snapshot(spark, sf):
    """All matches before 1998 as a snapshot, and the later ones folded in as an increment."""
    enc = stored(spark, sf)
    before = stage(snapshot.stretch(enc.filter("match_date < '1998-01-01'"), None, "competition"), "snapshot")
    after = snapshot.updated(before, enc.filter("match_date >= '1998-01-01'"), "competition")
    return snapshot.states(after).withColumn("elo", F.round("elo", 4))


_KEYS = "match_id, season, match_date, home_team, away_team, ftr, home_goals, away_goals"


FEATURES_SQL = with_enc(
    f"select {_KEYS}, {_feature_select('')} from imp join sid using (match_id) join rat using (match_id)",
    FEATURE_CTES,
    recursive=True,
)


@query("W11_features", FEATURES_SQL)
def features(spark, sf):
    return _rounded(features_plan.build_features(encounters(spark, sf), "competition"))


@query(
    "W12_J03_fixture_features",
    with_enc(
        f"select match_id, match_date, home_team, away_team, {_feature_select('')} from imp join sid using (match_id) join rat using (match_id)",
        FEATURE_CTES,
        recursive=True,
    ),
)
def fixture_features(spark, sf):
    # The as-of cut is strict, so fixtures asked against the whole table must give their own feature rows.
    enc = stored(spark, sf)
    fixtures = enc.select("match_id", "match_date", "home_team", "away_team", "odds_home", "odds_draw", "odds_away")
    return _rounded(fixtures_plan.build_fixture_features(enc, fixtures, "competition", keep=("match_id",)))


@query(
    "Q05_contradicting_results",
    with_enc(
        "select match_id, given, home_goals, away_goals from (select *, case when match_id % 50 = 0 then 'A' else ftr end as given from enc) t where given <> ftr"
    ),
)
def contradictions(spark, sf):
    given = F.when(F.col("match_id") % 50 == 0, "A").otherwise(F.col("ftr"))
    return guard.contradicting_results(encounters(spark, sf).withColumn("ftr", given)).select(
        "match_id", F.col("ftr").alias("given"), "home_goals", "away_goals"
    )

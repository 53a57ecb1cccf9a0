"""Readers: season files derived from the order table, read back through the real readers."""

from __future__ import annotations

from pyspark.sql import functions as F

from duelframe.catalog.base import query
from duelframe.catalog.scalars import _KICKOFF, _RESULT
from duelframe.catalog.testbed import DATE_SQL, RAWT_SQL, alias_sql, encounters, raw_rows, with_enc
from duelframe.schema import ALIASES, INGEST_ALIASES
from duelframe.session import stage_path
from duelframe.sources import readers, writers

# Every third order is one season file, another third the next; the second file has no time, result or prices.
_FULL = ["Date", "Time", "HomeTeam", "AwayTeam", "FTHG", "FTAG", "FTR", "PSH", "PSD", "PSA", "WHH", "WHD", "WHA"]
_BARE = ["Date", "HomeTeam", "AwayTeam", "FTHG", "FTAG"]


def season_files(spark, sf) -> str:
    raw, root = raw_rows(spark, sf), stage_path(spark, "season-files")
    for season, part, columns in (("2001-02", 0, _FULL), ("2002-03", 1, _BARE), ("2003-04", 2, _FULL)):
        writers.write_csv(raw.filter(F.col("row_id") % 3 == part).select(*columns), f"{root}/{season}.csv")
    return f"{root}/*.csv"


def _clean_sql(aliases) -> str:
    full = "row_id % 3 <> 1"
    home, away = 'try_cast("FTHG" as double)', 'try_cast("FTAG" as double)'
    inferred = f"case when {home} > {away} then 'H' when {away} > {home} then 'A' else 'D' end"
    return f"""cleaned as (
  select row_id, case row_id % 3 when 0 then '2001-02' when 1 then '2002-03' else '2003-04' end as season, d as match_date,
         case when {full} then {_KICKOFF} else cast(d as timestamp) end as match_datetime,
         case when {full} then coalesce("Time", '00:00') else '00:00' end as kickoff_time, {alias_sql('HomeTeam', aliases)} as home_team,
         {alias_sql('AwayTeam', aliases)} as away_team, cast({home} as integer) as home_goals, cast({away} as integer) as away_goals,
         case when {full} then {_RESULT} else {inferred} end as ftr,
         case when {full} then try_cast("PSH" as double) end as odds_home,
         case when {full} then try_cast("PSD" as double) end as odds_draw,
         case when {full} then try_cast("PSA" as double) end as odds_away
  from (select *, {DATE_SQL} as d from rawt)
  where d is not null),
good as (select * from cleaned where home_team <> away_team and home_goals is not null and away_goals is not null)"""


_TIES = "match_datetime, home_goals, away_goals, ftr, odds_home nulls first, odds_draw nulls first, odds_away nulls first"
_CHRONO = "match_datetime, home_team, away_team, home_goals, away_goals, ftr, odds_home nulls first, odds_draw nulls first, odds_away nulls first"


@query(
    "S01_S02_read_season_files",
    f"""with {RAWT_SQL}, {_clean_sql(ALIASES)},
fst as (select *, row_number() over (partition by season, match_date, home_team, away_team order by {_TIES}) as rn from good)
select row_number() over (order by {_CHRONO}) as match_id, season, match_date, strftime(match_datetime, '%Y-%m-%d %H:%M') as kickoff,
  home_team, away_team, home_goals, away_goals, ftr, odds_home, odds_draw, odds_away from fst where rn = 1""",
)
def read_season_files(spark, sf):
    out = readers.read_matches(spark, season_files(spark, sf))
    return out.withColumn("kickoff", F.date_format("match_datetime", "yyyy-MM-dd HH:mm")).drop("match_datetime")


@query(
    "S01_W08_read_extended",
    f"""with recursive {RAWT_SQL}, {_clean_sql(INGEST_ALIASES)},
idx as materialized (select *, row_number() over (partition by season order by match_datetime, home_team, away_team, home_goals, away_goals, ftr) as i from good),
lst as (select season, i, lag(i, 1, 0) over (partition by season, team order by i) as p
        from (select season, i, home_team as team from idx union all select season, i, away_team from idx)),
prv as (select season, i, max(p) as p from lst group by season, i),
fst as (select season, p, min(i) as j from prv where p > 0 group by season, p),
nxt as materialized (select idx.season, idx.i, min(fst.j) over (partition by idx.season order by idx.i desc) as j
        from idx left join fst on fst.season = idx.season and fst.p = idx.i),
chn(season, i) as (select season, cast(1 as bigint) from (select distinct season from idx)
        union all select nxt.season, nxt.j from chn join nxt on nxt.season = chn.season and nxt.i = chn.i where nxt.j is not null),
numbered as (select idx.*, cast(count(chn.i) over (partition by idx.season order by idx.i) as integer) as matchday
        from idx left join chn on chn.season = idx.season and chn.i = idx.i)
select season, matchday, match_date, kickoff_time, home_team, away_team, home_goals, away_goals, ftr as full_time_result,
  cast(null as double) as home_shots, cast(null as double) as away_shots, cast(null as double) as home_shots_on_target,
  cast(null as double) as away_shots_on_target, 'completed' as status, 'files' as source,
  concat(season, ':', strftime(match_date, '%Y-%m-%d'), ':', home_team, ':', away_team) as source_match_id
from (select *, row_number() over (partition by season, match_date, home_team, away_team order by i) as rn from numbered) t where rn = 1""",
)
def read_extended(spark, sf):
    return readers.read_extended(spark, season_files(spark, sf), "files")


@query(
    "S04_read_fixtures",
    f"""with {RAWT_SQL}
select d as match_date, home_team, away_team, odds_home, odds_draw, odds_away from (
  select {DATE_SQL} as d, {alias_sql('HomeTeam', ALIASES)} as home_team, {alias_sql('AwayTeam', ALIASES)} as away_team,
    try_cast("PSH" as double) as odds_home, try_cast("PSD" as double) as odds_draw, try_cast("PSA" as double) as odds_away from rawt) t
where d is not null and home_team <> away_team""",
)
def read_fixtures(spark, sf):
    path = stage_path(spark, "fixtures-file") + ".csv"
    writers.write_csv(raw_rows(spark, sf).select("Date", "HomeTeam", "AwayTeam", "PSH", "PSD", "PSA"), path)
    return readers.read_fixtures(spark, path)


@query(
    "S05_read_or_build",
    with_enc("select match_id, season, home_team, away_team, ftr from enc"),
)
def read_or_build(spark, sf):
    path = stage_path(spark, "processed")

    def build():
        return encounters(spark, sf).select("match_id", "season", "home_team", "away_team", "ftr")

    readers.read_or_build(spark, path, build)
    return readers.read_or_build(spark, path, lambda: build().limit(0))


@query(
    "S06_read_stats_file",
    with_enc(
        "select cast(split_part(season, '-', 1) as integer) as season, match_date as date, cast(home_team as varchar) as home_team,"
        " cast(away_team as varchar) as away_team, cast(home_goals as integer) as home_goals, cast(away_goals as integer) as away_goals,"
        " cast(home_shots as integer) as home_shots, cast(away_shots as integer) as away_shots,"
        " cast(home_sot as integer) as home_shots_on_target, cast(away_sot as integer) as away_shots_on_target, ftr as result from enc"
    ),
)
def read_stats_file(spark, sf):
    path = stage_path(spark, "stats-file") + ".csv"
    enc = encounters(spark, sf, with_shots=True)
    flat = enc.select(
        F.split("season", "-")[0].alias("season"),
        F.col("match_date").alias("date"),
        "home_team",
        "away_team",
        "home_goals",
        "away_goals",
        *[F.col(a).cast("int").alias(b) for a, b in (("home_shots", "home_shots"), ("away_shots", "away_shots"),
                                                     ("home_sot", "home_shots_on_target"), ("away_sot", "away_shots_on_target"))],
        *[F.lit(None).cast("int").alias(c) for c in ("home_corners", "away_corners", "home_fouls", "away_fouls")],
        F.col("ftr").alias("result"),
    )
    writers.write_csv(flat, path)
    return readers.read_stats(spark, path).drop("home_corners", "away_corners", "home_fouls", "away_fouls")



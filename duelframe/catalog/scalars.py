"""Column expressions over raw text rows and encounters."""

from __future__ import annotations

from pyspark.sql import functions as F

from duelframe.catalog.base import query
from duelframe.catalog.testbed import DATE_SQL, ENC_SQL, RAWT_SQL, alias_sql, encounters, raw_rows, table, with_enc
from duelframe.functions import scalars as S
from duelframe.operators import clean, registry, splits
from duelframe.schema import ALIASES, INGEST_ALIASES
from duelframe.session import stage


def raw_sql(body: str, more: str = "") -> str:
    return f"with {RAWT_SQL}{more}\n{body}"


# Normalised prices of ``enc`` with the one-third fallback, reused by many counterparts.
IMPLIED_SQL = """imp as (
  select *, case when odds_home > 1 and odds_draw > 1 and odds_away > 1
                 then (1 / odds_home) / (1 / odds_home + 1 / odds_draw + 1 / odds_away) end as i_home,
            case when odds_home > 1 and odds_draw > 1 and odds_away > 1
                 then (1 / odds_draw) / (1 / odds_home + 1 / odds_draw + 1 / odds_away) end as i_draw,
            case when odds_home > 1 and odds_draw > 1 and odds_away > 1
                 then (1 / odds_away) / (1 / odds_home + 1 / odds_draw + 1 / odds_away) end as i_away
  from enc),
prob as materialized (
  select *,
    case when i_home is null then 1.0e0 / 3 else i_home / (i_home + i_draw + i_away) end as p_home,
    case when i_home is null then 1.0e0 / 3 else i_draw / (i_home + i_draw + i_away) end as p_draw,
    case when i_home is null then 1.0e0 / 3 else i_away / (i_home + i_draw + i_away) end as p_away
  from imp)"""

PREDICTED_SQL = "case when p_home >= p_draw and p_home >= p_away then 'H' when p_draw >= p_away then 'D' else 'A' end"


def with_probabilities(df):
    """Implied probabilities with the one-third fallback."""
    implied = S.implied_probabilities("odds_home", "odds_draw", "odds_away")
    df = df.withColumns(dict(zip(("i_home", "i_draw", "i_away"), implied)))
    p = S.sanitise_triple("i_home", "i_draw", "i_away")
    return df.withColumns(dict(zip(("p_home", "p_draw", "p_away"), p)))


@query("P01_parse_dates", raw_sql(f"select row_id, {DATE_SQL} as match_date from rawt"))
def parse_dates(spark, sf):
    return raw_rows(spark, sf).select("row_id", S.parse_date("Date").alias("match_date"))


# Layouts of one day's date as free text; the last four are no dates.
FREE_DATES = (
    "date_format(d, 'MMM d yyyy')",
    "date_format(d, 'd MMM yyyy')",
    "date_format(d, 'yyyyMMdd')",
    "concat(date_format(d, 'dd/MM/yyyy'), ' 15:30')",
    "concat(date_format(d, 'yyyy-MM-dd'), 'T07:05:09.250+02:00')",
    "concat(date_format(d, 'EEEE, MMMM d'), case when day(d) in (1, 21, 31) then 'st' when day(d) in (2, 22) then 'nd' when day(d) in (3, 23) then 'rd' else 'th' end, date_format(d, ', yyyy'))",
    "date_format(d, 'dd-MMM-yy')",
    "date_format(d, 'ddMMMyyyy')",
    "date_format(d, 'yyyy MMMM d')",
    "concat(date_format(d, 'd.M.yy'), ' 3pm')",
    "date_format(d, 'yyyy/M/d')",
    "concat('Sept', date_format(d, ' d yyyy'))",
    "date_format(d, 'd MMM')",
    "concat(date_format(d, 'd MMM yyyy'), ' or later')",
    "'30 February 2020'",
    "'soon'",
)


@query(
    "P01_generic_dates",
    f"""select row_id, case when k < 11 then d when k = 11 then make_date(year(d), 9, least(day(d), 30)) end as match_date
from (select o_orderkey as row_id, cast(o_orderdate as date) as d, o_orderkey % {len(FREE_DATES)} as k from orders)
where k <> 11 or day(d) < 31""",
)
def generic_dates(spark, sf):
    rows = table(spark, sf, "orders").select(F.col("o_orderkey").alias("row_id"), F.col("o_orderdate").cast("date").alias("d"))
    rows = rows.withColumn("k", F.col("row_id") % len(FREE_DATES)).filter("k <> 11 or day(d) < 31")
    cases = " ".join(f"when {k} then {e}" for k, e in enumerate(FREE_DATES))
    return rows.selectExpr("row_id", f"case k {cases} end as text").select("row_id", S.parse_date("text").alias("match_date"))


@query(
    "P02_normalise_names",
    raw_sql(
        f"select row_id, {alias_sql('HomeTeam', ALIASES)} as home_team, {alias_sql('AwayTeam', ALIASES)} as away_team,"
        f" {alias_sql('HomeTeam', INGEST_ALIASES)} as home_ingest from rawt"
    ),
)
def normalise_names(spark, sf):
    return raw_rows(spark, sf).select(
        "row_id",
        S.normalise_name("HomeTeam", ALIASES).alias("home_team"),
        S.normalise_name("AwayTeam", ALIASES).alias("away_team"),
        S.normalise_name("HomeTeam", INGEST_ALIASES).alias("home_ingest"),
    )


@query(
    "P03_to_number",
    raw_sql('select row_id, try_cast("FTHG" as double) as home_goals, try_cast("PSD" as double) as price from rawt'),
)
def to_number(spark, sf):
    return raw_rows(spark, sf).select("row_id", S.to_number("FTHG").alias("home_goals"), S.to_number("PSD").alias("price"))


@query(
    "P04_pick_prices",
    raw_sql(
        'select row_id, try_cast("PSH" as double) as odds_home, try_cast("PSD" as double) as odds_draw,'
        ' try_cast("PSA" as double) as odds_away from rawt'
    ),
)
def pick_prices(spark, sf):
    raw = raw_rows(spark, sf)
    return raw.select("row_id", *[c.alias(n) for n, c in clean.price_columns(raw).items()])


_SCORE = 'try_cast("FTHG" as double)', 'try_cast("FTAG" as double)'
_RESULT = (
    "case when \"FTR\" in ('H', 'D', 'A') then \"FTR\""
    f" when {_SCORE[0]} > {_SCORE[1]} then 'H' when {_SCORE[1]} > {_SCORE[0]} then 'A'"
    f" when {_SCORE[0]} = {_SCORE[1]} then 'D' end"
)


@query("P05_result", raw_sql(f"select row_id, {_RESULT} as ftr from rawt"))
def result(spark, sf):
    return raw_rows(spark, sf).select(
        "row_id", S.validated_result("FTR", S.to_number("FTHG"), S.to_number("FTAG")).alias("ftr")
    )


_KICKOFF = (
    "coalesce(try_strptime(concat(strftime(d, '%Y-%m-%d'), ' ', coalesce(\"Time\", '00:00')), '%Y-%m-%d %H:%M'),"
    " cast(d as timestamp))"
)


@query(
    "P06_kickoff",
    raw_sql(
        f"select row_id, case when d is not null then strftime({_KICKOFF}, '%Y-%m-%d %H:%M:%S') end as kickoff"
        f' from (select row_id, "Time", {DATE_SQL} as d from rawt)'
    ),
)
def kickoff(spark, sf):
    stamp = S.kickoff_timestamp(S.parse_date("Date"), "Time")
    return raw_rows(spark, sf).select("row_id", F.date_format(stamp, "yyyy-MM-dd HH:mm:ss").alias("kickoff"))


@query(
    "P07_select_rename",
    raw_sql(
        'select row_id, "Date" as match_date, "Time" as kickoff_time, "HomeTeam" as home_team,'
        ' "AwayTeam" as away_team, "FTHG" as home_goals, "FTAG" as away_goals, "FTR" as ftr from rawt'
    ),
)
def select_rename(spark, sf):
    raw = raw_rows(spark, sf)
    clean.require_columns(raw, clean.REQUIRED, "raw rows")
    return raw.select("row_id", *[c for c in clean.RENAMES if c in raw.columns]).withColumnsRenamed(clean.RENAMES)


TYPED_SQL = f"""typed as (
  select row_id, {DATE_SQL} as match_date, "Time" as kickoff_time,
         {alias_sql('HomeTeam', ALIASES)} as home_team, {alias_sql('AwayTeam', ALIASES)} as away_team,
         try_cast("FTHG" as double) as home_goals, try_cast("FTAG" as double) as away_goals, {_RESULT} as ftr
  from rawt),
valid as (select * from typed where match_date is not null and home_team <> away_team
          and home_goals is not null and away_goals is not null)"""


def typed_rows(spark, sf):
    # Written first, as raw rows are in practice: the cleaning plan then names plain text columns.
    return stage(raw_rows(spark, sf), "raw-rows").select(
        "row_id",
        S.parse_date("Date").alias("match_date"),
        S.normalise_name("HomeTeam", ALIASES).alias("home_team"),
        S.normalise_name("AwayTeam", ALIASES).alias("away_team"),
        S.to_number("FTHG").alias("home_goals"),
        S.to_number("FTAG").alias("away_goals"),
    )


@query(
    "P08_valid_rows",
    raw_sql("select row_id, match_date, home_team, away_team, home_goals, away_goals from valid", f",\n{TYPED_SQL}"),
)
def valid_rows(spark, sf):
    return clean.valid_rows(typed_rows(spark, sf))


@query(
    "P11_natural_key",
    with_enc(
        "select match_id, concat(season, ':', strftime(match_date, '%Y-%m-%d'), ':', home_team, ':', away_team)"
        " as source_match_id from enc"
    ),
)
def natural_key(spark, sf):
    return encounters(spark, sf).select(
        "match_id", S.natural_key("season", "match_date", "home_team", "away_team").alias("source_match_id")
    )


@query(
    "P12_constant_and_absent_columns",
    raw_sql(
        "select row_id, 'completed' as status, 'files' as source, cast(null as double) as home_shots,"
        " coalesce(\"Time\", '00:00') as kickoff_time from rawt"
    ),
)
def constants(spark, sf):
    raw = raw_rows(spark, sf)
    return raw.select(
        "row_id",
        F.lit("completed").alias("status"),
        F.lit("files").alias("source"),
        clean.present_or_null(raw, "HS", "double").alias("home_shots"),
        F.coalesce(clean.present_or_null(raw, "Time"), F.lit("00:00")).alias("kickoff_time"),
    )


@query(
    "P13_P14_P15_label_encodings",
    with_enc(
        "select match_id, cast(case ftr when 'H' then 0 when 'D' then 1 else 2 end as integer) as class_index,"
        " cast(case ftr when 'H' then 2 when 'D' then 1 else 0 end as integer) as target,"
        " cast(case ftr when 'H' then 1 else 0 end as integer) as label from enc"
    ),
)
def label_encodings(spark, sf):
    return encounters(spark, sf).select(
        "match_id",
        S.class_index("ftr").alias("class_index"),
        S.descending_target("ftr").alias("target"),
        S.home_win_target("ftr").alias("label"),
    )


@query(
    "P16_shot_accuracy",
    with_enc(
        "select match_id, home_goals - away_goals as goal_diff, home_sot / (home_shots + 1) as home_shot_acc,"
        " away_sot / (away_shots + 1) as away_shot_acc from enc"
    ),
)
def shot_accuracy(spark, sf):
    return encounters(spark, sf, with_shots=True).select(
        "match_id",
        (F.col("home_goals") - F.col("away_goals")).alias("goal_diff"),
        S.shot_accuracy("home_sot", "home_shots").alias("home_shot_acc"),
        S.shot_accuracy("away_sot", "away_shots").alias("away_shot_acc"),
    )


@query(
    "P17_fill_nulls",
    with_enc("select match_id, coalesce(odds_home, 1.0) as odds_home, odds_draw from enc"),
)
def fill_nulls(spark, sf):
    return clean.fill_missing(encounters(spark, sf).select("match_id", "odds_home", "odds_draw"), {"odds_home": 1.0})


@query(
    "P18_infinite_to_null",
    with_enc("select match_id, case when home_goals > 0 then odds_draw / home_goals end as ratio from enc"),
)
def infinite_to_null(spark, sf):
    # Zero goals make the ratio infinite, and not-a-number where the away side is missing too.
    ratio = F.when(F.col("home_goals") > 0, F.col("odds_draw") / F.nullif("home_goals", F.lit(0))).otherwise(
        F.when(F.col("away_goals") > 0, F.lit(float("inf"))).otherwise(F.lit(float("nan")))
    )
    return encounters(spark, sf).select("match_id", S.finite(ratio).alias("ratio"))


@query(
    "P19_implied_probabilities",
    with_enc("select match_id, i_home, i_draw, i_away, i_home - i_away as edge from imp", IMPLIED_SQL),
)
def implied(spark, sf):
    h, d, a = S.implied_probabilities("odds_home", "odds_draw", "odds_away")
    return encounters(spark, sf).select(
        "match_id", h.alias("i_home"), d.alias("i_draw"), a.alias("i_away"), (h - a).alias("edge")
    )


@query(
    "P20_points",
    with_enc(
        "select match_id, cast(case ftr when 'H' then 3 when 'D' then 1 else 0 end as integer) as home_points,"
        " cast(case ftr when 'A' then 3 when 'D' then 1 else 0 end as integer) as away_points from enc"
    ),
)
def points(spark, sf):
    return encounters(spark, sf).select(
        "match_id",
        S.points("ftr", F.lit(True), strict=True).alias("home_points"),
        S.points("ftr", F.lit(False), strict=True).alias("away_points"),
    )


@query(
    "P21_elo_expected",
    with_enc(
        "select match_id, round(1 / (1 + pow(10.0e0, ((1500 + away_goals * 25) - (1400 + home_goals * 50 + 60)) / 400.0e0)), 9)"
        " as expected from enc"
    ),
)
def elo_expected(spark, sf):
    home, away = F.lit(1400.0) + F.col("home_goals") * 50, F.lit(1500.0) + F.col("away_goals") * 25
    return encounters(spark, sf).select("match_id", F.round(S.elo_expected(home, away), 9).alias("expected"))


_TRIPLE_SQL = """trip as (
  select match_id, case when match_id % 41 = 0 then null when match_id % 43 = 0 then cast('nan' as double)
                        else odds_draw - 2.5 end as r_home,
         home_goals * 1.0e0 as r_draw, 0.0e0 as r_away, home_goals from enc),
clip as (select match_id, r_home, least(greatest(r_home, 0), 1) as h, least(r_draw, 1) as d, r_away as a from trip)"""


@query(
    "P22_sanitise_triple",
    with_enc(
        "select match_id,"
        + ", ".join(
            f" case when r_home is null or isnan(r_home) or h + d + a <= 0 then 1.0e0 / 3 else {c} / (h + d + a) end as {n}"
            for c, n in (("h", "p_home"), ("d", "p_draw"), ("a", "p_away"))
        )
        + " from clip",
        _TRIPLE_SQL,
    ),
)
def sanitise(spark, sf):
    raw = (
        F.when(F.col("match_id") % 41 == 0, None)
        .when(F.col("match_id") % 43 == 0, float("nan"))
        .otherwise(F.col("odds_draw") - 2.5)
    )
    p = S.sanitise_triple(raw, "home_goals", F.lit(0.0))
    return encounters(spark, sf).select("match_id", *[c.alias(n) for c, n in zip(p, ("p_home", "p_draw", "p_away"))])


_GOAL_INPUT = {
    "home_goals_for_5": "case when match_id % 3 = 0 then null else home_goals / 3.0e0 end",
    "away_goals_for_5": "away_goals / 7.0e0",
    "home_goals_against_5": "(match_id % 9) / 3.0e0",
    "away_goals_against_5": "(match_id % 5) / 7.0e0",
    "elo_diff": "((match_id % 401) - 200) * 1.0e0",
    "rest_days_diff": "((match_id % 21) - 10) * 1.0e0",
}


@query(
    "P23_expected_goals",
    with_enc(
        """
select match_id,
  floor(least(greatest((hf + aa) / 2 + (0.35e0 * (p_home - p_away) + 0.0004e0 * gap + 0.02e0 * rest) + 0.15e0 * p_draw, 0), 6) * 10000e0 + 0.5e0) / 10000e0 as expected_home,
  floor(least(greatest((af + ha) / 2 - (0.35e0 * (p_home - p_away) + 0.0004e0 * gap + 0.02e0 * rest) + 0.15e0 * p_draw, 0), 6) * 10000e0 + 0.5e0) / 10000e0 as expected_away
from g""",
        IMPLIED_SQL
        + ",\ngin as (select *, "
        + ", ".join(f"{e} as {n}" for n, e in _GOAL_INPUT.items())
        + """ from prob),
g as (select match_id, p_home, p_draw, p_away,
       coalesce(nullif(home_goals_for_5, 0), 1.35e0) as hf, coalesce(nullif(away_goals_for_5, 0), 1.35e0) as af,
       coalesce(nullif(home_goals_against_5, 0), 1.35e0) as ha, coalesce(nullif(away_goals_against_5, 0), 1.35e0) as aa,
       elo_diff as gap, greatest(least(rest_days_diff, 5), -5) as rest from gin)""",
    ),
)
def expected_goals(spark, sf):
    df = with_probabilities(encounters(spark, sf)).withColumns({n: F.expr(e) for n, e in _GOAL_INPUT.items()})
    home, away = S.expected_goals("p_home", "p_draw", "p_away")
    return df.select("match_id", home.alias("expected_home"), away.alias("expected_away"))


@query("P24_predicted_label", with_enc(f"select match_id, {PREDICTED_SQL} as predicted from prob", IMPLIED_SQL))
def predicted(spark, sf):
    return with_probabilities(encounters(spark, sf)).select(
        "match_id", S.predicted_label("p_home", "p_draw", "p_away").alias("predicted")
    )


@query(
    "P25_json_snapshot",
    with_enc(
        """
select match_id, concat('{"match_id":', match_id, ',"match_date":"', strftime(match_date, '%Y-%m-%d'), 'T00:00:00","ftr":"', ftr,
  '","odds_home":', coalesce(cast(odds_home as varchar), 'null'), ',"odds_draw":', coalesce(cast(nullif(odds_draw, 2.5e0) as varchar), 'null'), '}') as snapshot
from enc"""
    ),
)
def json_snapshot(spark, sf):
    nan = F.when(F.col("odds_draw") == 2.5, F.lit(float("nan"))).otherwise(F.col("odds_draw"))
    df = encounters(spark, sf).withColumn("odds_draw", nan)
    snap = S.json_snapshot(
        ["match_id", "match_date", "ftr", "odds_home", "odds_draw"], ["match_date"], ["odds_home", "odds_draw"]
    )
    return df.select("match_id", snap.alias("snapshot"))


@query(
    "P26_P27_percentages_and_badge",
    with_enc(
        """
select match_id,
  cast(case when over_ and h >= d then greatest(0, h + rest) else h end as bigint) as pct_home,
  cast(case when over_ and h < d then greatest(0, d + rest) else d end as bigint) as pct_draw,
  cast(case when over_ then 0 else rest end as bigint) as pct_away,
  case when p_home >= p_away and p_home >= p_draw then 'home' when p_away > p_home and p_away > p_draw then 'away' else 'draw' end as badge
from pc""",
        IMPLIED_SQL
        + """,
pc0 as (select match_id, p_home, p_draw, p_away,
          floor((case when match_id % 10 = 0 then 0.505e0 else p_home end) * 100 + 0.5e0) as h,
          floor((case when match_id % 10 = 0 then 0.505e0 else p_draw end) * 100 + 0.5e0) as d from prob),
pc as (select *, 100 - h - d as rest, 100 - h - d < 0 as over_ from pc0)""",
    ),
)
def percentages(spark, sf):
    df = with_probabilities(encounters(spark, sf))
    clash = F.col("match_id") % 10 == 0
    h, d, a = S.integer_percentages(
        F.when(clash, 0.505).otherwise(F.col("p_home")), F.when(clash, 0.505).otherwise(F.col("p_draw")), "p_away"
    )
    return df.select(
        "match_id",
        *[c.cast("bigint").alias(n) for c, n in ((h, "pct_home"), (d, "pct_draw"), (a, "pct_away"))],
        S.outcome_badge("p_home", "p_draw", "p_away").alias("badge"),
    )


@query(
    "P28_P29_P30_S09_date_and_season_labels",
    with_enc(
        """
select match_id, strftime(match_date, '%Y-%m-%d') as iso_day, concat('W', weekofyear(match_date), '-', year(match_date)) as week,
  cast(split_part(season, '-', 1) as integer) as start_year,
  concat(right(split_part(season, '-', 1), 2), split_part(season, '-', 2)) as code,
  concat(right(split_part(season, '-', 1), 2), split_part(season, '-', 2), '/E0.csv') as path
from enc"""
    ),
)
def date_labels(spark, sf):
    return encounters(spark, sf).select(
        "match_id",
        S.iso_day("match_date").alias("iso_day"),
        S.iso_week_label("match_date").alias("week"),
        S.season_start_year("season").alias("start_year"),
        S.season_code("season").alias("code"),
        S.season_path("season").alias("path"),
    )


@query(
    "S03_season_from_path",
    with_enc(
        "select match_id, case when match_id % 5 = 0 then null else season end as season_label from enc"
    ),
)
def season_from_path(spark, sf):
    path = F.when(F.col("match_id") % 5 == 0, F.concat(F.lit("data/"), F.col("season"), F.lit("/all.csv"))).otherwise(
        F.concat(F.lit("data/raw/"), F.col("season"), F.lit(".csv"))
    )
    return encounters(spark, sf).select("match_id", S.season_from_path(path).alias("season_label"))


_COLOURS = {"FURNITURE": "#AA0000", "MACHINERY": "#00AA00"}


@query(
    "P31_P32_display_and_search",
    """
select c_custkey, upper(substring(c_mktsegment, 1, 3)) as short,
  case c_mktsegment when 'FURNITURE' then '#AA0000' when 'MACHINERY' then '#00AA00' else '#8891B8' end as color
from customer where contains(lower(c_mktsegment), 'ch') or contains(lower(c_mktsegment), 'furn')""",
)
def display(spark, sf):
    return (
        table(spark, sf, "customer")
        .filter(S.matches_search("c_mktsegment", " CH ") | S.matches_search("c_mktsegment", "Furn"))
        .select("c_custkey", S.short_code("c_mktsegment").alias("short"), S.colour("c_mktsegment", _COLOURS).alias("color"))
    )


@query(
    "P33_list_matches",
    with_enc(
        "select match_id, season, strftime(match_date, '%Y-%m-%d') as match_date, home_team, away_team, home_goals,"
        " away_goals, ftr from enc where season = '1996-97' order by match_date, home_team, away_team"
    ),
)
def list_matches(spark, sf):
    return registry.list_matches(encounters(spark, sf), " 1996-97 ")


@query(
    "P34_P35_season_and_history_filters",
    with_enc(
        "select match_id, season, match_date from enc where season in ('1995-96', '1998-99')"
        " and match_date < date '1999-01-01'"
    ),
)
def filters(spark, sf):
    return (
        encounters(spark, sf)
        .filter(F.col("season").isin("1995-96", "1998-99") & (F.col("match_date") < F.to_date(F.lit("1999-01-01"))))
        .select("match_id", "season", "match_date")
    )

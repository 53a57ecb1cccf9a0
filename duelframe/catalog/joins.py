"""As-of counts, existence checks, listing, dimension sync, registry and eligibility."""

from __future__ import annotations

from pyspark.sql import functions as F

from duelframe.catalog.base import query
from duelframe.catalog.scalars import _GOAL_INPUT, IMPLIED_SQL, PREDICTED_SQL, with_probabilities
from duelframe.catalog.testbed import encounters, stored, table, with_enc
from duelframe.functions import scalars as S
from duelframe.operators import asof, guard, registry
from duelframe.plans import fixtures as fixtures_plan
from duelframe.session import stage


@query(
    "J04_history_counts",
    with_enc(
        """select f.match_id, coalesce(h.n, 0) as home_history, coalesce(a.n, 0) as away_history from fix f
left join cum h on h.match_id = f.match_id and h.team = f.home_team
left join cum a on a.match_id = f.match_id and a.team = f.away_team""",
        """fix as (select * from enc),
lng as (select home_team as team, match_date from enc union all select away_team, match_date from enc),
ask as (select match_id, home_team as team, match_date from fix union all select match_id, away_team, match_date from fix),
cum as (select ask.match_id, ask.team, cast(count(*) as bigint) as n from ask join lng on lng.team = ask.team and lng.match_date < ask.match_date group by ask.match_id, ask.team)""",
    ),
)
def history_counts(spark, sf):
    enc = stored(spark, sf)
    # The as-of cut is strict, so every match can be asked as a fixture.
    fixtures = enc.select("match_id", "match_date", "home_team", "away_team")
    return asof.history_counts(fixtures, enc).select("match_id", "home_history", "away_history")


@query(
    "J05_known_home",
    with_enc("select match_id, home_team from enc where home_team in (select c_custkey from customer where c_acctbal > 0)"),
)
def known_home(spark, sf):
    entities = table(spark, sf, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("name"))
    return registry.known_only(encounters(spark, sf).select("match_id", "home_team"), entities, "home_team")


@query(
    "J05_unknown_away",
    with_enc("select match_id, away_team from enc where away_team not in (select c_custkey from customer where c_acctbal > 0)"),
)
def unknown_away(spark, sf):
    entities = table(spark, sf, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("name"))
    return registry.unknown_only(encounters(spark, sf).select("match_id", "away_team"), entities, "away_team")


@query(
    "J06_prediction_listing",
    with_enc(
        f"""select match_id * 10 as id, h.c_name as home_team, a.c_name as away_team, match_date, p_home, p_draw, p_away,
  {PREDICTED_SQL} as predicted_outcome, concat('v', season) as model_version, match_date as created_at
from prob join customer h on h.c_custkey = home_team join customer a on a.c_custkey = away_team order by created_at desc, id desc""",
        IMPLIED_SQL,
    ),
)
def prediction_listing(spark, sf):
    enc = stored(spark, sf)
    prob = with_probabilities(enc)
    results = prob.select(
        (F.col("match_id") * 10).alias("id"),
        F.col("match_id").alias("request_id"),
        S.season_start_year("season").alias("model_id"),
        "p_home",
        "p_draw",
        "p_away",
        S.predicted_label("p_home", "p_draw", "p_away").alias("predicted_outcome"),
        F.col("match_date").alias("created_at"),
    )
    requests = enc.select(
        F.col("match_id").alias("request_id"), F.col("home_team").alias("home_id"), F.col("away_team").alias("away_id"), "match_date"
    )
    entities = table(spark, sf, "customer").select(F.col("c_custkey").alias("entity_id"), F.col("c_name").alias("name"))
    models = enc.select(
        S.season_start_year("season").alias("model_id"), F.concat(F.lit("v"), "season").alias("version")
    ).distinct()
    return registry.prediction_listing(results, requests, entities, models)


def _existing(spark, sf):
    return table(spark, sf, "customer").filter("c_custkey % 3 <> 0").select(F.col("c_custkey").cast("string").alias("name"))


_SYNC_SQL = """uni as (select cast(home_team as varchar) as name from enc union select cast(away_team as varchar) from enc),
have as (select cast(c_custkey as varchar) as name from customer where c_custkey % 3 <> 0)"""


@query(
    "J07_sync_entities",
    with_enc("select name, name not in (select name from have) as created from (select name from uni union select name from have)", _SYNC_SQL),
)
def sync_entities(spark, sf):
    return registry.sync_entities(_existing(spark, sf), encounters(spark, sf))[0]


@query(
    "J07_sync_counts",
    with_enc(
        "select cast(count(*) filter (where name not in (select name from have)) as bigint) as created_count,"
        " cast(count(*) filter (where name in (select name from have)) as bigint) as existing_count from uni",
        _SYNC_SQL,
    ),
)
def sync_counts(spark, sf):
    return registry.sync_entities(_existing(spark, sf), encounters(spark, sf))[1]


_MODELS_SQL = """reg as (select concat('v', season) as version, concat('models/', season) as artifact_path, 'logistic' as selected_model_name,
          min(match_date) as created_at, cast(count(*) as bigint) as n_rows, season = '1994-95' as is_active from enc group by season)"""


def model_registry(spark, sf):
    return (
        encounters(spark, sf)
        .groupBy("season")
        .agg(F.min("match_date").alias("created_at"), F.count("*").alias("n_rows"))
        .select(
            F.concat(F.lit("v"), "season").alias("version"),
            F.concat(F.lit("models/"), "season").alias("artifact_path"),
            F.lit("logistic").alias("selected_model_name"),
            "created_at",
            "n_rows",
            (F.col("season") == "1994-95").alias("is_active"),
        )
    )


def _current(spark, sf, version: str):
    """The just-published model: its row count is that of the whole table."""
    return encounters(spark, sf).agg(F.count("*").alias("n_rows"), F.max("match_date").alias("created_at")).select(
        F.lit(version).alias("version"),
        F.lit("models/latest").alias("artifact_path"),
        F.lit("main").alias("selected_model_name"),
        "created_at",
        "n_rows",
    )


@query(
    "J08_upsert_existing_version",
    with_enc(
        """select version, case when now then 'models/latest' else artifact_path end as artifact_path,
  case when now then 'main' else selected_model_name end as selected_model_name, created_at,
  case when now then (select cast(count(*) as bigint) from enc) else n_rows end as n_rows, now as is_active
from (select *, version = 'v1997-98' as now from reg)""",
        _MODELS_SQL,
    ),
)
def upsert_existing(spark, sf):
    return registry.upsert_model(model_registry(spark, sf), _current(spark, sf, "v1997-98"))


@query(
    "J08_insert_new_version",
    with_enc(
        """select version, artifact_path, selected_model_name, created_at, n_rows, false as is_active from reg
union all select 'vnext', 'models/latest', 'main', max(match_date), cast(count(*) as bigint), true from enc""",
        _MODELS_SQL,
    ),
)
def insert_new(spark, sf):
    return registry.upsert_model(model_registry(spark, sf), _current(spark, sf, "vnext"))


@query(
    "O02_newest_active_model",
    with_enc(
        "select version, artifact_path, created_at, n_rows from reg where n_rows > 100 order by created_at desc, version desc limit 1",
        _MODELS_SQL,
    ),
)
def newest_active(spark, sf):
    models = model_registry(spark, sf).withColumn("is_active", F.col("n_rows") > 100)
    return registry.newest_active(models).select("version", "artifact_path", "created_at", "n_rows")


_ELIGIBLE_SQL = """his as (select concat('T', home_team) as team, match_date from enc union all select concat('T', away_team), match_date from enc),
req as (select match_id, match_date, concat(' T', home_team, ' ') as home_raw,
          case when match_id % 11 = 0 then concat('t', home_team) else concat('T', away_team) end as away_raw from enc),
cut as (select match_id, match_date, trim(home_raw) as home_team, trim(away_raw) as away_team, lower(trim(home_raw)) = lower(trim(away_raw)) as same from req),
ask as (select match_id, home_team as team, match_date from cut union all select match_id, away_team, match_date from cut),
cum as (select ask.match_id, ask.team, cast(count(*) as bigint) as n from ask join his on his.team = ask.team and his.match_date < ask.match_date group by ask.match_id, ask.team),
known as (select concat('T', c_custkey) as name from customer where c_custkey % 7 <> 0),
cnt as (select cut.*, coalesce(h.n, 0) as home_history, coalesce(a.n, 0) as away_history, kh.name is not null as hk, ka.name is not null as ak
  from cut left join cum h on h.match_id = cut.match_id and h.team = cut.home_team left join cum a on a.match_id = cut.match_id and a.team = cut.away_team
  left join known kh on kh.name = cut.home_team left join known ka on ka.name = cut.away_team)"""


@query(
    "Q01_eligibility",
    with_enc(
        """select match_id, home_team, away_team, home_history, away_history,
  case when same then 'invalid_input' when not hk or not ak then 'not_found' when home_history < 5 or away_history < 5 then 'insufficient_history' else 'ok' end as status,
  case when same then 'Home team and away team must be different.' when not hk then concat('Home team ''', home_team, ''' does not exist.')
       when not ak then concat('Away team ''', away_team, ''' does not exist.')
       when home_history < 5 or away_history < 5 then 'Not enough historical matches to compute rolling features.' else '' end as message
from cnt""",
        _ELIGIBLE_SQL,
    ),
)
def eligibility(spark, sf):
    enc = stored(spark, sf).select(
        "match_id", "season", "match_date", *[F.concat(F.lit("T"), c).alias(c) for c in ("home_team", "away_team")]
    )
    asked = enc.select(
        "match_id",
        "match_date",
        F.concat(F.lit(" "), "home_team", F.lit(" ")).alias("home_team"),
        F.when(F.col("match_id") % 11 == 0, F.lower("home_team")).otherwise(F.col("away_team")).alias("away_team"),
    )
    entities = table(spark, sf, "customer").filter("c_custkey % 7 <> 0").select(F.concat(F.lit("T"), "c_custkey").alias("name"))
    out = fixtures_plan.eligibility(asked, entities, enc)
    return out.select("match_id", "home_team", "away_team", "home_history", "away_history", "status", "message")


def _goal_sql(sign: str, own_for: str, other_against: str) -> str:
    tilt = "(0.35e0 * (p_home - p_away) + 0.0004e0 * elo_diff + 0.02e0 * greatest(least(rest_days_diff, 5), -5))"
    return (
        f"floor(least(greatest((coalesce(nullif({own_for}, 0), 1.35e0) + coalesce(nullif({other_against}, 0), 1.35e0)) / 2"
        f" {sign} {tilt} + 0.15e0 * p_draw, 0), 6) * 10000e0 + 0.5e0) / 10000e0"
    )


@query(
    "Q02_prediction_rows",
    with_enc(
        f"""select match_id, home_team, away_team,
  {_goal_sql('+', 'home_goals_for_5', 'away_goals_against_5')} as expected_home_goals,
  {_goal_sql('-', 'away_goals_for_5', 'home_goals_against_5')} as expected_away_goals,
  p_home as home_win_probability, p_draw as draw_probability, p_away as away_win_probability,
  {PREDICTED_SQL} as predicted_outcome, season as model_version,
  concat('{{"match_date":"', strftime(match_date, '%Y-%m-%d'), 'T00:00:00","home_goals_for_5":', coalesce(cast(home_goals_for_5 as varchar), 'null'),
    ',"away_goals_for_5":', away_goals_for_5, ',"home_goals_against_5":', home_goals_against_5, ',"away_goals_against_5":', away_goals_against_5,
    ',"rest_days_diff":', rest_days_diff, ',"elo_diff":', elo_diff, '}}') as features
from gin""",
        IMPLIED_SQL
        + ",\ngin as (select match_id, home_team, away_team, match_date, season, p_home, p_draw, p_away, "
        + ", ".join(f"{e} as {n}" for n, e in _GOAL_INPUT.items())
        + " from prob)",
    ),
)
def prediction_rows(spark, sf):
    scored = with_probabilities(encounters(spark, sf)).withColumns({n: F.expr(e) for n, e in _GOAL_INPUT.items()})
    # Raw price probabilities, missing ones included: the triple is cleaned on the way out.
    raw = [F.col(i).alias(p) for i, p in (("i_home", "p_home"), ("i_draw", "p_draw"), ("i_away", "p_away"))]
    scored = scored.select("match_id", "home_team", "away_team", "match_date", F.col("season").alias("model_version"), *raw, *_GOAL_INPUT)
    return fixtures_plan.prediction_rows(scored, keep=("match_id",))


@query(
    "Q03_registry_health",
    with_enc(
        """select version, case when n_rows % 2 = 0 then 'model_not_loaded' when n_rows % 3 = 0 then 'feature_list_missing'
  when n_rows % 5 = 0 then 'metadata_missing' else 'ok' end as status, n_rows % 2 <> 0 as artifact_loaded from reg""",
        _MODELS_SQL,
    ),
)
def registry_health(spark, sf):
    models = stage(model_registry(spark, sf), "registry")
    rows = models.select("version", F.when(F.col("n_rows") % 2 != 0, F.col("artifact_path")).alias("artifact_path"))
    features = models.select("version", F.when(F.col("n_rows") % 3 == 0, 0).otherwise(24).alias("n_features"))
    return registry.registry_health(rows, features, models.filter("n_rows % 5 <> 0").select("version"))


@query(
    "Q04_probability_violations",
    with_enc(
        """select cast(count(*) as bigint) as n_rows, cast(count(*) filter (where h < 0 or h > 1 or p_draw > 1 or p_away > 1) as bigint) as n_outside,
  cast(count(*) filter (where abs(h + p_draw + p_away - 1) > 1e-6) as bigint) as n_bad_sum
from (select *, case when match_id % 100 = 0 then p_home + 1.5e0 when match_id % 100 = 1 then p_home + 0.00001e0 else p_home end as h from prob)""",
        IMPLIED_SQL,
    ),
)
def probability_violations(spark, sf):
    bent = (
        F.when(F.col("match_id") % 100 == 0, F.col("p_home") + 1.5)
        .when(F.col("match_id") % 100 == 1, F.col("p_home") + 0.00001)
        .otherwise(F.col("p_home"))
    )
    return guard.probability_violations(with_probabilities(encounters(spark, sf)).withColumn("p_home", bent))

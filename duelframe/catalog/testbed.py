"""Encounters derived from the order tables, for the registered queries and tests.

An order is a match, its customer the home entity, another customer of the same nation the away entity, the
nation the competition. Matches that would give an entity two matches on one date are dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from duelframe.session import stage

# Customers per numbering block; ranks are counted per block, so no nation is ever one window partition.
BLOCK = 1 << 16


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _ranked_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("competition"),
        F.col("c_custkey").alias("team"),
        F.floor(F.col("c_custkey") / BLOCK).alias("block"),
    )
    counts = c.groupBy("competition", "block").agg(F.count("*").alias("in_block"))
    by_block = Window.partitionBy("competition").orderBy("block")
    whole = Window.partitionBy("competition")
    offsets = counts.select(
        "competition",
        "block",
        (F.sum("in_block").over(by_block) - F.col("in_block")).alias("before"),
        F.sum("in_block").over(whole).alias("n"),
    )
    rank_in_block = F.row_number().over(Window.partitionBy("competition", "block").orderBy("team"))
    return (
        c.withColumn("rank_in_block", rank_in_block)
        .join(offsets, ["competition", "block"])
        .select("competition", "team", (F.col("before") + F.col("rank_in_block") - 1).alias("r"), "n")
    )


def shots(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = table(spark, sf_dir, "lineitem")
    odd = F.col("l_linenumber") % 2 == 1
    returned = F.col("l_returnflag") == "R"

    def total(cond) -> F.Column:
        return F.sum(F.when(cond, F.col("l_quantity")).otherwise(0.0))

    return line.groupBy(F.col("l_orderkey").alias("match_id")).agg(
        total(odd).alias("home_shots"),
        total(~odd).alias("away_shots"),
        total(odd & returned).alias("home_sot"),
        total(~odd & returned).alias("away_sot"),
    )


def _first_of_day_only(raw: DataFrame) -> DataFrame:
    # A match stays when it is the first of its date for both sides. The per-(entity, date) minimum is
    # combined before the shuffle, so an entity with a third of all rows costs no more than its dates.
    first_of_day = (
        raw.select("match_id", "match_date", F.explode(F.array("home_team", "away_team")).alias("team"))
        .groupBy("team", "match_date")
        .agg(F.min("match_id").alias("match_id"))
    )
    return first_of_day.groupBy("match_id").agg(F.count("*").alias("sides")).filter("sides = 2").select("match_id")


def encounters(spark: SparkSession, sf_dir: str, with_shots: bool = False, drop_clashes: bool = True) -> DataFrame:
    # Both sides read the same relation with the same filter, so its shuffles are planned once and reused.
    ranked = _ranked_customers(spark, sf_dir).filter("n > 1")
    home = ranked.select("competition", F.col("team").alias("home_team"), F.col("r").alias("home_rank"), "n")
    away = ranked.select("competition", F.col("team").alias("away_team"), F.col("r").alias("away_rank"))
    key = F.col("match_id")
    raw = (
        table(spark, sf_dir, "orders")
        .select(
            F.col("o_orderkey").alias("match_id"),
            F.col("o_custkey").alias("home_team"),
            F.col("o_orderdate").cast("date").alias("match_date"),
            (F.floor("o_totalprice") % 5).alias("home_goals"),
            (F.floor(F.col("o_totalprice") / 7) % 4).alias("away_goals"),
        )
        .join(home, "home_team")
        .withColumn("away_rank", (F.col("home_rank") + 1 + key % (F.col("n") - 1)) % F.col("n"))
        .join(away, ["competition", "away_rank"])
        .withColumn("odds_home", F.when(key % 11 != 0, 1.0 + (key % 37) / 10.0))
        .withColumn("odds_draw", 2.0 + (key % 13) / 10.0)
        .withColumn("odds_away", 1.2 + (key % 29) / 10.0)
    )
    if drop_clashes:
        raw = raw.join(_first_of_day_only(raw), "match_id")
    start = F.year("match_date") - F.when(F.month("match_date") < 8, 1).otherwise(0)
    season = F.concat(start.cast("string"), F.lit("-"), F.lpad(((start + 1) % 100).cast("string"), 2, "0"))
    out = raw.select(
        "match_id",
        "competition",
        "match_date",
        F.col("match_date").cast("timestamp_ntz").alias("match_datetime"),
        "home_team",
        "away_team",
        "home_goals",
        "away_goals",
        "odds_home",
        "odds_draw",
        "odds_away",
        F.when(F.col("home_goals") > F.col("away_goals"), "H")
        .when(F.col("home_goals") < F.col("away_goals"), "A")
        .otherwise("D")
        .alias("ftr"),
        season.alias("season"),
    )
    if with_shots:
        stats = ["home_shots", "away_shots", "home_sot", "away_sot"]
        out = out.join(shots(spark, sf_dir), "match_id", "left").fillna(0.0, subset=stats)
    return out


def stored(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    """The encounters as a written table, for plans that read them several times."""
    return stage(encounters(spark, sf_dir, **options), "encounters")


# The same binding as portable SQL; every oracle starts from the relation ``enc``.
ENC_SQL = """
cr as (
  select c_custkey, c_nationkey,
         row_number() over (partition by c_nationkey order by c_custkey) - 1 as r,
         count(*) over (partition by c_nationkey) as n
  from customer),
raw as (
  select o_orderkey as match_id, h.c_nationkey as competition, cast(o_orderdate as date) as match_date,
         h.c_custkey as home_team, a.c_custkey as away_team,
         cast(floor(o_totalprice) as bigint) % 5 as home_goals,
         cast(floor(o_totalprice / 7) as bigint) % 4 as away_goals,
         case when o_orderkey % 11 = 0 then null else 1.0e0 + (o_orderkey % 37) / 10.0e0 end as odds_home,
         2.0e0 + (o_orderkey % 13) / 10.0e0 as odds_draw,
         1.2e0 + (o_orderkey % 29) / 10.0e0 as odds_away
  from orders
  join cr h on o_custkey = h.c_custkey and h.n > 1
  join cr a on a.c_nationkey = h.c_nationkey and a.r = (h.r + 1 + o_orderkey % (h.n - 1)) % h.n),
sides as (select match_id, match_date, home_team as team from raw
          union all select match_id, match_date, away_team from raw),
clash as (select match_id from (
            select match_id, row_number() over (partition by team, match_date order by match_id) as rn
            from sides) s where rn > 1),
st as (select l_orderkey,
              sum(case when l_linenumber % 2 = 1 then l_quantity else 0 end) as home_shots,
              sum(case when l_linenumber % 2 = 0 then l_quantity else 0 end) as away_shots,
              sum(case when l_linenumber % 2 = 1 and l_returnflag = 'R' then l_quantity else 0 end) as home_sot,
              sum(case when l_linenumber % 2 = 0 and l_returnflag = 'R' then l_quantity else 0 end) as away_sot
       from lineitem group by l_orderkey),
enc as materialized (
select raw.*,
       case when home_goals > away_goals then 'H' when home_goals < away_goals then 'A' else 'D' end as ftr,
       concat(cast(year(match_date) - case when month(match_date) < 8 then 1 else 0 end as varchar), '-',
              lpad(cast((year(match_date) + case when month(match_date) < 8 then 0 else 1 end) % 100 as varchar), 2, '0')) as season,
       coalesce(home_shots, 0) as home_shots, coalesce(away_shots, 0) as away_shots,
       coalesce(home_sot, 0) as home_sot, coalesce(away_sot, 0) as away_sot
from raw left join st on st.l_orderkey = raw.match_id
where not exists (select 1 from clash where clash.match_id = raw.match_id))"""


def with_enc(body: str, ctes: str = "", recursive: bool = False) -> str:
    head = "with recursive" if recursive else "with"
    tail = f",\n{ctes.strip()}" if ctes else ""
    return f"{head}{ENC_SQL}{tail}\n{body.strip()}"


# Raw text rows as a season file would hold them, with every kind of defect. The expressions run unchanged in
# both engines.
_D, _M, _Y = (
    "lpad(cast(day(o_orderdate) as string), 2, '0')",
    "lpad(cast(month(o_orderdate) as string), 2, '0')",
    "cast(year(o_orderdate) as string)",
)
RAW_EXPRESSIONS = {
    "row_id": "o_orderkey",
    "Date": f"case o_orderkey % 6 when 0 then concat({_D}, '/', {_M}, '/', {_Y})"
    f" when 1 then concat({_D}, '/', {_M}, '/', right({_Y}, 2))"
    f" when 2 then concat({_Y}, '-', {_M}, '-', {_D})"
    f" when 3 then concat({_M}, '/', {_D}, '/', {_Y})"
    f" when 4 then concat(' ', {_D}, '/', {_M}, '/', {_Y}, ' ')"
    " else case when o_orderkey % 12 = 5 then 'n/a' else null end end",
    "Time": "case o_orderkey % 4 when 0 then null when 1 then '15:30' when 2 then 'late' else '7:05' end",
    "HomeTeam": "case o_orderkey % 17 when 0 then ' Man United ' when 1 then 'Spurs' when 2 then null"
    " when 3 then 'Newcastle' else concat('T', cast(o_custkey % 500 as string)) end",
    "AwayTeam": "case o_orderkey % 19 when 0 then concat('T', cast(o_custkey % 500 as string)) when 1 then 'Wolves '"
    " when 2 then null else concat(' T', cast((o_custkey * 7 + o_orderkey) % 500 as string)) end",
    "FTHG": "case o_orderkey % 23 when 0 then 'x' when 1 then null"
    " else cast(cast(floor(o_totalprice) as bigint) % 5 as string) end",
    "FTAG": "cast(cast(floor(o_totalprice / 7) as bigint) % 4 as string)",
    "FTR": "case o_orderkey % 7 when 0 then null when 1 then 'h' when 2 then 'A' when 3 then 'H' when 4 then 'D' else '' end",
    "PSH": "case when o_orderkey % 13 = 0 then '' else cast((100 + o_orderkey % 300) / 100.0e0 as string) end",
    "PSD": "case when o_orderkey % 29 = 0 then 'evs' else cast((200 + o_orderkey % 130) / 100.0e0 as string) end",
    "PSA": "cast((120 + o_orderkey % 290) / 100.0e0 as string)",
    "WHH": "'9.0'",
    "WHD": "'9.0'",
    "WHA": "'9.0'",
}


def raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*[f"{e} as {n}" for n, e in RAW_EXPRESSIONS.items()])


RAWT_SQL = "rawt as (select " + ", ".join(f'{e} as "{n}"' for n, e in RAW_EXPRESSIONS.items()) + " from orders)"

_TXT = 'trim("Date")'
DATE_SQL = (
    f"cast(case when regexp_matches({_TXT}, '^[0-9]+/[0-9]+/[0-9]{{4}}$')"
    f" then coalesce(try_strptime({_TXT}, '%d/%m/%Y'), try_strptime({_TXT}, '%m/%d/%Y'))"
    f" when regexp_matches({_TXT}, '^[0-9]+/[0-9]+/[0-9]{{2}}$')"
    f" then coalesce(try_strptime({_TXT}, '%d/%m/%y'), try_strptime({_TXT}, '%m/%d/%y'))"
    f" else try_strptime({_TXT}, '%Y-%m-%d') end as date)"
)


def alias_sql(column: str, aliases: dict[str, str]) -> str:
    cases = " ".join("when '{}' then '{}'".format(k.replace("'", "''"), v) for k, v in aliases.items())
    return f'case trim("{column}") {cases} else trim("{column}") end'

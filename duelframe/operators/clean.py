"""Raw rows to the clean match, extended match and fixture tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duelframe.functions import scalars as S
from duelframe.operators.ordering import dense_index
from duelframe.schema import ALIASES, INGEST_ALIASES, MATCHES, PRICE_TRIPLES

# Column names of the raw files and of the tables built from them.
REQUIRED = ("Date", "HomeTeam", "AwayTeam", "FTHG", "FTAG")
FIXTURE_REQUIRED = ("Date", "HomeTeam", "AwayTeam")
RENAMES = {
    "Date": "match_date",
    "Time": "kickoff_time",
    "HomeTeam": "home_team",
    "AwayTeam": "away_team",
    "FTHG": "home_goals",
    "FTAG": "away_goals",
    "FTR": "ftr",
}
SHOT_RENAMES = {
    "HS": "home_shots",
    "AS": "away_shots",
    "HST": "home_shots_on_target",
    "AST": "away_shots_on_target",
}
KEY = ("season", "match_date", "home_team", "away_team")


def require_columns(df: DataFrame, required: Sequence[str], what: str) -> None:
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"{what} missing required columns: {missing}")


def price_columns(raw: DataFrame) -> dict[str, Column]:
    """Prices of the first provider whose three columns all exist in the file; NULL without one."""
    for triple in PRICE_TRIPLES:
        if set(triple) <= set(raw.columns):
            return dict(zip(("odds_home", "odds_draw", "odds_away"), [S.to_number(c) for c in triple]))
    return {c: F.lit(None).cast("double") for c in ("odds_home", "odds_draw", "odds_away")}


def present_or_null(df: DataFrame, name: str, kind: str = "string") -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def is_valid(scores: bool = True) -> Column:
    """True for a row with a date, two different sides and (for played matches) a score; never NULL."""
    out = F.coalesce(F.col("home_team") != F.col("away_team"), F.lit(False))
    for c in ["match_date"] + (["home_goals", "away_goals"] if scores else []):
        out = out & F.col(c).isNotNull()
    return out


def valid_rows(df: DataFrame, scores: bool = True) -> DataFrame:
    """Drop rows without a date, a side or (for played matches) a score, and matches of an entity with itself."""
    return df.filter(is_valid(scores))


def invalid_row_counts(df: DataFrame, scores: bool = True) -> DataFrame:
    """One row: all rows, those ``valid_rows`` keeps and those it drops, in one pass instead of a count before and after."""
    valid = F.count_if(is_valid(scores))
    return df.agg(F.count("*").alias("n_rows"), valid.alias("n_valid"), (F.count("*") - valid).alias("n_invalid"))


def fill_missing(df: DataFrame, constants: Mapping[str, float], rest: float | None = 0) -> DataFrame:
    """Named columns filled with their constants, then every other numeric column with ``rest`` (None: left as they are).

    Text, dates and other kinds keep their NULLs; NaN counts as missing. A constant for a column that is not there is an
    error.
    """
    require_columns(df, list(constants), "table to fill")
    out = df.fillna(dict(constants)) if constants else df
    return out if rest is None else out.fillna(rest)


def clean_season(raw: DataFrame, season: Column, aliases: Mapping[str, str] = ALIASES) -> DataFrame:
    """One raw file to clean rows, not yet numbered or deduplicated."""
    require_columns(raw, REQUIRED, "season file")
    typed = raw.select(
        season.alias("season"),
        S.parse_date("Date").alias("match_date"),
        present_or_null(raw, "Time").alias("kickoff_time"),
        S.normalise_name("HomeTeam", aliases).alias("home_team"),
        S.normalise_name("AwayTeam", aliases).alias("away_team"),
        S.to_number("FTHG").cast("int").alias("home_goals"),
        S.to_number("FTAG").cast("int").alias("away_goals"),
        present_or_null(raw, "FTR").alias("ftr"),
        *[c.alias(n) for n, c in price_columns(raw).items()],
    )
    return valid_rows(typed).select(
        "season",
        "match_date",
        S.kickoff_timestamp("match_date", "kickoff_time").alias("match_datetime"),
        "home_team",
        "away_team",
        "home_goals",
        "away_goals",
        S.validated_result("ftr", "home_goals", "away_goals").alias("ftr"),
        "odds_home",
        "odds_draw",
        "odds_away",
    )


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Keep the first row of each key in ``order``.

    The rank limit is applied on the map side too, so a key with very many copies ships one row per task.
    """
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def number_matches(clean: DataFrame) -> DataFrame:
    """Drop repeated fixtures, then number the rest 1..n in chronological order."""
    # Everything after the kickoff only breaks ties, so that a rerun keeps the same copy.
    ties = ["home_goals", "away_goals", "ftr", "odds_home", "odds_draw", "odds_away"]
    kept = first_per_key(clean, KEY, ["match_datetime", *ties])
    return dense_index(kept, ["match_datetime", "home_team", "away_team", *ties], "match_id").select(*MATCHES.fieldNames())


def duplicate_count(clean: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """One row: rows, distinct keys and dropped copies."""
    per_key = clean.groupBy(*key).agg(F.count("*").alias("c"))
    return per_key.agg(
        F.sum("c").alias("n_rows"), F.count("*").alias("n_kept"), F.sum(F.col("c") - 1).alias("n_dropped")
    )


def clean_fixtures(raw: DataFrame, aliases: Mapping[str, str] = ALIASES) -> DataFrame:
    require_columns(raw, FIXTURE_REQUIRED, "fixtures file")
    typed = raw.select(
        S.parse_date("Date").alias("match_date"),
        S.normalise_name("HomeTeam", aliases).alias("home_team"),
        S.normalise_name("AwayTeam", aliases).alias("away_team"),
        *[c.alias(n) for n, c in price_columns(raw).items()],
    )
    return valid_rows(typed, scores=False)


def clean_extended(raw: DataFrame, season: Column, source: str, aliases: Mapping[str, str] = INGEST_ALIASES) -> DataFrame:
    """One raw file to the extended layout: shots, status, source and natural key."""
    require_columns(raw, REQUIRED, "season file")
    typed = raw.select(
        season.alias("season"),
        S.parse_date("Date").alias("match_date"),
        F.coalesce(present_or_null(raw, "Time"), F.lit("00:00")).alias("kickoff_time"),
        S.normalise_name("HomeTeam", aliases).alias("home_team"),
        S.normalise_name("AwayTeam", aliases).alias("away_team"),
        S.to_number("FTHG").cast("int").alias("home_goals"),
        S.to_number("FTAG").cast("int").alias("away_goals"),
        present_or_null(raw, "FTR").alias("ftr"),
        *[(S.to_number(c) if c in raw.columns else F.lit(None).cast("double")).alias(n) for c, n in SHOT_RENAMES.items()],
    )
    return valid_rows(typed).select(
        "season",
        "match_date",
        "kickoff_time",
        S.kickoff_timestamp("match_date", "kickoff_time").alias("match_datetime"),
        "home_team",
        "away_team",
        "home_goals",
        "away_goals",
        S.validated_result("ftr", "home_goals", "away_goals").alias("full_time_result"),
        *SHOT_RENAMES.values(),
        F.lit("completed").alias("status"),
        F.lit(source).alias("source"),
        S.natural_key("season", "match_date", "home_team", "away_team").alias("source_match_id"),
    )

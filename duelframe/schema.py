"""Fixed column lists, priors and rating constants shared by every operator."""

from __future__ import annotations

from pyspark.sql import types as T

# Class order and the label encoding it implies (H=0, D=1, A=2).
CLASSES = ("H", "D", "A")

# Defaults used while an entity has no history.
PRIORS = {
    "points": 1.35,
    "goals_for": 1.35,
    "goals_against": 1.35,
    "goal_diff": 0.0,
    "rest_days": 7.0,
}

# Rating update constants.
ELO = {"initial_rating": 1500.0, "k_factor": 20.0, "home_advantage": 60.0}

# Price triples in order of preference.
PRICE_TRIPLES = (
    ("B365H", "B365D", "B365A"),
    ("PSH", "PSD", "PSA"),
    ("WHH", "WHD", "WHA"),
    ("AvgH", "AvgD", "AvgA"),
)

# Entity aliases; unknown names pass through.
ALIASES = {
    "Nott'm Forest": "Nottingham Forest",
    "Man United": "Manchester United",
    "Man City": "Manchester City",
    "Spurs": "Tottenham",
    "Wolves": "Wolverhampton Wanderers",
    "Newcastle": "Newcastle United",
    "Leicester": "Leicester City",
}

# The five-entry alias set of the season ingester (a subset of the above).
INGEST_ALIASES = {
    name: ALIASES[name]
    for name in ("Nott'm Forest", "Man United", "Man City", "Spurs", "Wolves")
}

# The 24 model features, in model order.
FEATURES = (
    "home_points_5",
    "home_points_10",
    "away_points_5",
    "away_points_10",
    "home_goal_diff_5",
    "home_goal_diff_10",
    "away_goal_diff_5",
    "away_goal_diff_10",
    "home_goals_for_5",
    "away_goals_for_5",
    "home_goals_against_5",
    "away_goals_against_5",
    "home_home_points_5",
    "away_away_points_5",
    "home_rest_days",
    "away_rest_days",
    "rest_days_diff",
    "elo_home",
    "elo_away",
    "elo_diff",
    "implied_home",
    "implied_draw",
    "implied_away",
    "implied_edge_home_minus_away",
)

# The columns that go along with the features.
FEATURE_KEYS = (
    "match_id",
    "season",
    "match_date",
    "home_team",
    "away_team",
    "ftr",
    "home_goals",
    "away_goals",
)

# The layout of the match table.
MATCHES = T.StructType(
    [
        T.StructField("match_id", T.LongType()),
        T.StructField("season", T.StringType()),
        T.StructField("match_date", T.DateType()),
        T.StructField("match_datetime", T.TimestampNTZType()),
        T.StructField("home_team", T.StringType()),
        T.StructField("away_team", T.StringType()),
        T.StructField("home_goals", T.IntegerType()),
        T.StructField("away_goals", T.IntegerType()),
        T.StructField("ftr", T.StringType()),
        T.StructField("odds_home", T.DoubleType()),
        T.StructField("odds_draw", T.DoubleType()),
        T.StructField("odds_away", T.DoubleType()),
    ]
)

# The layout of the flat statistics file (declared, no inference pass).
STATS_CSV = T.StructType(
    [
        T.StructField("season", T.IntegerType()),
        T.StructField("date", T.DateType()),
        T.StructField("home_team", T.StringType()),
        T.StructField("away_team", T.StringType()),
        T.StructField("home_goals", T.IntegerType()),
        T.StructField("away_goals", T.IntegerType()),
        T.StructField("home_shots", T.IntegerType()),
        T.StructField("away_shots", T.IntegerType()),
        T.StructField("home_shots_on_target", T.IntegerType()),
        T.StructField("away_shots_on_target", T.IntegerType()),
        T.StructField("home_corners", T.IntegerType()),
        T.StructField("away_corners", T.IntegerType()),
        T.StructField("home_fouls", T.IntegerType()),
        T.StructField("away_fouls", T.IntegerType()),
        T.StructField("result", T.StringType()),
    ]
)

# The chronological order every ordered operator uses.
MATCH_ORDER = ("match_datetime", "home_team", "away_team", "match_id")

"""Entity dimension, model registry and prediction listing as table operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duelframe.functions import scalars as S


def entity_universe(matches: DataFrame) -> DataFrame:
    """Distinct entities of both sides."""
    return matches.select(F.explode(F.array("home_team", "away_team")).alias("name")).filter("name is not null").distinct()


def numbered_universe(matches: DataFrame) -> DataFrame:
    """Entities with ids from 1 in name order."""
    from duelframe.operators.ordering import dense_index

    return dense_index(entity_universe(matches), ["name"], "id").select("id", "name")


def seasons_in_order(matches: DataFrame) -> DataFrame:
    return matches.select(F.col("season").alias("label")).filter("label is not null").distinct().orderBy(S.season_start_year("label"))


def list_matches(matches: DataFrame, season: str = "") -> DataFrame:
    """Matches of one season (blank: all) with ISO dates, in date and side order."""
    chosen = season.strip()
    rows = matches.filter(F.col("season") == chosen) if chosen else matches
    return rows.select(
        "match_id",
        "season",
        S.iso_day("match_date").alias("match_date"),
        "home_team",
        "away_team",
        "home_goals",
        "away_goals",
        "ftr",
    ).orderBy("match_date", "home_team", "away_team")


def known_only(requests: DataFrame, entities: DataFrame, column: str, name: str = "name") -> DataFrame:
    return requests.join(entities.select(F.col(name).alias(column)), column, "left_semi")


def unknown_only(requests: DataFrame, entities: DataFrame, column: str, name: str = "name") -> DataFrame:
    return requests.join(entities.select(F.col(name).alias(column)), column, "left_anti")


def sync_entities(existing: DataFrame, matches: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Add missing entities, delete none: the new dimension (``name, created``) and its one-row counts."""
    universe = entity_universe(matches).select(F.trim(F.col("name").cast("string")).alias("name")).distinct()
    have = existing.select("name").distinct().withColumn("_have", F.lit(True))
    seen = universe.withColumn("_seen", F.lit(True))
    merged = have.join(seen, "name", "full_outer")
    table = merged.select("name", F.col("_have").isNull().alias("created"))
    counts = merged.agg(
        F.count_if(F.col("_have").isNull()).alias("created_count"),
        F.count_if(F.col("_have").isNotNull() & F.col("_seen").isNotNull()).alias("existing_count"),
    )
    return table, counts


def upsert_model(registry: DataFrame, current: DataFrame) -> DataFrame:
    """Insert or update by ``version``; the given version becomes the only active one."""
    fields = [c for c in registry.columns if c not in ("version", "is_active", "created_at")]
    columns = ["version", *fields, "created_at"]
    tagged = registry.select(*columns, F.lit(0).alias("_tag")).unionByName(current.select(*columns, F.lit(1).alias("_tag")))
    # A version occurs at most twice; the current row wins, the first creation time stays.
    return tagged.groupBy("version").agg(
        *[F.max_by(c, "_tag").alias(c) for c in fields],
        F.min_by("created_at", "_tag").alias("created_at"),
        (F.max("_tag") == 1).alias("is_active"),
    )


def newest_active(registry: DataFrame) -> DataFrame:
    return registry.filter("is_active").orderBy(F.desc("created_at"), F.desc("version")).limit(1)


def prediction_listing(results: DataFrame, requests: DataFrame, entities: DataFrame, models: DataFrame, result_id: int | None = None) -> DataFrame:
    """Results with side names, date and model version, newest first; optionally one result only."""
    if result_id is not None:
        results = results.filter(F.col("id") == result_id)
    home = entities.select(F.col("entity_id").alias("home_id"), F.col("name").alias("home_team"))
    away = entities.select(F.col("entity_id").alias("away_id"), F.col("name").alias("away_team"))
    version = models.select("model_id", F.col("version").alias("model_version"))
    return (
        results.join(requests, "request_id")
        .join(home, "home_id")
        .join(away, "away_id")
        .join(version, "model_id")
        .select("id", "home_team", "away_team", "match_date", "p_home", "p_draw", "p_away", "predicted_outcome", "model_version", "created_at")
        .orderBy(F.desc("created_at"), F.desc("id"))
    )


def registry_health(registry: DataFrame, features: DataFrame, metadata: DataFrame) -> DataFrame:
    """Status of each expected version: artifact, then feature list, then metadata must exist.

    ``registry`` rows are (version, artifact_path); ``features`` (version, n_features); ``metadata`` (version).
    """
    status = (
        F.when(F.col("artifact_path").isNull(), "model_not_loaded")
        .when(F.coalesce("n_features", F.lit(0)) == 0, "feature_list_missing")
        .when(F.col("_meta").isNull(), "metadata_missing")
        .otherwise("ok")
    )
    return (
        registry.join(features, "version", "left")
        .join(metadata.select("version").distinct().withColumn("_meta", F.lit(True)), "version", "left")
        .select("version", status.alias("status"), F.col("artifact_path").isNotNull().alias("artifact_loaded"))
    )


def best_candidate(candidates: DataFrame, metric: Column, ordinal: str = "ordinal") -> DataFrame:
    """The row with the smallest metric; ties go to the earlier candidate. Negate the metric for a maximum."""
    return candidates.orderBy(metric, ordinal).limit(1)


def best_per_group(candidates: DataFrame, by: str, metric: Column, name: str, ordinal: str = "ordinal") -> DataFrame:
    return candidates.groupBy(by).agg(F.min_by(name, F.struct(metric.alias("m"), F.col(ordinal).alias("o"))).alias("selected"))

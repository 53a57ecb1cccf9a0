import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture(scope="session")
def enc(spark, sf_dir):
    from duelframe.catalog.testbed import encounters
    from duelframe.session import stage

    return stage(encounters(spark, sf_dir, with_shots=True), "test-encounters")


@pytest.fixture(scope="session")
def matches_of(spark):
    """Build a small match table from (date, home, away, home goals, away goals) tuples."""
    from pyspark.sql import functions as F

    from duelframe.functions.scalars import result_from_score

    def build(rows, season="2020-21", odds=(2.0, 3.0, 4.0)):
        data = [(i + 1, *r) for i, r in enumerate(rows)]
        df = spark.createDataFrame(data, "match_id long, d string, home_team string, away_team string, home_goals int, away_goals int")
        return df.select(
            "match_id",
            F.lit(season).alias("season"),
            F.lit(1).alias("competition"),
            F.to_date("d").alias("match_date"),
            F.to_date("d").cast("timestamp_ntz").alias("match_datetime"),
            "home_team",
            "away_team",
            "home_goals",
            "away_goals",
            result_from_score("home_goals", "away_goals").alias("ftr"),
            *[F.lit(o).alias(n) for o, n in zip(odds, ("odds_home", "odds_draw", "odds_away"))],
        )

    return build

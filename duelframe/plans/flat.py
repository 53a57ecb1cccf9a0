"""Two pipelines over flat match statistics, end to end: features, split by time, two classifiers, reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duelframe.functions import scalars as S
from duelframe.operators import clean, form, models, splits
from duelframe.session import stage
from duelframe.sources import writers

COUNTS = tuple(f"{side}_{what}" for what in ("shots", "shots_on_target", "corners", "fouls") for side in ("home", "away"))
SEASON_FEATURES = (*COUNTS, "goal_diff", "home_shot_acc", "away_shot_acc", "home_form_pts", "away_form_pts")
CALENDAR_FEATURES = (*COUNTS, "home_form_scored", "away_form_conceded")
KINDS = ("lr", "rf")


def season_features(stats: DataFrame) -> DataFrame:
    """Three-class target, goal difference, shot accuracy and venue form of every match."""
    named = stats.withColumnsRenamed({"date": "match_date", "result": "ftr"})
    return form.venue_form(named).withColumns(
        {
            "label": S.descending_target("ftr").cast("double"),
            "goal_diff": F.col("home_goals") - F.col("away_goals"),
            "home_shot_acc": F.col("home_shots_on_target") / (F.col("home_shots") + 1),
            "away_shot_acc": F.col("away_shots_on_target") / (F.col("away_shots") + 1),
        }
    )


def calendar_features(stats: DataFrame, years: int = 5) -> DataFrame:
    """Home-win target and means of the goals scored at home and conceded away over so many years."""
    named = stats.withColumnsRenamed({"date": "match_date", "result": "ftr"})
    specs = [("home_team", "home_goals", "home_form_scored"), ("away_team", "away_goals", "away_form_conceded")]
    return form.calendar_form(named, "match_date", specs, years * 365).withColumn("label", S.home_win_target("ftr").cast("double"))


def _fitted(data: DataFrame, columns: Sequence[str], classes: Column, actual: Column, tuned: bool) -> tuple[DataFrame, DataFrame]:
    """Scored validation and test rows of both classifiers, and their metric rows. Missing counts are zero."""
    data = stage(clean.fill_missing(data, dict.fromkeys(columns, 0), None), "flat-rows")
    checked = None
    for kind in KINDS:
        model = models.fit_flat(data.filter("split = 'train'"), columns, kind, centred=tuned, tuned=tuned)
        scored = model.transform(data.filter("split <> 'train'"))
        one = scored.withColumns({"model": F.lit(kind), "p": vector_to_array("probability")}).drop("_raw", "_x", "rawPrediction", "probability")
        checked = one if checked is None else checked.unionByName(one)
    checked = stage(checked.withColumns({"predicted": classes, "actual": actual}), "flat-scored")
    return checked, stage(weighted_scores(checked, ["model", "split"]), "flat-metrics")


def weighted_scores(checked: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows, accuracy and the F1 of each class weighted by how often it is there, from ``actual`` and ``predicted``.

    Rows are counted by cell first, so everything behind is as many rows as there are groups and classes.
    """
    cells = checked.groupBy(*by, "actual", "predicted").agg(F.count("*").alias("n"))
    same = F.col("actual") == F.col("predicted")
    totals = cells.groupBy(*by).agg(F.sum("n").alias("n_rows"), (F.sum(F.when(same, F.col("n")).otherwise(0)) / F.sum("n")).alias("accuracy"))
    sides = F.array(
        F.struct(F.col("actual").alias("c"), F.col("n").alias("there"), F.lit(0).cast("long").alias("said")),
        F.struct(F.col("predicted").alias("c"), F.lit(0).cast("long").alias("there"), F.col("n").alias("said")),
    )
    by_class = cells.select(*by, F.when(same, F.col("n")).otherwise(0).alias("right"), F.explode(sides).alias("e"))
    by_class = by_class.groupBy(*by, "e.c").agg(F.sum("e.there").alias("there"), F.sum("e.said").alias("said"), F.sum(F.when(F.col("e.there") > 0, F.col("right")).otherwise(0)).alias("right"))
    f1 = F.when(F.col("there") + F.col("said") > 0, 2 * F.col("right") / (F.col("there") + F.col("said"))).otherwise(0.0)
    weighted = by_class.groupBy(*by).agg((F.sum(F.col("there") * f1) / F.sum("there")).alias("f1"))
    return totals.join(weighted, list(by))


def run_by_season(stats: DataFrame, output_path: str, last_train: int = 2022, validation: int = 2023, run_date: str | None = None) -> DataFrame:
    """Three classes, split by season: metric rows by model and split, also written; the last model's test rows as CSV.

    ``stats`` are rows of the flat statistics file with a number or a label as ``season``.
    """
    data = season_features(stats)
    year = F.substring(F.col("season").cast("string"), 1, 4).cast("int")
    data = data.withColumn("split", splits.year_split(year, last_train, validation)).filter("split is not null")
    label = F.element_at(F.array(F.lit("A"), F.lit("D"), F.lit("H")), F.col("prediction").cast("int") + 1)
    scored, rows = _fitted(data, SEASON_FEATURES, label, F.coalesce("ftr", F.lit("A")), tuned=True)
    report = scored.filter((F.col("split") == "test") & (F.col("model") == KINDS[-1]))
    writers.write_csv(report.select("season", "match_date", "home_team", "away_team", F.col("ftr").alias("result"), F.col("prediction").cast("int").alias("predicted"), "home_form_pts", "away_form_pts"), f"{output_path}/report")
    writers.write_small_csv(rows, f"{output_path}/metrics", run_date)
    return rows


def run_by_share(stats: DataFrame, output_path: str, train: float = 0.5, validation: float = 0.1, run_date: str | None = None) -> DataFrame:
    """Home win or not, split by share of rows at date boundaries: metric rows by model and split, also written.

    The test rows with the probabilities of the model with the better validation F1 are written as CSV: test rows
    judge, they do not choose.
    """
    data = splits.fraction_split(stage(calendar_features(stats), "flat-features"), "match_date", train, validation)
    scored, rows = _fitted(data, CALENDAR_FEATURES, F.col("prediction").cast("int"), F.col("label").cast("int"), tuned=False)
    best = rows.filter("split = 'validation'").orderBy(F.desc("f1"), "model").first()
    chosen = best["model"] if best else KINDS[0]
    report = scored.filter((F.col("split") == "test") & (F.col("model") == chosen))
    writers.write_csv(report.select("match_date", "home_team", "away_team", F.col("ftr").alias("result"), "prediction", F.col("p")[1].alias("probability")), f"{output_path}/predictions_report")
    writers.write_small_csv(rows, f"{output_path}/metrics", run_date)
    return rows.withColumn("chosen", F.col("model") == chosen)

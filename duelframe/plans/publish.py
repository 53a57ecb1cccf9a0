"""The two plans that use a published model: evaluate it into a report, and predict fixtures into a file."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelframe.operators import metrics, models, splits
from duelframe.plans import train
from duelframe.session import dropped, stage
from duelframe.sources import writers
from duelframe.sources.readers import exists

_KEPT = ("log_loss", "accuracy", "brier")


def _published(features: DataFrame, model_path: str, version: str | None):
    if not exists(features.sparkSession, f"{model_path.rstrip('/')}/{version or 'latest'}"):
        raise FileNotFoundError(f"no model under {model_path}: train one first")
    return writers.load_model(features.sparkSession, model_path, version)


def evaluate_and_report(
    features: DataFrame,
    lists: Mapping[str, Sequence[str]],
    model_path: str,
    report_path: str,
    log_path: str,
    fit_folds: Callable[[DataFrame], Mapping[int, Any]] = models.fit_boosted_folds,
    version: str | None = None,
) -> dict:
    """Everything that is said about a published model, in one run: returns the report.

    ``report_path`` gets ``evaluation_report`` (metrics of validation and test rows, overall and by season, the rolling
    backtest with models of ``fit_folds``, and what the model is), and as tables what plots would show: the confusion
    matrix and the calibration curve of test rows. A line goes to the run log. Rows are scored once; an empty
    validation or test split is an error, as is a missing model.
    """
    spark = features.sparkSession
    model, meta = _published(features, model_path, version)
    data = features.withColumn("split", splits.season_split("season", lists))
    splits.require_splits(data, ["validation", "test"])
    scored = train.score(model, data.filter(F.col("split").isin("validation", "test")))
    scored = stage(scored.select("split", "season", "ftr", *metrics.PROBS), "evaluated")
    test = scored.filter("split = 'test'")
    root = report_path.rstrip("/")
    writers.write_small_csv(metrics.confusion_matrix(test), f"{root}/confusion_matrix_test")
    writers.write_small_csv(metrics.calibration_curve(test), f"{root}/calibration_test")
    parts: dict[str, dict] = {name: {"by_season": {}} for name in ("validation", "test")}
    for r in train.split_metrics(scored).collect():  # one row a season
        values = {"n_rows": r["n_rows"], **{k: r[k] for k in _KEPT}}
        if r["season"] == "overall":
            parts[r["split"]]["overall"] = values
        else:
            parts[r["split"]]["by_season"][r["season"]] = values
    names = {"selected_model_name": meta.get("selected_model_name", "unknown"), "main_calibration_method": meta.get("main_calibration_method", "unknown")}
    report = {
        **names,
        "model_version": meta["version"],
        **parts,
        "rolling_backtest": [r.asDict() for r in train.rolling_backtest(features, fit_folds).collect()],
        "tables": {k: f"{root}/{k}" for k in ("confusion_matrix_test", "calibration_test")},
    }
    dropped(scored)
    writers.write_json(spark, report, f"{root}/evaluation_report")
    line = {"selected_model": names["selected_model_name"], "calibration": names["main_calibration_method"]}
    line |= {f"{s}_{k}": float(parts[p]["overall"][k]) for s, p, k in (("val", "validation", "accuracy"), ("val", "validation", "log_loss"), ("test", "test", "accuracy"), ("test", "test", "log_loss"), ("test", "test", "brier"))}
    writers.append_run_log(spark, log_path, "evaluate", line)
    return report


def predict_and_publish(
    history: DataFrame,
    fixtures: DataFrame,
    model_path: str,
    output_path: str,
    log_path: str,
    competition: str | None = None,
    version: str | None = None,
    keep: tuple[str, ...] = (),
    fixtures_name: str = "fixtures",
) -> DataFrame:
    """Predictions of the latest (or a named) model for every fixture, written as CSV and read back, with a log line."""
    model, meta = _published(history, model_path, version)
    found = train.predict_fixtures(model, meta.get("trained_at") or meta["version"], history, fixtures, competition, keep)
    writers.write_csv(found, output_path)
    back = history.sparkSession.read.schema(found.schema).csv(output_path, header=True)
    payload = {"fixtures_file": fixtures_name, "predictions_file": output_path, "n_predictions": back.count(), "model_version": meta.get("trained_at") or meta["version"]}
    writers.append_run_log(history.sparkSession, log_path, "predict", payload)
    return back

"""Metrics of probability triples, as single-pass aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duelframe.functions import scalars as S
from duelframe.operators.ordering import grouped_quantiles
from duelframe.schema import CLASSES
from duelframe.session import stage

PROBS = ("p_home", "p_draw", "p_away")
EPS = 2.220446049250313e-16


def class_frequencies(df: DataFrame, label: str = "ftr") -> DataFrame:
    return df.agg(
        *[F.avg(F.when(F.col(label) == c, 1.0).otherwise(0.0)).alias(p) for c, p in zip(CLASSES, PROBS)]
    )


def row_scores(label: str = "ftr", probs: Sequence[str] = PROBS, eps: float = EPS) -> dict[str, Column]:
    """Per-row hit, log loss and Brier score."""
    h, d, a = (F.col(c) for c in probs)
    true = F.when(F.col(label) == "H", h).when(F.col(label) == "D", d).otherwise(a)
    hot = [F.when(F.col(label) == c, 1.0).otherwise(0.0) for c in CLASSES]
    errors = [(p - o) * (p - o) for p, o in zip((h, d, a), hot)]
    return {
        "hit": (S.predicted_label(h, d, a) == F.col(label)).cast("double"),
        "loss": -F.log(F.greatest(F.least(true, F.lit(1.0 - eps)), F.lit(eps))),
        "square": errors[0] + errors[1] + errors[2],
    }


def _means(n: str, hit: str, loss: str, square: str) -> list[Column]:
    return [
        F.col(n).alias("n_rows"),
        (F.col(loss) / F.col(n)).alias("log_loss"),
        (F.col(hit) / F.col(n)).alias("accuracy"),
        (F.col(square) / F.col(n)).alias("brier"),
    ]


def compute_metrics(df: DataFrame, by: Sequence[str] = (), label: str = "ftr", probs: Sequence[str] = PROBS) -> DataFrame:
    """Rows, log loss, accuracy and Brier score, overall or by group, in one aggregate."""
    scores = row_scores(label, probs)
    sums = df.groupBy(*by).agg(F.count("*").alias("_n"), *[F.sum(c).alias(f"_{k}") for k, c in scores.items()])
    return sums.select(*by, *_means("_n", "_hit", "_loss", "_square"))


def metrics_by_season(df: DataFrame, season: str = "season", label: str = "ftr", probs: Sequence[str] = PROBS) -> DataFrame:
    """Metrics of every season plus an ``overall`` row.

    The rows are read once: the total is rolled up from the per-season sums, not from a second pass.
    """
    scores = row_scores(label, probs)
    sums = df.groupBy(season).agg(F.count("*").alias("_n"), *[F.sum(c).alias(f"_{k}") for k, c in scores.items()])
    rolled = sums.rollup(season).agg(*[F.sum(c).alias(c) for c in ("_n", "_hit", "_loss", "_square")])
    return rolled.select(
        F.coalesce(season, F.lit("overall")).alias(season),
        F.coalesce(S.season_start_year(season), F.lit(-1)).alias("start_year"),
        *_means("_n", "_hit", "_loss", "_square"),
    )


def cell_counts(actual: Column, predicted: Column) -> list[Column]:
    """Nine counters, one per (actual, predicted) cell."""
    return [
        F.count_if((actual == a) & (predicted == p)).alias(f"c_{a}{p}") for a in CLASSES for p in CLASSES
    ]


def confusion_matrix(df: DataFrame, label: str = "ftr", probs: Sequence[str] = PROBS) -> DataFrame:
    """Long confusion matrix with all nine cells, zeros included; one pass, no label grid join."""
    counted = df.agg(*cell_counts(F.col(label), S.predicted_label(*probs)))
    cells = [
        F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(f"c_{a}{p}").alias("n"))
        for a in CLASSES
        for p in CLASSES
    ]
    return counted.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")


def classification_scores() -> dict[str, Column]:
    """Accuracy, weighted F1 and macro precision / recall / F1 from the nine cell counters.

    A class that is never predicted has precision 0, one that never occurs recall 0.
    """
    cell = lambda a, p: F.col(f"c_{a}{p}")
    total = sum((cell(a, p) for a in CLASSES for p in CLASSES), F.lit(0))
    per_class = []
    for c in CLASSES:
        actual = sum((cell(c, p) for p in CLASSES), F.lit(0))
        predicted = sum((cell(a, c) for a in CLASSES), F.lit(0))
        precision = F.coalesce(F.try_divide(cell(c, c), predicted), F.lit(0.0))
        recall = F.coalesce(F.try_divide(cell(c, c), actual), F.lit(0.0))
        f1 = F.coalesce(F.try_divide(2 * precision * recall, precision + recall), F.lit(0.0))
        per_class.append((actual, precision, recall, f1))
    return {
        "n_rows": total,
        "accuracy": sum((cell(c, c) for c in CLASSES), F.lit(0)) / total,
        "weighted_f1": sum((n * f1 for n, _, _, f1 in per_class), F.lit(0.0)) / total,
        "precision": sum((p for _, p, _, _ in per_class), F.lit(0.0)) / 3,
        "recall": sum((r for _, _, r, _ in per_class), F.lit(0.0)) / 3,
        "f1_score": sum((f for _, _, _, f in per_class), F.lit(0.0)) / 3,
    }


def classification_report(df: DataFrame, by: Sequence[str] = (), label: str = "ftr", predicted: Column | None = None) -> DataFrame:
    predicted = S.predicted_label(*PROBS) if predicted is None else predicted
    counted = df.groupBy(*by).agg(*cell_counts(F.col(label), predicted))
    return counted.select(*by, *[c.alias(n) for n, c in classification_scores().items()])


def weekly_report(scored: DataFrame, day: str = "match_date", model: str = "model", run_date: Column | None = None) -> DataFrame:
    """Per week and model: accuracy, macro precision, recall, F1 to four decimals, and matches scored."""
    week = scored.withColumn("week", S.iso_week_label(day))
    by = ["week", model]
    if run_date is not None:
        week, by = week.withColumn("run_date", run_date), ["week", "run_date", model]
    report = classification_report(week, by)
    return report.select(
        *by,
        *[F.round(c, 4).alias(c) for c in ("accuracy", "precision", "recall", "f1_score")],
        F.col("n_rows").alias("matches_scored"),
    )


def one_vs_rest(df: DataFrame, keep: Sequence[str] = (), label: str = "ftr", probs: Sequence[str] = PROBS) -> DataFrame:
    """Three rows per match: class, its probability, whether it happened."""
    cells = [
        F.struct(F.lit(c).alias("class"), F.col(p).alias("p"), (F.col(label) == c).cast("int").alias("hit"))
        for c, p in zip(CLASSES, probs)
    ]
    return df.select(*keep, F.explode(F.array(*cells)).alias("e")).select(*keep, "e.*")


def calibration_curve(df: DataFrame, bins: int = 10, label: str = "ftr", probs: Sequence[str] = PROBS) -> DataFrame:
    """One-vs-rest reliability per quantile bin and class; empty bins do not appear.

    Rows are read once and grouped by (class, probability): from there on equal probabilities are one row, for
    the edges and for the bins. A bin is the number of inner quantile edges strictly below the probability.
    """
    long = one_vs_rest(df, label=label, probs=probs)
    values = stage(long.groupBy("class", "p").agg(F.count("*").alias("c"), F.sum("hit").alias("h")), "calibration")
    edges = grouped_quantiles(values, ["class"], "p", [i / bins for i in range(1, bins)], weight="c")
    number = sum(((F.col(f"q{i}") < F.col("p")).cast("int") for i in range(bins - 1)), F.lit(0))
    return (
        values.join(F.broadcast(edges), "class")  # three rows of edges, one per class
        .groupBy("class", number.alias("bin"))
        .agg(
            F.sum("c").alias("n_rows"),
            (F.sum("h") / F.sum("c")).alias("observed"),
            (F.sum(F.col("p") * F.col("c")) / F.sum("c")).alias("mean_predicted"),
        )
    )


def long_features(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    pairs = [F.struct(F.lit(c).alias("feature"), F.col(c).alias("value")) for c in columns]
    return df.select(F.explode(F.array(*pairs)).alias("e")).select("e.*")


def feature_medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact median of each column over its non-null values."""
    return grouped_quantiles(long_features(df, columns), ["feature"], "value", [0.5]).select(
        "feature", F.col("q0").alias("median"), "n"
    )


def feature_moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean, population and sample deviation per column, one pass over the rows."""
    aggs = []
    for c in columns:
        aggs += [F.avg(c).alias(f"{c}|m"), F.stddev_pop(c).alias(f"{c}|p"), F.stddev_samp(c).alias(f"{c}|s")]
    wide = df.agg(*aggs)
    cells = [
        F.struct(
            F.lit(c).alias("feature"),
            F.col(f"`{c}|m`").alias("mean"),
            F.col(f"`{c}|p`").alias("std_pop"),
            F.col(f"`{c}|s`").alias("std_samp"),
        )
        for c in columns
    ]
    return wide.select(F.explode(F.array(*cells)).alias("e")).select("e.*")


def content_hash(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Order-independent fingerprint: row count and the sum of 60-bit prefixes of row digests."""
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    prefix = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("decimal(20,0)")
    return df.agg(F.count("*").alias("n_rows"), F.sum(prefix).cast("string").alias("digest_sum"))


def standardise(df: DataFrame, columns: Sequence[str], moments: dict[str, tuple[float, float]]) -> DataFrame:
    """Centre and scale with fitted (mean, deviation) pairs; a zero deviation leaves the centred value."""
    return df.withColumns({c: (F.col(c) - m) / (s if s else 1.0) for c, (m, s) in moments.items() if c in columns})

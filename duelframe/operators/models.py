"""Outcome models: a constant, a multinomial logistic, boosted trees with calibration, and flat Spark ML classifiers.

Every model but the flat ones offers ``transform(df)``, which adds ``p_home, p_draw, p_away``. The fits named
``..._folds`` take training rows with a fold number and give one model a fold, all fitted by the same jobs.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelframe.functions import scalars as S
from duelframe.operators import calibration, logistic
from duelframe.operators.boosting import Trees, fit_trees, tree_scores
from duelframe.operators.metrics import PROBS, class_frequencies, compute_metrics
from duelframe.operators.packing import filled, medians
from duelframe.schema import CLASSES, FEATURES
from duelframe.session import stage

SEED = 42
# Rows that a task of a flat fit holds at most, but for a few.
FLAT_ROWS = 200_000
# Boosting parameters of the main model.
BOOSTING = {"n_estimators": 500, "learning_rate": 0.03, "max_depth": 5, "subsample": 0.9, "feature_share": 0.9}


def prepare(features: DataFrame, columns: Sequence[str] = FEATURES) -> DataFrame:
    """Label 0..2 and finite features; anything not finite is missing, and filled by the fits."""
    return features.withColumns({c: S.finite(c) for c in columns} | {"label": S.class_index("ftr").cast("double")})


@dataclass
class ConstantModel:
    """Training class frequencies for every row; three numbers are the whole model."""

    probs: tuple[float, float, float]

    @classmethod
    def fit(cls, df: DataFrame) -> "ConstantModel":
        row = class_frequencies(df).first()
        return cls(tuple(row[c] for c in PROBS))

    @classmethod
    def fit_folds(cls, df: DataFrame, fold: str = "fold") -> dict[int, "ConstantModel"]:
        shares = [F.avg((F.col("ftr") == c).cast("double")).alias(p) for c, p in zip(CLASSES, PROBS)]
        return {r[fold]: cls(tuple(r[c] for c in PROBS)) for r in df.groupBy(fold).agg(*shares).collect()}

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: F.lit(p) for c, p in zip(PROBS, self.probs)})


@dataclass
class VectorModel:
    """The multinomial logistic model; scoring is native column arithmetic."""

    fitted: logistic.LogisticModel

    def transform(self, df: DataFrame) -> DataFrame:
        return self.fitted.transform(df, PROBS)


def fit_logistic_folds(train: DataFrame, columns: Sequence[str] = FEATURES, max_iter: int = 2000, fold: str = "fold", nested: bool = False) -> dict[int, VectorModel]:
    """Median fill, centre and scale, multinomial logistic with an L2 weight of one, for every fold.

    With ``nested``, a row stands once, with the first fold that it belongs to, and is in all later ones as well."""
    rows = train.select(fold, "label", *columns)
    return {k: VectorModel(m) for k, m in logistic.fit_folds(rows, columns, fold, max_iter, nested).items()}


def fit_logistic(train: DataFrame, columns: Sequence[str] = FEATURES, max_iter: int = 2000) -> VectorModel:
    return fit_logistic_folds(train.withColumn("fold", F.lit(0)), columns, max_iter)[0]


@dataclass
class BoostedModel:
    """Boosted trees on median-filled columns; scores are calibrated if asked, and normalised to a triple."""

    columns: tuple[str, ...]
    medians: list[float]
    blocks: list[Trees]
    calibrators: list[dict] | None = None
    method: str = "none"

    def raw(self, df: DataFrame) -> DataFrame:
        """Uncalibrated class scores, in columns ``_s0.._s2``."""
        inputs = [F.coalesce(F.col(c).cast("double"), F.lit(float(m))).alias(c) for c, m in zip(self.columns, self.medians)]
        out = df.withColumn("_s", tree_scores(self.blocks, inputs))
        return out.withColumns({f"_s{i}": F.col(f"_s.s{i}") for i in range(3)}).drop("_s")

    def calibrated(self, scored: DataFrame) -> DataFrame:
        """Probabilities from the columns of ``raw``, which go."""
        names = [f"_s{i}" for i in range(3)]
        if self.calibrators:
            scored = scored.withColumns({f"_k{i}": calibration.applied(c, f"_s{i}") for i, c in enumerate(self.calibrators)})
            names = [f"_k{i}" for i in range(3)]
        triple = S.sanitise_triple(*names)
        return scored.withColumns(dict(zip(PROBS, triple))).drop(*(f"_{k}{i}" for k in "sk" for i in range(3)))

    def transform(self, df: DataFrame) -> DataFrame:
        return self.calibrated(self.raw(df))


def fit_boosted_folds(train: DataFrame, columns: Sequence[str] = FEATURES, params: dict = BOOSTING, seed: int = SEED, fold: str = "fold") -> dict[int, BoostedModel]:
    """Boosted trees for every fold, grown side by side, each from all rows of its fold."""
    rows = stage(train.select(fold, "label", *columns), "boosting-rows")
    middle = medians(rows, columns, fold)
    trees = fit_trees(filled(rows, columns, middle, fold), columns, params, seed, fold)
    return {k: BoostedModel(tuple(columns), [float(m) for m in middle[k]], t) for k, t in trees.items()}


def fit_boosted(train: DataFrame, columns: Sequence[str] = FEATURES, params: dict = BOOSTING, seed: int = SEED) -> BoostedModel:
    return fit_boosted_folds(train.withColumn("fold", F.lit(0)), columns, params, seed)[0]


def calibrate(model: BoostedModel, validation: DataFrame, methods: Sequence[str] = ("sigmoid",)) -> tuple[BoostedModel, list[dict]]:
    """Fit each calibration on the validation rows and keep the lowest log loss, the raw model included.

    Rows are scored once; calibrations are fitted, applied and compared on the stored scores. The rows that fit the
    calibrator also choose it, so the returned scores are optimistic: judge on test rows. Unknown methods are an
    error; a tie keeps the earlier candidate, raw first.
    """
    scored = stage(model.raw(validation).select("label", "ftr", "_s0", "_s1", "_s2"), "scores")
    candidates = [model]
    for method in methods:
        if method != "none":
            fits = calibration.FITS[method](scored, ["_s0", "_s1", "_s2"])
            candidates.append(BoostedModel(model.columns, model.medians, model.blocks, fits, method))
    tried = None
    for i, c in enumerate(candidates):
        one = c.calibrated(scored).select(F.lit(i).alias("i"), "ftr", *PROBS)
        tried = one if tried is None else tried.unionByName(one)
    measured = {r["i"]: r for r in compute_metrics(tried, ["i"]).collect()}
    rows = [{"name": c.method, **{k: measured[i][k] for k in ("n_rows", "log_loss", "accuracy", "brier")}} for i, c in enumerate(candidates)]
    best = min(range(len(rows)), key=lambda i: (rows[i]["log_loss"], i))
    return candidates[best], rows


def evaluate(model, df: DataFrame) -> dict:
    return compute_metrics(model.transform(df)).first().asDict()


def fit_flat(train: DataFrame, columns: Sequence[str], kind: str, centred: bool = True, tuned: bool = True, label: str = "label", seed: int = SEED) -> PipelineModel:
    """Assemble, scale, classify. ``tuned`` sets 100 trees of depth 6, or 100 iterations and a 0.01 penalty;
    otherwise library defaults apply.

    The library holds a row some 500 bytes long in the partition it was read in, so a longer table is dealt first."""
    train = train.select(*columns, label)
    rows = train.count()
    if rows > FLAT_ROWS:
        train = train.repartition(-(-rows // FLAT_ROWS))
    if kind == "rf":
        options = {"numTrees": 100, "maxDepth": 6} if tuned else {}
        classifier = RandomForestClassifier(featuresCol="_x", labelCol=label, seed=seed, **options)
    elif kind == "lr":
        options = {"maxIter": 100, "regParam": 0.01} if tuned else {}
        classifier = LogisticRegression(featuresCol="_x", labelCol=label, **options)
    else:
        raise ValueError(f"unknown classifier kind: {kind}")
    stages = [
        VectorAssembler(inputCols=list(columns), outputCol="_raw"),
        StandardScaler(inputCol="_raw", outputCol="_x", withMean=centred, withStd=True),
        classifier,
    ]
    return Pipeline(stages=stages).fit(train)

"""Classifiers, tuning and the matrix-factorisation recommender (Spark ML).

Every estimator takes an explicit seed: Spark's default seed is derived from
the class name and differs between processes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (
    DecisionTreeClassificationModel,
    LinearSVC,
    LogisticRegression,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator, Evaluator, MulticlassClassificationEvaluator
from pyspark.ml.recommendation import ALS
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.session import default_parallelism

# The seed and the model settings of the reference's jobs
# (linear SVM maxIter 10 / regParam 0.1; ALS maxIter 5 / regParam 0.01 / rank 10).
SEED = 1000
FOLD = "_fold"
#: Rows of a task while tuning: a fit is hundreds of passes, and each pays for every task.
TUNE_ROWS = 20_000


def logistic(**params) -> LogisticRegression:
    return LogisticRegression(featuresCol="features", labelCol="label", **params)


def svm(max_iter: int = 10, reg_param: float = 0.1, **params) -> LinearSVC:
    return LinearSVC(featuresCol="features", labelCol="label", maxIter=max_iter, regParam=reg_param, **params)


class _ForestModel(RandomForestClassificationModel):
    """A fitted forest that makes Python objects of its trees only when they are asked for. PySpark
    makes them for every model (``params`` reads each attribute that is no plain property), with many
    calls of the JVM per tree: over a grid of 100 and 200 trees that took longer than the fits."""

    @property
    def trees(self) -> list[DecisionTreeClassificationModel]:
        return super().trees


class _Forest(RandomForestClassifier):
    def _create_model(self, java_model) -> _ForestModel:
        return _ForestModel(java_model)


def forest(seed: int = SEED, **params) -> RandomForestClassifier:
    return _Forest(featuresCol="features", labelCol="label", seed=seed, **params)


def fit(estimator: Estimator, train: DataFrame) -> Model:
    return estimator.fit(train)


def grid(estimator: Estimator, **values) -> list:
    """Parameter grid from ``name=[values]`` keyword arguments."""
    builder = ParamGridBuilder()
    for name, options in values.items():
        builder = builder.addGrid(estimator.getParam(name), list(options))
    return builder.build()


def fold_of(keys: Sequence[str], folds: int = 5, seed: int = SEED) -> Column:
    """A row's fold from a hash of its keys: the same on any partitioning and after a repeated task."""
    return F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(folds)).cast("int")


def tune(
    estimator: Estimator,
    param_grid: list,
    evaluator: Evaluator,
    train: DataFrame,
    folds: int = 5,
    seed: int = SEED,
    parallelism: int | None = None,
    keys: Sequence[str] | None = None,
) -> CrossValidatorModel:
    """k-fold cross-validation; the best parameters are refitted on all of ``train``.

    Each fit is itself a distributed job; ``parallelism`` (default: one grid
    point per available core, at most the grid size) runs several fits at once
    so that small folds do not leave the cluster idle. With ``keys`` a row's fold
    is a hash of them, the same on any partitioning and after a repeated task;
    without, Spark draws folds at random. ``train`` is kept for the many fits, which
    read it in tasks of about ``TUNE_ROWS`` rows, however finely its plan dealt it out.
    """
    if parallelism is None:
        parallelism = max(1, min(len(param_grid), default_parallelism(train.sparkSession)))
    if keys:
        train = train.withColumn(FOLD, fold_of(keys, folds, seed))
    cv = CrossValidator(
        estimator=estimator,
        estimatorParamMaps=param_grid,
        evaluator=evaluator,
        numFolds=folds,
        seed=seed,
        parallelism=parallelism,
        foldCol=FOLD if keys else "",
    )
    train = train.persist()
    try:
        return cv.fit(train.coalesce(max(1, -(-train.count() // TUNE_ROWS))))
    finally:
        train.unpersist()


def binary_evaluator(raw: str = "rawPrediction") -> BinaryClassificationEvaluator:
    return BinaryClassificationEvaluator(rawPredictionCol=raw, labelCol="label", metricName="areaUnderROC")


def multiclass_evaluator(metric: str = "f1") -> MulticlassClassificationEvaluator:
    return MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", metricName=metric)


def als(
    user: str,
    item: str,
    rating: str,
    rank: int = 10,
    max_iter: int = 5,
    reg_param: float = 0.01,
    seed: int = SEED,
    cold_start: str = "drop",
    implicit: bool = False,
    blocks: int | None = None,
) -> ALS:
    """Explicit-feedback ALS. Ids must be integer valued; unknown users or
    items at prediction time are dropped (``'nan'`` keeps them as NaN, which
    sorts first in a descending order). ``blocks`` sets the number of user and
    item factor blocks -- on a cluster about the number of cores, so every core
    solves one block per iteration; factors stay distributed throughout."""
    extra = {"numUserBlocks": blocks, "numItemBlocks": blocks} if blocks else {}
    return ALS(
        userCol=user,
        itemCol=item,
        ratingCol=rating,
        rank=rank,
        maxIter=max_iter,
        regParam=reg_param,
        seed=seed,
        coldStartStrategy=cold_start,
        implicitPrefs=implicit,
        **extra,
    )


def chosen_params(cv_model: CrossValidatorModel) -> dict[str, object]:
    """The parameters of the grid point cross-validation picked, with its score
    (a tuned model may equal an untuned one when the default is in the grid)."""
    scores = list(cv_model.avgMetrics)
    larger_better = cv_model.getEvaluator().isLargerBetter()
    best = max(range(len(scores)), key=lambda i: scores[i] if larger_better else -scores[i])
    params = {p.name: v for p, v in cv_model.getEstimatorParamMaps()[best].items()}
    params["cv_metric"] = scores[best]
    return params

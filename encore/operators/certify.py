"""Certificates of fitted models, recomputed from the data by other means than the fit.

- A logistic regression minimises a convex objective, so it is right if and only if the
  gradient and the penalty balance in every coefficient (the conditions of Karush, Kuhn and
  Tucker): ``logistic_certificate``.
- Principal components are eigenvectors of the covariance, which ``gram.pair_statistics``
  aggregates again: ``pca_certificate``.
- After the last half-step of alternating least squares every user's factors solve that user's
  normal equations over the items' factors: ``als_certificate``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.operators.batched import Tuned
from encore.operators.gram import pair_statistics


def gradient(model: LogisticRegressionModel, train: DataFrame) -> DataFrame:
    """``(class, position, n, gradient, mean, variance)``: the mean gradient of the loss over
    the rows for every coefficient (the last position is the intercept), and each feature's
    mean and sample variance. Tasks multiply batches of residuals with features and send
    one row per coefficient."""
    scored = model.transform(train).select(
        vector_to_array(model.getFeaturesCol()).alias("x"), vector_to_array(model.getProbabilityCol()).alias("p"),
        F.col(model.getLabelCol()).cast("int").alias("y"),
    )
    return _gradient(scored, model.numClasses, model.numFeatures)


def _gradient(scored: DataFrame, classes: int, features: int) -> DataFrame:
    """The same from (x, p, y): features and class probabilities as arrays, and the class."""
    width = features + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, mean, ss, g = 0, np.zeros(width), np.zeros(width), np.zeros((classes, width))
        for batch in batches:
            m = batch.num_rows
            if not m:
                continue
            x = np.column_stack([batch.column(0).flatten().to_numpy().reshape(m, width - 1), np.ones(m)])
            p, y = batch.column(1).flatten().to_numpy().reshape(m, classes), batch.column(2).to_numpy()
            g += (p - (y[:, None] == np.arange(classes))).T @ x
            own = x.mean(axis=0)
            delta = own - mean
            ss += ((x - own) ** 2).sum(axis=0) + delta**2 * (n * m / (n + m))
            mean, n = mean + delta * (m / (n + m)), n + m
        if n:
            place = np.tile(np.arange(width), classes)
            made = [np.repeat(np.arange(classes), width), place, np.full(len(place), n), g.ravel(), mean[place], ss[place]]
            yield pa.RecordBatch.from_arrays([pa.array(v, type=t) for v, t in zip(made, _TYPES, strict=True)], ["class", "position", "n", "g", "mean", "ss"])

    parts = scored.mapInArrow(run, "class int, position int, n bigint, g double, mean double, ss double")
    # The squares around the means of the tasks, and of these means around their mean.
    whole = parts.groupBy("class", "position").agg(
        F.sum("n").alias("rows"), F.sum("g").alias("g"), (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("mean"),
        F.sum("ss").alias("within"), F.collect_list(F.struct("n", "mean")).alias("means"),
    )
    around = F.aggregate("means", F.lit(0.0), lambda s, t: s + t["n"] * (t["mean"] - F.col("mean")) * (t["mean"] - F.col("mean")))
    return whole.select(
        "class", "position", F.col("rows").alias("n"), (F.col("g") / F.col("rows")).alias("gradient"), "mean",
        F.try_divide(F.col("within") + around, F.col("rows") - 1).alias("variance"),
    )


_TYPES = (pa.int32(), pa.int32(), pa.int64(), pa.float64(), pa.float64(), pa.float64())


def logistic_certificate(model: LogisticRegressionModel, train: DataFrame, tolerance: float = 1e-3) -> DataFrame:
    """``(class, position, n, coefficient, gap, violated)``: by how much each coefficient fails
    the optimality conditions of the elastic-net objective, in units of the standardised
    features (as the fit penalises them). A binary model is judged by its class 1."""
    matrix, intercept = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    penalty = model.getRegParam(), model.getElasticNetParam(), model.getStandardization()
    return _conditions(gradient(model, train), matrix, intercept, *penalty, tolerance)


def tuned_certificate(tuned: Tuned, train: DataFrame, features: str = "features", label: str = "label", tolerance: float = 1e-6) -> DataFrame:
    """The same for the chosen model of :func:`encore.operators.batched.tune_logistic`; the
    probabilities are array expressions over its coefficients."""
    x = vector_to_array(features)
    rows = [F.array(*[F.lit(float(v)) for v in w]) for w in tuned.coefficients]
    logits = [F.aggregate(F.zip_with(x, w, lambda a, b: a * b), F.lit(float(b)), lambda s, t: s + t) for w, b in zip(rows, tuned.intercepts, strict=True)]
    z = F.array(*([F.lit(0.0)] if len(logits) == 1 else []), *logits)
    shifted = train.select(x.alias("x"), F.col(label).cast("int").alias("y"), z.alias("z"))
    shifted = shifted.withColumn("e", F.transform("z", lambda v: F.exp(v - F.array_max("z"))))
    total = F.aggregate("e", F.lit(0.0), lambda s, v: s + v)
    scored = shifted.select("x", F.transform("e", lambda v: v / total).alias("p"), "y")
    matrix = np.asarray(tuned.coefficients)
    point = tuned.points[tuned.best]
    found = _gradient(scored, max(len(matrix), 2), matrix.shape[1])
    return _conditions(found, matrix, np.asarray(tuned.intercepts), point.reg, point.alpha, True, tolerance)


def _conditions(found: DataFrame, matrix: np.ndarray, intercept: np.ndarray, reg: float, alpha: float, std: bool, tolerance: float) -> DataFrame:
    binary = matrix.shape[0] == 1
    rows = [(1 if binary else c, j, float(v)) for c in range(matrix.shape[0]) for j, v in enumerate([*matrix[c], intercept[c]])]
    coefficients = found.sparkSession.createDataFrame(rows, "class int, position int, coefficient double")  # classes x features
    found = found.join(coefficients, ["class", "position"])
    last = F.col("position") == matrix.shape[1]
    scale = F.when(last | (F.col("variance") <= 0), 1.0).otherwise(F.sqrt("variance"))
    g = F.col("gradient") / scale if std else F.col("gradient")
    b = F.col("coefficient") * (scale if std else F.lit(1.0))
    gap = F.when(last, F.abs(g)).when(b == 0, F.greatest(F.abs(g) - reg * alpha, F.lit(0.0)))
    gap = gap.otherwise(F.abs(g + reg * (1 - alpha) * b + reg * alpha * F.signum(b)))
    # A constant feature has no say: the fit leaves its coefficient at 0.
    gap = F.when(~last & (F.col("variance") <= 0), F.abs("coefficient")).otherwise(gap)
    return found.select("class", "position", "n", "coefficient", gap.alias("gap"), (gap > tolerance).alias("violated"))


def pca_certificate(df: DataFrame, columns: Sequence[str], std: np.ndarray, components: np.ndarray, ratios: np.ndarray, tolerance: float = 1e-6) -> DataFrame:
    """One row ``(n, components, total_variance, not_eigen, not_orthonormal, not_leading)`` for
    components (columns of ``components``) of the data divided by ``std``.

    The covariance comes from its own scan. It and its eigenvalues are on the driver: columns x
    columns numbers, whatever the rows. ``not_eigen`` counts components that the covariance
    does not scale by their variance, ``not_leading`` those whose variance is not the next
    largest eigenvalue."""
    k = len(columns)
    pairs = pair_statistics(df, columns).select("x", "y", "n", "co").toArrow()
    x, y = pairs.column("x").to_numpy(), pairs.column("y").to_numpy()
    n = int(pairs.column("n").to_numpy().min())
    covariance = np.zeros((k, k))
    covariance[x, y] = covariance[y, x] = pairs.column("co").to_numpy() / max(n - 1, 1)
    scale = np.where(std > 0, std, np.inf)  # a constant column is scaled to 0
    covariance /= np.outer(scale, scale)
    total = float(np.trace(covariance))
    variances = ratios * total
    residual = np.abs(covariance @ components - components * variances).max(axis=0)
    products = np.abs(components.T @ components - np.eye(components.shape[1]))
    largest = np.sort(np.linalg.eigvalsh(covariance))[::-1][: len(variances)]
    row = (n, int(components.shape[1]), round(total, 6), int((residual > tolerance * max(total, 1)).sum()),
           int((products.max(axis=0) > tolerance).sum()), int((np.abs(variances - largest) > tolerance * max(total, 1)).sum()))
    schema = "n bigint, components int, total_variance double, not_eigen int, not_orthonormal int, not_leading int"
    return df.sparkSession.createDataFrame([row], schema)


def als_certificate(model: ALSModel, ratings: DataFrame, user: str, item: str, rating: str, reg: float, tolerance: float = 1e-3) -> DataFrame:
    """``(id, n, gap, violated)`` per user: by how much the user's factors fail the normal
    equations over the items' factors, as a share of the size of their terms (factors are
    32-bit numbers).

    Factors join the ratings by item and by user, and the sums are partially aggregated; a
    popular item or a busy user is split by adaptive execution."""
    rows = ratings.select(F.col(user).alias("id"), F.col(item).alias("item"), F.col(rating).cast("double").alias("r"))
    items = model.itemFactors.select(F.col("id").alias("item"), F.col("features").cast("array<double>").alias("v"))
    users = model.userFactors.select("id", F.col("features").cast("array<double>").alias("u"))
    both = rows.join(items, "item").join(users, "id")
    dot = F.aggregate(F.zip_with("u", "v", lambda a, b: a * b), F.lit(0.0), lambda s, t: s + t)
    both = both.select("id", "r", "u", "v", (dot - F.col("r")).alias("e"))
    sums = both.groupBy("id").agg(
        F.count(F.lit(1)).alias("n"), F.first("u").alias("u"),
        F.array(*[F.sum(F.col("e") * F.get("v", i)) for i in range(model.rank)]).alias("pull"),
        F.array(*[F.sum(F.abs(F.col("r") * F.get("v", i))) for i in range(model.rank)]).alias("size"),
    )
    off = F.zip_with("pull", "u", lambda p, u: F.abs(p + reg * F.col("n") * u))
    gap = F.array_max(F.zip_with(off, "size", lambda d, s: d / (s + 1.0)))
    return sums.select("id", "n", gap.alias("gap")).withColumn("violated", F.col("gap") > tolerance)
